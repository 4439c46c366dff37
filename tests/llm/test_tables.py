"""Operators over whole tables: dedup, joins, mixing, files, calls and the pipeline."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.llm import mixing, tool_calls
from siftstone.llm.common import Scratch
from siftstone.llm.components import connected_components
from siftstone.llm.exact_dedup import exact_dedup
from siftstone.llm.jaccard_join import Rule, drop_near_copies, jaccard_components
from siftstone.llm.token_files import read_token_files, write_token_files

EDGES = [(1, None), (2, ""), (3, "x"), (3, "x"), (4, "word " * 20_000), (None, "a\n\tb"), (None, None)]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(spark, docs):
    rows = [*EDGES, *[(i, random.Random(i % 7).choice(["Aa", "aA", "É", "é", "b"])) for i in range(10, 80)]]
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    for n in (1, 5):
        got = exact_dedup(spark, docs(*rows), n).collect()
        assert len(got) == len(rows)
        for r in got:
            (text, ids), = [(t, ids) for t, ids in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
            keep = max((i for i in ids if i is not None), default=None)
            assert (r.keep_id, r.group_size) == (keep, len(ids))
        assert Counter(r.text_sha256 for r in got if r.kept) == dict.fromkeys({r.text_sha256 for r in got}, 1)
    assert exact_dedup(spark, docs(*rows).limit(0)).count() == 0


def brute_components(rows, rule):
    def shingles(text):
        w = lower(text).encode().split()
        n = min(rule.width, len(w))
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()

    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    named = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(named):
        for j, b in named[k + 1 :]:
            if a and b and len(a & b) * rule.den >= len(a | b) * rule.num:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows), key=str)


@pytest.mark.parametrize("rule", [Rule(3, 90, 100), Rule(5, 80, 100)])
def test_jaccard_equals_brute_force(spark, docs, rule):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(words, k=25))
    rows = [*EDGES, (3, "another text under the same id"), (5, "one two"), (6, "one  TWO")]
    at = 100
    for size, copies in ((12, 4), (40, 12), (150, 60)):
        base = rng.choices(words, k=size)
        for _ in range(copies):
            edited = list(base)
            for _ in range(rng.randint(0, 4)):
                edited[rng.randrange(size)] = rng.choice(words)
            rows.append((at, " ".join(edited)))
            at += 1
    rows += [(at + i, line + " " + " ".join(rng.choices(words, k=30))) for i in range(40)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(spark, docs(*rows), rule).collect()), key=str)
    assert got == brute_components(rows, rule)


def test_near_copies_leave_texts_in_place(spark, docs):
    """No text is exchanged to drop few documents."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = docs(*[(d, f"a text of some words that number {d // 3} has and no other one") for d in range(30)])
        kept = drop_near_copies(spark, rows, Rule(5, 80, 100))
        assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 30, 3))
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_settled_tables_leave_no_shuffle_files(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if "shuffle_" in (name := files.apply(i).getName())}

    scratch, before = Scratch(spark, "settle"), held()
    scratch.save(spark.range(1000).repartition(7, "id"), "dealt")
    own = held() - before
    scratch.settle()
    until = time.monotonic() + 20
    while own & held() and time.monotonic() < until:
        time.sleep(0.1)
    assert own and not own & held()


def test_near_copies_edges(spark, docs):
    rows = docs(*EDGES, (5, "one two three"), (6, "one two three"))
    kept = drop_near_copies(spark, rows, Rule(5, 80, 100))
    assert kept.columns == rows.columns
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 2}
    assert jaccard_components(spark, rows.limit(0), Rule(3, 90, 100)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (60, 61), (61, 60), (70, 70)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in connected_components(Scratch(spark, "t"), links, "c").collect()}
    assert got == {**dict.fromkeys([*range(41), 100], 0), 60: 60, 61: 60}
    assert connected_components(Scratch(spark, "t"), links.limit(0), "c").count() == 0


def test_fit_lengths_meets_the_budget():
    rng = random.Random(9)
    for _ in range(200):
        lengths = {rng.randint(0, 300): rng.randint(1, 9) for _ in range(rng.randint(1, 40))}
        total = sum(s * n for s, n in lengths.items())
        target = rng.uniform(0, 2) * total
        copies, more = mixing.fit_lengths(lengths, target)
        taken = sum(s * n * copies + s * more.get(s, 0) for s, n in lengths.items())
        assert all(more.get(s, 0) <= n for s, n in lengths.items()) and copies in (0, 1, 2)
        assert taken <= target + 1 and (len(lengths) < 12 or target - taken <= 30)


def test_knapsack_equals_brute_force():
    rng = random.Random(12)
    for _ in range(300):
        left = {rng.randint(1, 40): rng.randint(0, 6) for _ in range(rng.randint(0, 8))}
        budget = rng.randint(0, 200)
        sums = {0}
        for size, n in left.items():
            sums = {s + size * k for s in sums for k in range(n + 1) if s + size * k <= budget}
        got = mixing._knapsack(left, budget)
        assert all(0 < n <= left[size] for size, n in got.items())
        assert sum(size * n for size, n in got.items()) == max(sums)


def test_long_documents_leave_no_more_than_the_knapsack_must():
    # a rest of many thousand words, which only the dynamic program closes
    lengths = {70_001: 3, 250_000: 2, 1_000: 60, 37: 400}
    total = sum(s * n for s, n in lengths.items())
    for target in (0.4 * total, 1.37 * total, 0.9999 * total):
        copies, more = mixing.fit_lengths(lengths, target)
        taken = sum(s * n * copies + s * more.get(s, 0) for s, n in lengths.items())
        assert 0 <= round(target) - taken < 37 and all(more.get(s, 0) <= n for s, n in lengths.items())
    assert mixing.fit_lengths({90_000: 1}, 50_000) == (0, {})
    assert mixing.fit_lengths({90_000: 4}, 200_000) == (0, {90_000: 2})


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = budget - sum(2 * sizes[s] for s in capped)
        unit = rest / (sum(weight[s] for s in order if s not in capped) or 1)
        over = {s for s in order if s not in capped and unit * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else unit * weight[s] for s in order}
        capped |= over


def test_mixing(spark, docs):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "b", "b", "é", None])) for i in range(600)]
    rows += [(1000 + i, "same size here", "b") for i in range(300)] + [(None, None, "a"), (7, "twice", "a")]
    got = mixing.mix_documents(spark, docs(*rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(dict(sizes))
    taken, target = Counter(), {}
    by_id = {i: s for i, _, s in rows}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        s = by_id[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
    assert all(abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 5 for s in want)
    again = mixing.mix_documents(spark, docs(*rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    picked = mixing.mixed_rows(spark, docs(*rows))
    assert picked.columns == docs((1, "x")).columns
    assert sum(len(r.text.split()) for r in picked.collect()) == sum(r.taken for r in got)
    assert mixing.mix_documents(spark, docs((1, None))).first().taken == 0
    assert mixing.mix_documents(spark, docs((1, "x")).limit(0)).count() == 0


def test_token_files_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    real = Tokenizer.from_file(path)
    rows = [*EDGES, *[(i * 7 % 101, f"text number {i}\n end") for i in range(10, 60)]]
    got = read_token_files(spark, write_token_files(spark, docs(*rows), path)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for i, t in order:
        ids = [*real.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert read_token_files(spark, write_token_files(spark, docs(*rows).limit(0), path)).count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "find", {"q": '"x"', "n": "3"}, ["b"]),
            (1, "b", 2, "find", {"n": '"3"', "z": "1"}, []),
            (1, "c", 3, "none", {}, ["d"]),
            (1, "d", 4, "find", {"q": None}, ["c"]),
            (2, None, 1, "find", None, None),
            (2, "e", 5, "find", {"q": '"é\\""'}, ["missing"]),
        ],
        "conv_id long, call_id string, turn long, tool string, arguments map<string,string>, refs array<string>",
    )
    results = spark.createDataFrame(
        [(1, "a", 9, "late"), (1, "a", 5, "first"), (1, "b", 2, "same turn"), (9, "zz", 1, "orphan"), (2, None, 1, "x")],
        "conv_id long, call_id string, turn long, content string",
    )
    tools = spark.createDataFrame(
        [("find", [("q", "string", True), ("n", "integer", False)])], "tool string, schema array<struct<name:string,type:string,required:boolean>>"
    )
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link_tool_calls(spark, calls, results, tools).collect()}
    assert len(got) == 6
    assert (got[1, "a"].status, got[1, "a"].result, got[1, "a"].errors, got[1, "a"].level) == ("linked", "first", [], 1)
    assert (got[1, "b"].status, got[1, "b"].level) == ("early", 0)
    assert got[1, "b"].errors == ["extra:z", "missing:q", "type:n"]
    assert got[1, "c"].errors == ["unknown-tool"] and got[1, "c"].level is None and got[1, "d"].level is None
    assert got[2, None].status == "pending" and got[2, "e"].level == 0
    assert got[1, "a"].json == '{"arguments":{"n":3,"q":"x"},"id":"a","name":"find","result":"first","status":"linked"}'
    orphans = tool_calls.orphan_results(calls, results).collect()
    assert {r.content for r in orphans} == {"orphan", "x"}
    assert tool_calls.link_tool_calls(spark, calls.limit(0), results, tools).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs = source
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "token_files":
            assert docs.columns == source.columns
        if name in ("language_id", "near_copies", "decontamination"):
            assert 0 < docs.count() <= before
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    total = docs.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert total[0] == total[1]
    assert corpus_pipeline.run(spark, sf).count() == docs.count()


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage on its own input, judged by a plain program over the collected rows."""
    import re

    import corpus_pipeline
    import public_tokenizers
    from siftstone.llm import language_id
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    scratch = Scratch(spark, "pipeline-test")
    source = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in source.collect()}
    run = lambda name, df: scratch.save(stages[name](spark, df, sf), name)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    model = language_id.LanguageModel(language_id.learn_dictionaries(source, language_id.remainder(4) != 2))
    told = run("language_id", source)
    sure = lambda t: (got := model.predict(t))[0] != "und" and got[1] >= language_id.NARROW
    assert ids(told) == sorted(i for i, r in rows.items() if sure(r.text))

    single = run("near_copies", told)
    groups = brute_components([(i, rows[i].text) for i in ids(told)], corpus_pipeline.NEAR)
    assert ids(single) == sorted({root for _, _, root in groups})

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    items = [word.findall(lower(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    by_size = defaultdict(set)
    for w in filter(None, items):
        by_size[min(10, len(w))] |= grams(w, min(10, len(w)))
    clean = run("decontamination", single)
    hit = lambda t: any(grams(word.findall(lower(t)), n) & windows for n, windows in by_size.items())
    assert ids(clean) == [i for i in ids(single) if not hit(rows[i].text)]

    mixed = run("mixture", clean)
    copies, sizes, taken = Counter(ids(mixed)), Counter(), Counter()
    for i in ids(clean):
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", rows[i].text or "") if w])
        sizes[rows[i].source] += n
        taken[rows[i].source] += n * copies[i]
    longest = max(len((rows[i].text or "").split()) for i in ids(clean))
    want = brute_targets(dict(sizes))
    assert set(copies.values()) <= {1, 2} and set(copies) <= set(ids(clean))
    assert all(-1 <= want[s] - taken[s] <= longest for s in want)

    real, at, index = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i in sorted(copies.elements()):
        tokens = [*real.encode(rows[i].text or "", add_special_tokens=False).ids, 0]
        index.append((i, at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        at += len(tokens)
    assert sorted(map(tuple, run("token_files", mixed).collect()), key=lambda r: r[1]) == index


def test_nested_arguments_are_canonical(spark):
    import json
    from pyspark.sql import functions as F

    values = [
        '{"b": 1, "a": {"d": [1, {"z": null, "y": true}], "c": "x y"}}', '[ {"b":2.50 , "a":1e5}, [ ], { } ]',
        '{"\U0001f600":1,"\uffee":2,"q\\"{k": "a\\\\", "\\u0062":"\\n, :"}', '{"n": 12345678901234567890123456789012345678901234567890}',
        '["s1", "n2", "", "\\\\\\""]', '{"s": "%s"}' % ("\\\\x" * 5000),
    ]
    broken = ['{"b":1,', '[1 2]', '{"a":1,"a":2}', '[01]', '{"a": 1.2.3}', "[nul]"]
    scalars = ['"b  a"', "12", "null", "1.50"]
    rows = list(enumerate(values + broken + scalars))
    df = spark.createDataFrame(rows, "i int, v string").repartition(2)
    got = {r.i: r.c for r in df.select("i", tool_calls.canonical_value(F.col("v")).alias("c")).collect()}

    class Number(float):
        __repr__ = lambda self: self.raw

    def number(raw):
        made = Number(0)
        made.raw = raw
        return made

    def brute(v):
        if isinstance(v, dict):
            return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + brute(v[k]) for k in sorted(v)) + "}"
        if isinstance(v, list):
            return "[" + ",".join(map(brute, v)) + "]"
        return v.raw if isinstance(v, Number) else json.dumps(v, ensure_ascii=False)

    want = [brute(json.loads(v, parse_int=number, parse_float=number)) for v in values]
    spelt = [json.dumps(v, ensure_ascii=False) for v in broken]  # no JSON is a string of its raw text
    assert [got[i] for i in range(len(rows))] == want + spelt + scalars
    odd = {" 7": "7", '{bad': '"{bad"', '\t"\\u0062" ': '"b"', "1e2": "1e2", "": '""', "01": '"01"', "true false": '"true false"', "[1] [2]": '"[1] [2]"', '"a" 1': '"\\"a\\" 1"', "1], [2": '"1], [2"', None: None}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "i int, v string").repartition(2)
    got = {r.i: r.c for r in df.select("i", tool_calls.canonical_value(F.col("v")).alias("c")).collect()}
    assert [got[i] for i in range(len(odd))] == list(odd.values())
    calls = spark.createDataFrame([(1, {"q": values[0]}), (2, {"q": '{"a":{"c":"x y","d":[1,{"y":true,"z":null}]},"b":1}'})], "i int, a map<string,string>")
    assert calls.select(tool_calls.canonical_arguments(F.col("a"))).distinct().count() == 1


def test_repeated_turns_are_one_call(spark):
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 0, "user", "c"), (2, 0, "user", None), (2, 0, "user", None)]
    calls, results = tool_calls.turns_as_calls(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    assert calls.count() == 3 and results.count() == 1  # two texts of one turn are two calls
    linked = tool_calls.link_tool_calls(spark, calls.unionAll(calls), results, tool_calls.reply_tools(spark))
    assert linked.count() == 6  # one row a call row


def test_calls_with_odd_tools_columns_and_long_texts(spark):
    long = "é\\" * 100_000
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "find", {"q": " 7", "o": "{bad", "s": None}, [], "x", 5, "y", "z"),
            (1, "a", 1, "find", {"q": " 7", "o": "{bad", "s": None}, [], "x", 5, "y", "z"),
            (1, "b", 2, "find", {"q": '"%s"' % long.replace("\\", "\\\\"), "o": ' {"k":1}'}, None, "x", 5, "y", "z"),
            (1, "c", 3, None, {}, ["a", None], "x", 5, "y", "z"),
        ],
        "conv_id long, call_id string, turn long, tool string, arguments map<string,string>, refs array<string>, level string, result_turn int, status string, json string",
    )
    results = spark.createDataFrame([(1, "b", 4, long, 1)], "conv_id long, call_id string, turn long, content string, result int")
    schema = [("q", "integer", True), ("o", "object", False)]
    tools = spark.createDataFrame(
        [("find", schema, 1), ("find", [*schema, ("z", "string", True)], 2), ("find", schema, 3), (None, schema, 4)],
        "tool string, schema array<struct<name:string,type:string,required:boolean>>, tool_schema int",
    )
    got = tool_calls.link_tool_calls(spark, calls, results, tools).collect()
    assert len(got) == 4
    by = {r.call_id: r for r in got}
    assert by["a"].errors == ["extra:s", "json:o"] and by["a"].level == 0 and by["a"].status == "pending"
    assert by["a"].json == '{"arguments":{"o":"{bad","q":7,"s":null},"id":"a","name":"find","result":null,"status":"pending"}'
    assert by["b"].errors == ["type:q"] and by["b"].result == long
    import json

    read = json.loads(by["b"].json)
    assert read["arguments"] == {"q": long, "o": {"k": 1}} and read["result"] == long
    assert by["c"].errors == ["unknown-tool"]
    assert tool_calls.link_tool_calls(spark, calls, results.limit(0), tools.limit(0)).filter("errors[0] = 'unknown-tool' AND status = 'pending'").count() == 4


def test_levels_equal_brute_force(spark):
    rng = random.Random(14)
    rows = []
    for conv in range(30):
        n = rng.randint(1, 7)
        rows += [(conv, f"k{i}", i, [f"k{j}" for j in rng.sample(range(n + 1), rng.randint(0, 2))]) for i in range(n)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, refs array<string>")
    want = {}
    for conv in range(30):
        own = {c: [r for r in refs if any(x[0] == conv and x[1] == r for x in rows)] for v, c, _, refs in rows if v == conv}
        turn = {c: t for v, c, t, _ in rows if v == conv}
        if all(turn[r] < turn[c] for c, refs in own.items() for r in refs):
            want |= {(conv, c): 0 for c in own}
            continue
        level = {}
        while free := [c for c in own if c not in level and all(r in level for r in own[c])]:
            level |= {c: 1 + max((level[r] for r in own[c]), default=-1) for c in free}
        want |= {(conv, c): level.get(c) for c in own}
    got = {(r.conv_id, r.call_id): r.level for r in tool_calls.order_levels(spark, calls).collect()}
    assert got == want and {None, 0, 1} <= set(got.values())


def test_a_long_chain_takes_few_rounds(spark):
    n = 300
    rows = [(1, f"k{i}", i, [f"k{i + 1}"]) for i in range(n)]  # forward to the last, which refers to none there is
    rows += [(2, f"k{i}", i, [f"k{(i + 1) % 50}"]) for i in range(50)] + [(2, "tail", 60, ["k0"]), (2, "self", 61, ["self"]), (2, "free", 62, None)]
    rows += [(3, "hub", 0, ["a", "z"]), *[(3, c, i, [chr(ord(c) + 1)]) for i, c in enumerate("abcdefgh", 1)], (3, "z", 20, []), (3, "top", 21, ["hub", "k"])]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, refs array<string>")
    got = {(r.conv_id, r.call_id): r.level for r in tool_calls.order_levels(spark, calls).collect()}
    assert len(got) == len(rows)
    assert all(got[1, f"k{i}"] == n - 1 - i for i in range(n))
    assert {got[2, c] for c in [*(f"k{i}" for i in range(50)), "tail", "self"]} == {None} and got[2, "free"] == 0
    assert got[3, "h"] == 0 and got[3, "a"] == 7 and got[3, "hub"] == 8 and got[3, "top"] == 9


def test_pipeline_on_an_empty_table_nulls_and_clashing_columns(spark, tmp_path):
    """No crash; nulls of any column end as the stages say, and all columns but the last stage's pass through."""
    import shutil

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, None, "en", None, 3), (900_002, "", None, "web", 0)], source.schema)
    long = odd.limit(0).unionAll(spark.createDataFrame([(900_003, "The same words go on and on. " * 40_000, "en", None, None)], source.schema))
    clash = source.unionAll(odd).unionAll(long)
    for c in ("label", "rank", "size", "_row", "items", "h", "key", "root", "n"):
        clash = clash.withColumn(c, F.lit(1))
    for name, docs in (("empty", source.limit(0)), ("clash", clash)):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        shutil.copy(f"{sf}/benchmark.parquet", f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        ids = {r.doc_id for r in got.collect()}
        assert not ids if name == "empty" else ids and not ids & {None, 900_001, 900_002}
    kept = spark.read.parquet(f"{tmp_path}/clash/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, f"{tmp_path}/clash")
        assert kept.columns == clash.columns
