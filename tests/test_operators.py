"""Operators on hand-made tables, with the numbers worked out by hand."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from siftstone.operators import agreement, batching, cost, dataset, funnel, metrics, near_dup, router, student
from siftstone.schemas import EXAMPLE, LABELED

TRIAGE = ("order_status", "medium", "neutral", "lighting", "BL-123456", "Customer asks where an order is.")


def triage(**change):
    names = ("intent", "urgency", "sentiment", "product_area", "order_id", "summary")
    return tuple(change.get(n, v) for n, v in zip(names, TRIAGE, strict=True))


def labeled(spark, rows):
    made = [
        (i, f"t{i}" if name is None else name, text, "synthetic", None, [(f"teacher-{k}", t, None if t else "invalid", False) for k, t in enumerate(labels)])
        for i, (name, text, labels) in enumerate(rows)
    ]
    return spark.createDataFrame(made, "pos long, " + LABELED)


def test_f1_and_kappa(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "g string, p string")
    got = {r.label: r.f1 for r in metrics.per_class_f1(pairs, "g", "p").collect()}
    assert got == {"a": pytest.approx(2 / 3), "b": pytest.approx(0.8)}
    labels = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")
    assert metrics.macro_f1(pairs, "g", "p", labels).first()[0] == pytest.approx((2 / 3 + 0.8) / 3)

    def kappa(rows):
        return metrics.cohen_kappa(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()["kappa"]

    assert kappa([("x", "x"), ("y", "y")]) == 1.0
    assert kappa([("x", "x"), ("x", "x")]) == 1.0
    assert kappa([("x", "x"), ("x", "y"), ("y", "x"), ("y", "y")]) == 0.0
    assert metrics.cohen_kappa(pairs.limit(0), "g", "p").first()["kappa"] == 0.0


def test_percentiles(spark, monkeypatch):
    import numpy as np

    rng = random.Random(3)
    values = [rng.choice([1.5, 2.0, rng.random() * 10, -rng.expovariate(0.2)]) for _ in range(5000)] + [7.0] * 3000
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    wanted = [0, 3, 50, 62.5, 95, 99.99, 100]
    for few in (metrics.EXACT_ROWS, 40, 1):  # all gathered; ranges narrowed; down to single values
        monkeypatch.setattr(metrics, "EXACT_ROWS", few)
        got = metrics.percentiles(df, F.col("x"), wanted if few != 1 else [50, 95])
        assert got == pytest.approx(np.percentile(values, wanted if few != 1 else [50, 95]).tolist())
    four = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "x double")
    assert metrics.percentiles(four, F.col("x"), [50]) == [2.5]
    assert metrics.percentiles(four.limit(0), F.col("x"), [50, 95]) == [0.0, 0.0]


def test_matched_needs_equal_ids(spark):
    a = spark.createDataFrame([("x", 1)], "id string, g int")
    with pytest.raises(Exception, match="differ at id"):
        metrics.matched(a, spark.createDataFrame([("y", 1)], "id string, v int")).collect()


def test_agreement(spark):
    rows = labeled(
        spark,
        [
            (None, "x", [triage(), triage()]),
            (None, "x", [triage(), triage(urgency="high", sentiment="negative", product_area="none", order_id=None)]),
            (None, "x", [triage(), None]),
        ],
    )
    got = {r.field: (r.n, r.agreement) for r in agreement.agreement_table(rows).collect()}
    assert got["intent"] == (2, 1.0) and got["order_id"] == (2, 0.5)
    whole = agreement.all_fields_agreement(rows).first()
    assert (whole.both_valid, whole.all_fields) == (2, 0.5)
    differ = [r[0] for r in rows.orderBy("pos").select(agreement.disagreements(F.col("labels"))).collect()]
    assert differ == [[], ["urgency", "sentiment", "product_area", "order_id"], ["invalid"]]


def test_whole_funnel(spark):
    long = "Where is my parcel, it should have come last week already?"
    rows = labeled(
        spark,
        [
            ("ok1", long, [triage(), triage()]),
            ("short", "hi", [triage(), triage()]),
            ("bad", long + " Really now, tell me.", [triage(), None]),
            ("split", "An entirely different message about something else", [triage(), triage(intent="other")]),
            ("twin", long.upper(), [triage(), triage()]),
            ("pii", "Please write to me at jo@example.org about the lamp", [triage(), triage()]),
        ],
    )
    made = funnel.run_funnel(spark, rows, requested=8)
    steps = [(r["name"], r["kept"], r["dropped"]) for r in made.funnel.orderBy("ord").collect()]
    assert steps == [
        ("requested", 8, 0), ("generated", 6, 2), ("length", 5, 1), ("schema_valid", 4, 1), ("teacher_agreement", 3, 1),
        ("dedup", 2, 1), ("pii_scrub", 2, 0), ("balance", 2, 0),
    ]
    assert {r.id: r.text for r in made.examples.collect()}["pii"] == "Please write to me at [EMAIL] about the lamp"
    off = funnel.run_funnel(spark, rows, funnel.FunnelConfig(require_agreement=False))
    assert [r["name"] for r in off.funnel.orderBy("ord").collect()][0] == "input"
    assert "split" in {r.id for r in off.examples.collect()}


def test_greedy_is_not_components(spark):
    pairs = spark.createDataFrame([(0, 1, 0.8), (1, 2, 0.9)], "i long, j long, similarity double")
    got = {(r.pos, r.of) for r in near_dup.greedy_duplicates(spark, pairs).collect()}
    assert got == {(1, 0)}  # 2 is like 1 only, and 1 is gone


def test_exact_and_lsh_find_the_same(spark):
    base = "the quick brown fox jumps over the lazy dog near the old river bank"
    texts = [base, base + " 42", base + " 17", "nothing in common with any of it at all, really", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    for mode in ("exact", "lsh"):
        assert {(r.pos, r.of) for r in near_dup.near_duplicates(spark, df, mode=mode).collect()} == {(1, 0), (2, 0)}


def test_near_duplicate_queries_see_every_length(spark, tmp_path):
    from siftstone.plans import catalog

    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrst", k=6))
    long, other = (" ".join(word() for _ in range(400)) for _ in range(2))
    texts = [long, "tiny", long + " " + word(), other, "Tiny!", other.upper(), None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def grams(t):
        s = re.sub(" +", " ", re.sub("[^a-z0-9 ]+", " ", (t or "").lower())).strip()
        return {s[i : i + 5] for i in range(max(len(s) - 4, 1))}

    sets = [grams(t) for t in texts]
    near = {(i, j) for j in range(8) for i in range(j) if len(sets[i] & sets[j]) >= 0.7 * len(sets[i] | sets[j])}
    assert {(0, 2), (1, 4), (3, 5)} <= near
    assert {(r.i, r.j) for r in catalog.QUERIES["neardup_all_pairs"](spark, str(tmp_path)).collect()} == near
    for name in ("neardup_greedy", "neardup_lsh"):
        assert {(r.of, r.pos) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()} == near


def test_near_duplicates_equal_a_sequential_pass(spark):
    rng = random.Random(40)
    bases = ["".join(rng.choices("abcdefgh ", k=60)) for _ in range(6)]

    def edited(t):
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice("abcdefgh") + t[at + 1 :]
        return t

    texts = [rng.choice((edited, str.upper, str))(rng.choice(bases)) for _ in range(90)] + [None, "", "a"]
    norm = [re.sub(" +", " ", re.sub("[^a-z0-9 ]+", " ", (t or "").lower())).strip() for t in texts]
    sets = [{s[i : i + 5] for i in range(max(len(s) - 4, 1))} for s in norm]
    kept, want = [], {}
    for j, s in enumerate(sets):
        near = [(len(s & sets[i]) / len(s | sets[i]), -i) for i in kept if len(s & sets[i]) >= 0.7 * len(s | sets[i])]
        if near:
            want[j] = (-max(near)[1], pytest.approx(max(near)[0]))
        else:
            kept.append(j)
    rows = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    assert {r.pos: (r.of, r.similarity) for r in near_dup.near_duplicates(spark, rows).collect()} == want
    found = {r.pos for r in near_dup.near_duplicates(spark, rows, mode="lsh").collect()}
    assert len(found ^ set(want)) <= 0.1 * len(want)


def test_a_long_chain_is_resolved_in_order(spark, monkeypatch):
    """Every second text of a chain falls; the number of jobs doesn't grow with its links."""
    n = 10_000
    chain = spark.range(n).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "")
    assert sorted(r.pos for r in near_dup.resolved(spark, chain).collect()) == list(range(1, n + 1, 2))
    assert len(tracker.getJobIdsForGroup("chain")) < 250
    spark.sparkContext.setJobGroup("other", "")
    rng = random.Random(2)
    pairs = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)})
    fallen = set()
    for i, j in sorted(pairs, key=lambda p: p[1]):
        if i not in fallen:
            fallen.add(j)
    df = spark.createDataFrame(pairs, "i long, j long")
    for at_once in (near_dup.PAIRS_AT_ONCE, 3):
        monkeypatch.setattr(near_dup, "PAIRS_AT_ONCE", at_once)
        assert {r.pos for r in near_dup.resolved(spark, df).collect()} == fallen


def test_a_family_of_variants_costs_pairs_in_proportion(spark, monkeypatch):
    """5,000 texts that differ in a word each; pairs counted where texts are compared."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    base = [word() for _ in range(40)]
    rows = [(0, " ".join(base))]
    for i in range(1, 5000):
        own = base.copy()
        own[rng.randrange(40)] = word()
        rows.append((i, " ".join(own)))
    counted = []

    def counting(plain):
        def compared(pairs, norms, size=near_dup.SHINGLE):
            counted.append(pairs.count())
            return plain(pairs, norms, size)

        return compared

    for name in ("similarities", "tiled_similarities"):
        monkeypatch.setattr(near_dup, name, counting(getattr(near_dup, name)))
    got = near_dup.near_duplicates(spark, spark.createDataFrame(rows, "pos long, text string"), mode="lsh").collect()
    assert len(got) >= 0.99 * 4999 and all(r.of == 0 for r in got if r.similarity > 0.8)
    assert sum(counted) <= 4 * len(rows)


def test_tiles_give_the_same_similarities(spark, monkeypatch):
    """Whole components, components cut on both sides, and none."""
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 23}" for k in range(30 + i % 5))) for i in range(40)]
    norms = near_dup.normalised(spark.createDataFrame(rows, "pos long, text string"))
    some = [(i, j) for i in range(40) for j in range(i + 1, 40) if (i + j) % 3 == 0 and (i < 20) == (j < 20)]
    pairs = spark.createDataFrame(some, "i long, j long")
    read = lambda df: sorted((r.i, r.j, r.similarity) for r in df.collect())
    want = read(near_dup.similarities(pairs, norms))
    assert len(want) == len(some)
    for most in (near_dup.TILE_BYTES, 500):
        monkeypatch.setattr(near_dup, "TILE_BYTES", most)
        assert read(near_dup.tiled_similarities(pairs, norms)) == want
    assert read(near_dup.tiled_similarities(pairs.limit(0), norms)) == []


def test_lsh_recall_on_documents(spark):
    """Of the duplicates that the exact way finds in a table, nine of ten at least."""
    from siftstone.plans import catalog

    texts = catalog._texts(spark, "/root/testdata/sf0.01")
    assert texts.count() >= 1000
    want = {r.pos for r in near_dup.near_duplicates(spark, texts).collect()}
    got = {r.pos for r in near_dup.near_duplicates(spark, texts, mode="lsh").collect()}
    assert len(got & want) >= 0.9 * len(want) > 0


def test_shingles_hold_their_characters():
    for text in ("", "ab", "abcde", "abcdefabcdef", "x" * 30):
        for size in (3, 5, 8, 12):
            cut = {text[i : i + size] for i in range(max(len(text) - size, 0) + 1)}
            made = near_dup.shingle_set(text, size)
            assert len(made) == len(cut)
            if size <= 8:
                assert sorted(made.tolist()) == sorted(int.from_bytes(c.encode(), "big") for c in cut)


def test_copies_cost_no_pairs(spark):
    rows = spark.createDataFrame([(i, "the very same text again and again") for i in range(400)], "pos long, text string")
    norms = near_dup.normalised(rows)
    members = near_dup.with_classes(norms)
    reps = near_dup.representatives(norms, members)
    assert reps.count() == 1 and near_dup.with_copies(near_dup.exact_pairs(reps), members).count() == 399
    got = near_dup.near_duplicates(spark, rows, mode="lsh")
    assert got.count() == 399 and got.filter("of = 0 AND similarity = 1.0").count() == 399


def test_signatures_equal_whole_number_arithmetic():
    import numpy as np

    rng = np.random.default_rng(5)
    factors, offsets = (x.tolist() for x in near_dup._family(128))
    for text in ("", "ab", "abcde", "abcdef", "the cat 00 " * 40):
        cut = {text[i : i + 5] for i in range(max(len(text) - 4, 1))}
        assert near_dup.features(text).tolist() == sorted({zlib.crc32(c.encode()) for c in cut})
    for n in (1, 40, 2500):
        features = rng.integers(0, 1 << 32, n)
        want = [min((f * a + b) % (1 << 64) % ((1 << 61) - 1) % (1 << 32) for f in features.tolist()) for a, b in zip(factors, offsets, strict=True)]
        assert near_dup.minhash(features).tolist() == want


def test_bands():
    assert [near_dup.bands_for(t) for t in (0.5, 0.7, 0.9)] == [32, 16, 8]
    assert near_dup.pair_probability(0.7, 0.7) == pytest.approx(1 - (1 - 0.7**8) ** 16)


def test_split_sizes(spark):
    sizes = {"a": 20, "b": 10, "c": 2, "d": 1}
    rows = [(f"{g}{i}", g) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, g string")

    def val(frame, fraction=0.2):
        return {r.id for r in dataset.stratified_split(frame, F.col("g"), fraction).filter("split = 'val'").collect()}

    got = val(df)
    assert {g: sum(x[0] == g for x in got) for g in sizes} == {"a": 4, "b": 2, "c": 1, "d": 0}
    assert val(df.orderBy(F.desc("id")).repartition(3)) == got
    assert val(df, 0.0) == set()


def test_calibration(spark):
    def rows(*pairs):
        return spark.createDataFrame([(i, c, k) for i, (c, k) in enumerate(pairs)], "pos long, confidence double, correct boolean")

    tie = rows((0.5, False), (0.5, True), (0.9, True))
    assert router.calibrate(tie, 1.0, min_accepted=2).first()[0] == 0.5
    assert router.calibrate(tie, 1.0, min_accepted=9).first()[0] == 1.01


def test_calibration_equals_one_pass_over_sorted_rows(spark):
    rng = random.Random(5)
    for trial in range(3):
        steps = (4, 40, 4000)[trial]
        made = [(i, rng.choice([None, *(k / steps for k in range(steps + 1))]), rng.random() < 0.7 or None) for i in range(600)]
        made += [(600 + i, 0.5, rng.random() < 0.6) for i in range(300)]  # a third ties
        rng.shuffle(made)
        df = spark.createDataFrame(made, "pos long, confidence double, correct boolean").repartition(5)
        order = sorted(made, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))
        for target in (0.6, 0.75, 0.99):
            want = 1.01
            for i, (_, c, _k) in enumerate(order):
                votes = [k for _, _, k in order[i:] if k is not None]
                if c is not None and c > 0 and len(order) - i >= 5 and votes and sum(votes) / len(votes) >= target:
                    want = c
                    break
            assert router.calibrate(df, target).first()[0] == want
    assert router.calibrate(df.limit(0), 0.5).first()[0] == 1.01


def test_sketches_let_every_similar_pair_through(monkeypatch):
    """Texts of like size meet as sketches of some bits; whole sets are left to the few pairs that may be similar."""
    import pandas as pd

    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = []
    for _ in range(40):
        words = [word() for _ in range(rng.randrange(40, 90))]
        for edits in (0, 1, 3, 5, 8, 12):
            made = list(words)
            for at in rng.sample(range(len(made)), edits):
                made[at] = word()
            texts.append(" ".join(made)[: rng.randrange(240, 700)])
    sets = [set(near_dup.shingle_set(t).tolist()) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7}
    rows = []
    for pos, s in enumerate(sets):
        places = [(x * 0x9E3779B97F4A7C15 % (1 << 64)) >> 33 for x in s]
        own = near_dup._class_of(len(s), 0.7)
        for c in range(own - near_dup.SPAN, own + near_dup.SPAN + 1):
            low, high = min(own, c), max(own, c)
            n = near_dup._sketch_bits(low, high, 0.7)
            bits = bytearray(n // 8)
            for x in places:
                bits[x % n // 8] ^= 128 >> x % n % 8
            rows.append((low, high, 2 if c == own else int(c < own), pos, len(s), bytes(bits)))
    frame = pd.DataFrame(rows, columns=["low", "high", "side", "pos", "k", "bits"])
    for at_once in (1_024, 7):
        monkeypatch.setattr(near_dup, "AT_ONCE", at_once)
        found = [near_dup._sketch_pairs(0.7)(tile) for _, tile in frame.groupby(["low", "high"])]
        found = [pair for f in found for pair in zip(f["i"].tolist(), f["j"].tolist(), strict=True)]
        assert len(found) == len(set(found)) and want <= set(found)
        assert len(want) > 50 and len(found) < 3 * len(want)


def test_all_pairs_lose_none_among_odd_texts(spark, tmp_path):
    """Every pair that meets the threshold is listed or follows from the class of a copy."""
    from siftstone.plans import catalog

    rng = random.Random(9)
    base = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(50))
    texts = [None, "", "  ", "!!!", "a", "ab", "abcd", "abcde", "abcdef", "ababababab", "abababababab", "Tiny", "tiny!", base, base.upper() + "?"]
    texts += [base[: rng.randrange(200, 300)] + "".join(rng.choices("xyz", k=rng.randrange(0, 40))) for _ in range(40)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    norms = {r.doc_id: r.norm or "" for r in catalog.QUERIES["normalize_text"](spark, str(tmp_path)).collect()}
    sets = {i: set(near_dup.shingle_set(n).tolist()) for i, n in norms.items()}
    want = {(i, j) for j in norms for i in range(j) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7}
    rows = catalog.QUERIES["neardup_all_pairs"](spark, str(tmp_path)).collect()
    first = {i: min(j for j in norms if norms[j] == n) for i, n in norms.items()}
    listed = {(r.i, r.j) for r in rows}
    assert listed <= want and len(listed) == len(rows)
    assert all(first[i] == first[j] or tuple(sorted((first[i], first[j]))) in listed for i, j in want)
    assert all((first[i], i) in listed for i in norms if first[i] != i)


def test_exact_pairs_in_passes(spark, monkeypatch):
    """Pairs don't depend on tiles and passes."""
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdef ", k=90)) for _ in range(6)]
    texts = [t[: rng.randrange(70, 90)] + "".join(rng.choices("xyz", k=4)) for t in base for _ in range(8)]
    reps = spark.createDataFrame(list(enumerate(texts)), "pos long, norm string")
    sets = [near_dup.shingle_set(t) for t in texts]
    alike = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y))
    want = {(i, j) for j in range(len(texts)) for i in range(j) if alike(sets[i], sets[j]) >= 0.7}
    saved = []
    save = near_dup.Scratch.save
    monkeypatch.setattr(near_dup.Scratch, "save", lambda self, df, step: saved.append(step) or save(self, df, step))
    for rows in (2_000, 7):
        monkeypatch.setattr(near_dup, "TILE_ROWS", rows)
        assert {(r.i, r.j) for r in near_dup.exact_pairs(reps).collect()} == want and len(want) > 50
    assert sum(s.startswith("pairs-") for s in saved) > 2
    assert near_dup.exact_pairs(reps.limit(0)).count() == 0


def test_calibration_sums_each_row_once(spark):
    """A frame up to the last row is summed anew for every row, which grows with the square of a range."""
    df = spark.createDataFrame([(i, i / 9, i % 3 > 0) for i in range(9)], "pos long, confidence double, correct boolean")
    plan = router.calibrate(df, 0.6)._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe" in plan and "unboundedfollowing" not in plan


def test_first_of_groups_equals_sorting(spark):
    """A group of a third of all rows, a null group, repeated and null keys, no rows."""
    rng = random.Random(9)
    made = [(f"k{i}", "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i) for i in range(20_000)]
    made += [("same", "dup", i) for i in range(7)] + [(None, "nul", i) for i in range(3)]
    df = spark.createDataFrame(made, "id string, g string, extra int").repartition(4)
    for cap in (0, 1, 5, 900):
        want = {}
        for g in {g for _, g, _ in made}:
            keys = [k for k, h, _ in made if h == g]
            keys.sort(key=lambda k: hashlib.sha256(f"42:{k}".encode()).hexdigest() if k else "")
            want[g] = sorted(map(str, keys[:cap]))
        got = funnel.balance_cap(df, "g", cap)
        assert got.columns == ["id", "g", "extra", "kept"]
        out = got.collect()
        assert len(out) == len(made)
        assert {g: sorted(str(r.id) for r in out if r.g == g and r.kept) for g in want} == want
    assert funnel.balance_cap(df.limit(0), "g", 3).count() == 0


def test_simulation(spark):
    right, wrong = triage(), triage(intent="other")
    ddl = EXAMPLE.split("triage ")[1].rsplit(", source", 1)[0]
    rows = [(right, right, right, True, 0.9), (right, right, wrong, True, 0.2), (right, wrong, None, False, 0.0)]
    df = spark.createDataFrame(rows, f"label {ddl}, teacher {ddl}, student {ddl}, json_valid boolean, confidence double")
    got = router.simulate(df, 0.5).first()
    assert (got.offload_rate, got.exact_match, got.exact_match_offloaded) == (pytest.approx(1 / 3), pytest.approx(2 / 3), 1.0)
    curve = {r.threshold: r.offload_rate for r in router.tradeoff_curve(df).collect()}
    assert len(curve) == 21 and curve[0.0] == pytest.approx(2 / 3) and curve[1.0] == 0
    assert router.simulate(df.limit(0), 0.5).first()["exact_match"] == 0.0


def test_nulls_are_a_class_of_their_own(spark):
    rows = spark.createDataFrame([("None", None), ("None", "None"), (None, None), ("a", "a")], "g string, p string")
    got = {r.label: (r.tp, r.n_gold, r.n_pred) for r in metrics.class_counts(rows, "g", "p").collect()}
    assert got == {"None": (1, 2, 1), None: (1, 1, 2), "a": (1, 1, 1)}


def test_predictions_match_one_to_one(spark):
    gold = spark.createDataFrame([("a", 1), ("b", 2)], "id string, label int")
    one = lambda *ids: spark.createDataFrame([(i, 0) for i in ids], "id string, triage int")
    assert metrics.matched(gold, one("b", "a")).count() == 2
    for wrong in (one("a"), one("a", "b", "c"), one("a", "b", "b")):
        with pytest.raises(Exception, match="differ at id"):
            metrics.matched(gold, wrong).collect()


def test_cost(spark):
    row = spark.range(1)
    take = lambda c: row.select(c).first()[0]
    assert take(cost.api_per_1k(F.lit(500), F.lit(200), F.lit(2.0), F.lit(10.0))) == pytest.approx(3.0)
    assert take(cost.self_hosted_per_1k(F.lit(1.8), F.lit(1.0), F.lit(2))) == pytest.approx(0.25)
    assert take(cost.routed_per_1k(F.lit(0.2), F.lit(3.0), F.lit(0.75))) == pytest.approx(0.95)


def test_confidences(spark):
    df = spark.createDataFrame([('{"intent": "other"', [11, 12, 17, 18], [0.9, 0.8, 0.7, 0.6])], "t string, e array<int>, p array<double>")
    got = df.select(student.field_confidences(F.col("t"), F.col("e"), F.col("p")).alias("m")).first()["m"]
    assert got == {"intent": 0.7}  # the value starts at character 12
    assert df.select(student.answer_confidence(F.create_map(F.lit("intent"), F.lit(0.5)))).first()[0] == 0.0


def test_seed_matrix_is_stable(spark):
    rows = batching.seed_matrix(spark, 33).collect()
    assert len({r.id for r in rows}) == 33 and {r.topic for r in rows} and sorted(r.pos for r in rows) == list(range(33))
    again = {r.id: r.tone for r in batching.seed_matrix(spark, 11).collect()}
    assert all(again[r.id] == r.tone for r in rows if r.id in again)
