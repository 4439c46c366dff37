"""Scalar functions against small tables of cases."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from siftstone.functions import pii, text
from siftstone.functions.contract import answer_values, check_triage, identified, normalize_order_id, triage_json
from siftstone.functions.heuristics import with_keyword_triage
from siftstone.schemas import TRIAGE


def one(spark, column, *values):
    """The value of a column over rows of a single string v."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_order_ids(spark):
    read = {"104477": "BL-104477", "\t# 104477": "BL-104477", "Bl104477": "BL-104477", "#bl - 104477\n": "BL-104477", "None": None, " NULL ": None, "bl-1044": "BL-1044", "x104477": "X104477"}
    assert one(spark, normalize_order_id(F.col("v")), *read, None) == [*read.values(), None]


def test_pii(spark):
    hit = ["to kim.l@mail.example", "ring (212) 555-0188 please", "5500 0000 0000 0004", "q@r.io / 212-555-0188"]
    assert one(spark, pii.scrub(F.col("v")), *hit) == ["to [EMAIL]", "ring [PHONE] please", "[CARD]", "[EMAIL] / [PHONE]"]
    clean = ["order BL-777001", "70 °F at 9:30", "release 10.4", "18.50 EUR", " "]
    assert one(spark, pii.scrub(F.col("v")), *clean) == clean
    assert one(spark, pii.counts(F.col("v")), "q@r.io s@t.io", "none") == [{"email": 2}, {}]


def test_text(spark):
    assert one(spark, text.word_count(F.col("v")), "", "  ", " a\tb \n c") == [0, 0, 3]
    assert one(spark, text.near_normal(F.col("v")), "Héllo, 42 Worlds!", "日本") == ["h llo 00 worlds", ""]
    assert one(spark, F.sort_array(text.char_shingles(F.col("v"), 3)), "abcdabcd", "ab", "") == [
        ["abc", "bcd", "cda", "dab"],
        ["ab"],
        [""],
    ]
    assert one(spark, text.rouge_l(F.lit("the cat sat"), F.col("v")), "The CAT sat!", "a cat ran", "") == [1.0, pytest.approx(1 / 3), 0.0]
    import hashlib

    want = [int(hashlib.sha256(t.encode()).hexdigest(), 16) % 13 for t in ("a", "bc")]
    assert one(spark, text.hash_remainder(F.col("v"), 13), "a", "bc") == want


def test_json_in_answers():
    found = {
        ' [3, {"k": "é"}]\n': [3, {"k": "é"}],
        "```JSON [1]```": [1],
        "```\n\"x\"\n```": "x",
        "null": None,
        'Well {this} is {"k": [1]} and {"k": 2}': {"k": [1]},
    }
    for answer, value in found.items():
        assert answer_values(answer) == [value]
    assert answer_values("{ } }") == [{}] and answer_values("[1, 2") == answer_values("plain words {") == answer_values("") == []


def test_items_of_batch_answers():
    assert identified('{"items": [{"k": 1, "id": "a"}, 5, {"id": 7}, {"k": 2}]}') == [("a", {"k": 1}), ("7", {}), ("", {"k": 2})]
    assert identified('[{"id": "b", "x": {"id": "c"}}]') == [("b", {"x": {"id": "c"}})]
    cut = 'So: {"items": [{"id": "a", "x": {"id": "in"}}, {"id": broken}, {"id": "b"}, {"id": "c", "x'
    assert identified(cut) == [("a", {"x": {"id": "in"}}), ("b", {})]
    assert identified('{"items": []}') == [] and identified("no answer") is None and identified('{"k": 1}') is None


def test_batches_take_the_id_anywhere(spark):
    from siftstone.operators.teacher import MISSING, UNREADABLE, parse_batches

    fields = {"intent": "other", "urgency": "low", "sentiment": "neutral", "product_area": "none", "order_id": None, "summary": "Some words here."}
    good = json.dumps(fields)
    first, last = '{"id": "a", ' + good[1:], good[:-1] + ', "id": "b"}'
    wrong = json.dumps({"intent": "x", "id": "c", **{k: v for k, v in fields.items() if k != "intent"}})
    answers = [(1, f"[{wrong}, {first}, {last}, {wrong.replace('neutral', 'odd')}]"), (2, "nothing")]
    ids = [(1, i) for i in "abcd"] + [(2, "e"), (3, "f")]
    frames = spark.createDataFrame(answers, "batch int, text string"), spark.createDataFrame(ids, "batch int, id string")
    got = {r.id: (r.triage is not None, r.error) for r in parse_batches(*frames).collect()}
    assert got["a"] == got["b"] == (True, None)
    assert got["c"] == (False, "intent: not an allowed value; sentiment: not an allowed value")
    assert got["d"] == (False, MISSING) and got["e"] == got["f"] == (False, UNREADABLE)


def test_contract(spark):
    good = '{"intent": "other", "urgency": "low", "sentiment": "neutral", "product_area": "none", "order_id": null, "summary": "Some   words here."}'
    bad = [
        good.replace('"low"', '"slow"'),
        good.replace("null", "7"),
        good[:-1] + ', "more": 1}',
        good.replace("Some   words here.", "w " * 31),
        good.replace('"order_id": null, ', ""),
        "[1, 2]",
        None,
    ]
    got = one(spark, check_triage(F.col("v")), good, *bad)
    assert got[0].triage.summary == "Some words here." and got[0].error is None and got[0].json_valid
    assert all(g.triage is None and g.error for g in got[1:])
    assert [g.json_valid for g in got[1:]] == [True] * 6 + [False]
    assert one(spark, triage_json(F.from_json("v", TRIAGE)), good)[0].startswith('{"intent": "other", "urgency": "low"')


def test_keyword_triage(spark):
    rows = [(0, "Where is my order #BL-123456? The camera package is late!!"), (1, "")]
    df = with_keyword_triage(spark.createDataFrame(rows, "i int, v string"), F.col("v"))
    got = [r.k for r in df.orderBy("i").collect()]
    assert (got[0].intent, got[0].product_area, got[0].order_id, got[0].sentiment) == ("order_status", "camera", "BL-123456", "negative")
    assert (got[1].intent, got[1].confidence, got[1].urgency) == ("other", 0.35, "low")


def test_rouge_l_equals_the_whole_table(spark):
    rng = random.Random(3)
    made = [tuple(" ".join(rng.choice("a b c d é 7".split()) for _ in range(rng.randrange(0, 90))) for _ in "ab") for _ in range(150)]
    made += [("", "a"), ("a", "")]

    def plain(a, b):
        a, b = a.split(), b.split()
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        common = table[-1][-1]
        return 2 * common / (len(a) + len(b)) if common else 0.0

    df = spark.createDataFrame([(i, *ab) for i, ab in enumerate(made)] + [(-1, None, "a")], "i long, a string, b string")
    got = {r.i: r.s for r in df.select("i", text.rouge_l(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got.pop(-1) is None
    assert got == {i: pytest.approx(plain(*ab)) for i, ab in enumerate(made)}


def test_scrubbing_equals_replacing_in_turn(spark):
    """Texts of digits and signs, where matches touch each other and the ends."""
    rng = random.Random(4)
    parts = ["+49 ", "(030) ", "123", "45", "6789", " ", "-", ".", "x", "a@b.co ", "4111 1111 1111 1111", "\n", "é", "_"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(600)]
    made.append("a@b.co, 4111 1111 1111 1111 or +49 30 123 4567")

    def plain(value):
        value = re.sub(pii.EMAIL, "[EMAIL]", value)
        value = re.sub(pii.CARD, "[CARD]", value)
        phone = lambda m: "[PHONE]" if sum(c.isdigit() for c in m[0]) >= pii.PHONE_DIGITS else m[0]
        return re.sub(pii.PHONE, phone, value)

    df = spark.createDataFrame(list(enumerate(made)), "i long, t string")
    got = {r.i: r.s for r in df.select("i", pii.scrub(F.col("t")).alias("s")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(made)}
    assert sum("[PHONE]" in t for t in got.values()) > 50
    both = pii.with_scrubbed(df.withColumn("want", pii.counts(F.col("t"))), "t", "clean", "found").collect()
    assert {r.i: r.clean for r in both} == got and all(r.found == r.want for r in both)
    kinds = {frozenset(r.found) for r in both}  # a map has no order
    assert kinds >= {frozenset(k) for k in ((), ("email",), ("card",), ("phone",), ("email", "card", "phone"))}
    none = pii.with_scrubbed(spark.createDataFrame([(None,)], "t string"), "t", "clean", "found").first()
    assert none.clean is None and not none.found
