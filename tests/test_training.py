"""Training examples and batches against plain programs."""

import hashlib
import sys
from collections import defaultdict

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siftstone.operators import training
from siftstone.plans import catalog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoder():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(PATH)
    return lambda text: model.encode(text, add_special_tokens=False).ids


def written(messages, prompt):
    text = "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in messages)
    return text + "<|im_start|>assistant\n" if prompt else text


def plain(conversations, max_len):
    """(tokens, masked, truncated, ids, labels) by conversation."""
    encode, out = encoder(), {}
    for conv, turns in conversations.items():
        said = [(r or "", t or "") for _, _, r, t in sorted((n is not None, n or 0, r or "", t or "") for n, r, t in turns)]
        while said and said[-1][0] != "assistant":
            said.pop()
        if not said:
            continue
        head, whole = encode(written(said[:-1], True)), encode(written(said, False))
        assert whole[: len(head)] == head
        ids = whole[:max_len]
        labels = [t if k >= len(head) else -100 for k, t in enumerate(ids)]
        out[conv] = (len(ids), labels.count(-100), len(whole) > max_len, ids, labels)
    return out


def test_the_query_equals_a_plain_program(spark):
    sf = "/root/testdata/sf0.001"
    conversations = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        conversations[r.conv_id].append((r.turn, r.role, r.text))
    md5 = lambda x: hashlib.md5(",".join(map(str, x)).encode()).hexdigest()
    want = {c: (*v[:3], md5(v[3]), md5(v[4])) for c, v in plain(conversations, training.MAX_LEN).items()}
    rows = catalog.QUERIES["training_examples"](spark, sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(want) > 10
    buckets = defaultdict(lambda: [0, 0, 0])
    for n, *_ in want.values():
        one = buckets[(n - 1) // training.BUCKET]
        one[0], one[1], one[2] = one[0] + 1, max(one[1], n), one[2] + n
    assert {r.bucket: [r.examples, r.longest, r.tokens] for r in catalog.QUERIES["training_batches"](spark, sf).collect()} == buckets


def records(spark, *made):
    return spark.createDataFrame(list(made), "id string, messages array<struct<role:string,content:string>>, width int")


def test_truncation_and_edges(spark):
    talk = [("system", "Be brief."), ("user", "What is the time of day right now?"), ("assistant", "It is five.")]
    rows = records(spark, ("a", talk, 1), ("none", [], 1), ("nulls", [(None, None), ("assistant", None)], 1), ("one", [("assistant", "x")], 1))
    encode = encoder()
    head, whole = encode(written(talk[:-1], True)), encode(written(talk, False))
    for max_len in (len(whole), len(whole) - 1, len(head) + 1, len(head), len(head) - 3, 1):
        got = {r.id: r for r in training.training_examples(rows, PATH, max_len).collect()}
        assert set(got) == {"a", "nulls", "one"}
        a = got["a"]
        assert a.input_ids == whole[:max_len] and a.truncated == (max_len < len(whole))
        assert a.labels == ([-100] * len(head) + whole[len(head) :])[:max_len] and a.n_masked == min(len(head), max_len)
    assert training.training_examples(rows.limit(0), PATH).collect() == []


def test_a_template_that_writes_earlier_turns_otherwise(spark):
    """The whole record drops what the prompt has; prompt, answer and end are put together."""

    def template(messages, prompt=False):
        kept = messages if prompt else [m for m in messages if m[0] != "system"]
        return written(kept, prompt)

    talk = [("system", "Be brief."), ("user", "Why?"), ("assistant", "Because.")]
    encode = encoder()
    head, answer = encode(written(talk[:-1], True)), encode("Because.")
    for max_len in (500, len(head) + 1, 4):
        (got,) = training.training_examples(records(spark, ("a", talk, 1)), PATH, max_len, eos=7, template=template).collect()
        assert got.input_ids == [*head, *answer, 7][:max_len]
        assert got.labels == [*[-100] * len(head), *answer, 7][:max_len]


def test_conversations_of_any_length_are_cut(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)] + [(2, 0, "user", "never answered")]
    rows += [(3, None, "user", "first"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (3, 2, "user", "more"), (None, 0, "assistant", "x")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, place int")
    got = {r.conv_id: [m.content for m in r.messages] for r in training.answered_conversations(turns, 50).collect()}
    assert got == {1: [f"t{t}" for t in range(50)], 3: ["first", "same", "same"]}
    whole = training.training_examples(training.answered_conversations(turns, 5000), PATH, 50, key="conv_id")
    cut = training.training_examples(training.answered_conversations(turns, 50), PATH, 50, key="conv_id")
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    assert cut.filter("conv_id = 1").first().n_masked == 50


@pytest.mark.parametrize("size", [1, 4])
def test_batches_are_padded_and_whole(spark, size):
    made = [(k, list(range(1, 1 + n)), [-100] * min(2, n) + list(range(3, 1 + n))) for k, n in enumerate([1, 2, 3, 9, 9, 9, 9, 9, 30, 64, 65, 0, 129])]
    df = spark.createDataFrame(made, "id long, input_ids array<int>, labels array<int>").repartition(3)
    got = training.training_batches(df, size, pad=5, bucket=8).collect()
    back = {}
    for r in got:
        assert 1 <= len(r["keys"]) <= size and r.width == max(sum(m) for m in r.attention_mask)
        for key, ids, labels, mask in zip(r["keys"], r.input_ids, r.labels, r.attention_mask, strict=True):
            n = sum(mask)
            assert len(ids) == len(labels) == len(mask) == r.width and mask == [1] * n + [0] * (r.width - n)
            assert ids[n:] == [5] * (r.width - n) and labels[n:] == [-100] * (r.width - n) and (n - 1) // 8 == r.bucket
            back[key] = (ids[:n], labels[:n])
    assert back == {k: (ids, labels) for k, ids, labels in made if ids}
    assert training.training_batches(df.limit(0)).select(F.col("bucket")).collect() == []
