"""Training examples: chat records as token ids with the prompt masked, and padded batches.

An example is the rendered record in token ids, cut at ``max_len``; its labels are the same
ids with everything before the answer masked, so that only the answer is learned. Batches
hold examples of like length, so that padding stays small, and are rows of an Arrow table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The label that a loss leaves out, and the default length of an example.
MASK, MAX_LEN = -100, 512
#: Examples of a batch, and lengths that share a bucket.
BATCH, BUCKET = 16, 64
#: Examples that a task pads at once.
_READ = 512


@dataclass(frozen=True)
class ChatTemplate:
    """How a record is written: each message between marks, then the mark of an answer."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    answers: str = "assistant"

    def __call__(self, messages: Sequence[tuple[str, str]], prompt: bool = False) -> str:
        text = "".join(self.before.format(role=role) + content + self.after for role, content in messages)
        return text + self.before.format(role=self.answers) if prompt else text


def encode_example(
    encode: Callable[[str], list[int]], messages: Sequence[tuple[str, str]], template: Callable, eos: int, max_len: int
) -> tuple[list[int], list[int], int]:
    """(ids, labels, ids before the cut) of a record whose last message is the answer.

    Where the rendered record doesn't begin with the rendered prompt, token for token, the
    prompt, the answer and the end token are put together instead.
    """
    prompt = encode(template(messages[:-1], True))
    whole = encode(template(messages))
    if whole[: len(prompt)] != prompt:
        whole = [*prompt, *encode(messages[-1][1]), eos]
    ids = whole[:max_len]
    masked = min(len(prompt), len(ids))
    return ids, [MASK] * masked + ids[masked:], len(whole)


def training_examples(
    records: DataFrame, tokenizer: str, max_len: int = MAX_LEN, eos: int = 0, template: Callable = ChatTemplate(), key: str = "id"  # noqa: B008
) -> DataFrame:
    """(key, input_ids, labels, n_masked, truncated) of records (key, messages<role, content>).

    ``tokenizer`` is the path of a tokenizer file that all executors reach. The last message
    is the answer; a record without messages gives no example. Null roles and contents are
    empty. An answer that is cut off leaves an example with masked labels only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        encode = lambda text: model.encode(text, add_special_tokens=False).ids
        for batch in batches:
            for at in range(0, batch.num_rows, _READ):
                rows = batch.slice(at, _READ)
                made = []
                for record in rows.column(1).to_pylist():
                    messages = [(m["role"] or "", m["content"] or "") for m in record]
                    made.append(encode_example(encode, messages, template, eos, max_len))
                ints = pa.list_(pa.int32())
                arrays = [
                    rows.column(0),
                    pa.array([m[0] for m in made], ints),
                    pa.array([m[1] for m in made], ints),
                    pa.array([m[1].count(MASK) for m in made], pa.int64()),
                    pa.array([m[2] > max_len for m in made], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "input_ids", "labels", "n_masked", "truncated"])

    kind = records.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, input_ids array<int>, labels array<int>, n_masked long, truncated boolean"
    return records.filter("size(messages) > 0").select(key, "messages").mapInArrow(run, schema)


def answered_conversations(turns: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """(conv_id, messages) of conversations (conv_id, turn, role, text) up to their last assistant turn.

    Every turn is a token at least, so turns after the first ``max_len`` lie behind the cut and
    are not gathered: a conversation of any length is a row of bounded size, and its first
    turns are picked before the exchange. A conversation without assistant turns gives none.
    Turns go by turn (null first), then role and text.
    """
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    first = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    first = first.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    message = F.struct("place", "role", F.col("text").alias("content"))
    first = first.filter(F.col("place") <= max_len).groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("m"))
    later = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.count("*").alias("answers"))
    both = first.join(later, "conv_id")
    here = F.filter("m", lambda x: x["role"] == "assistant")
    # an answer behind the cut leaves all that is here as its prompt
    last = F.when(F.size(here) < F.col("answers"), F.size("m")).otherwise(F.element_at(here, -1)["place"])
    cut = F.slice("m", F.lit(1), last)
    return both.select("conv_id", F.transform(cut, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def padded(rows: Sequence[tuple[list[int], list[int]]], pad: int) -> tuple[list[list[int]], list[list[int]], list[list[int]]]:
    """(ids, labels, attention) of examples, padded on the right to the longest."""
    width = max(len(ids) for ids, _ in rows)
    ids = [i + [pad] * (width - len(i)) for i, _ in rows]
    labels = [x + [MASK] * (width - len(x)) for _, x in rows]
    return ids, labels, [[1] * len(i) + [0] * (width - len(i)) for i, _ in rows]


def training_batches(examples: DataFrame, size: int = BATCH, pad: int = 0, bucket: int = BUCKET, seed: int = 0, key: str = "id") -> DataFrame:
    """(bucket, keys, width, input_ids, labels, attention_mask): padded batches of examples.

    Examples are dealt by bucket of length and a seeded hash, so that a bucket of any size
    spreads over partitions, and taken ``size`` at a time; the last batch of a bucket in a
    partition may be smaller. Examples without ids give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def done() -> pa.RecordBatch:
            ids, labels, attention = padded([(h[1], h[2]) for h in held], pad)
            row = {"bucket": now, "keys": [h[0] for h in held], "width": len(ids[0])}
            return pa.RecordBatch.from_pylist([row | {"input_ids": ids, "labels": labels, "attention_mask": attention}], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                table = pa.list_(pa.list_(pa.int32()))
                keys = pa.list_(batch.schema.field(1).type)
                fields = [("bucket", pa.int64()), ("keys", keys), ("width", pa.int64())]
                schema = pa.schema([*fields, ("input_ids", table), ("labels", table), ("attention_mask", table)])
            for at in range(0, batch.num_rows, _READ):
                rows = batch.slice(at, _READ)
                for b, k, ids, labels in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    if held and (b != now or len(held) == size):
                        yield done()
                        held = []
                    now = b
                    held.append((k, ids, labels))
        if held:
            yield done()

    kind = examples.schema[key].dataType.simpleString()
    table = "array<array<int>>"
    schema = f"bucket long, keys array<{kind}>, width long, input_ids {table}, labels {table}, attention_mask {table}"
    rows = examples.filter("size(input_ids) > 0").select(
        F.floor((F.size("input_ids") - 1) / F.lit(bucket)).alias("bucket"), key, "input_ids", "labels", F.xxhash64(F.lit(seed), key).alias("h")
    )
    n = int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "bucket", "h").sortWithinPartitions("bucket", "h", key)
    return dealt.drop("h").mapInArrow(run, schema)
