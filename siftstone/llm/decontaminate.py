"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lower-cased, words are
runs of digits, letters a-z and every character from U+0080 on. A window is ten
consecutive words of an item, or the whole item where it is shorter.

Any ten consecutive words of an item contain one of its five-word pieces that
start at a multiple of five, so the automaton holds these pieces only (and short
items whole): about as many nodes as the benchmark has bytes, not ten times as
many. A document is scanned once; the windows around the pieces found are looked up
among the distinct windows of all items, each once however often a text repeats it, and
compared word by word. Word positions map back to offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held, release, text_blocks

WINDOW = 10
#: Benchmark bytes that one automaton may hold; a larger benchmark goes in blocks.
BLOCK_BYTES = 4_000_000

# Every byte but 0-9, a-z, A-Z and 0x80-0xFF separates words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")

_HITS = "n_words long, hits array<struct<first:long,last:long>>, spans array<struct<start:long,stop:long>>, items array<string>"


_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """A 64-bit hash of each run of ``window`` words."""
    import xxhash

    n = len(words) - window + 1
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(window):
        out = (out ^ each[k : k + n]) * _ODD
        out ^= out >> np.uint64(29)
    return out


class Scanner:
    """Finds the windows of one block of items in texts."""

    def __init__(self, items: tuple[tuple[str, str], ...], window: int):
        import ahocorasick

        self.window, self.piece = window, max(1, window // 2)
        self.ids: list[str] = []
        self.words: list[list[bytes]] = []
        short: dict[bytes, list[str]] = defaultdict(list)
        pieces: set[bytes] = set()
        made: list[tuple[np.ndarray, np.ndarray]] = []
        for item_id, text in items:
            words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
            if 0 < len(words) < window:
                short[b" ".join(words)].append(item_id)
            elif words:
                for p in range(0, len(words) - self.piece + 1, self.piece):
                    pieces.add(b" ".join(words[p : p + self.piece]))
                made.append(np.unique(window_hashes(words, window), return_index=True))
                self.ids.append(item_id)
                self.words.append(words)
        # the distinct windows of each item: hash, item, place of the first
        hashes = np.concatenate([h for h, _ in made]) if made else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(made), dtype=np.int32), [len(h) for h, _ in made])
        places = np.concatenate([p for _, p in made]).astype(np.int32) if made else np.empty(0, np.int32)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.places = hashes[order], owner[order], places[order]
        self.automaton = ahocorasick.Automaton()
        for key in pieces | short.keys():
            # one letter a byte; the spaces around it keep to whole words
            value = (len(key), key.count(b" ") + 1, key in pieces, tuple(short.get(key, ())))
            self.automaton.add_word(f" {key.decode('latin-1')} ", value)
        self.empty = not (pieces or short)
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str], bytes]:
        """Number of words, merged runs of hit words (end exclusive), items, normalised bytes."""
        norm = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)
        words = norm.split()
        if self.empty or not words:
            return len(words), [], [], norm
        found = list(self.automaton.iter(f" {b' '.join(words).decode('latin-1')} "))
        if not found:
            return len(words), [], [], norm
        index, at = {}, 1
        for i, w in enumerate(words):
            index[at] = i
            at += len(w) + 1
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        near = np.zeros(len(words) + 1, np.int32)  # where windows start that hold a piece
        last = len(words) - self.window
        for end, (size, n, piece, whole) in found:
            i = index[end - size]
            if whole:
                runs.append((i, i + n))
                items.update(whole)
            if piece and last >= 0:
                near[max(0, i + n - self.window)] += 1
                near[min(i, last) + 1] -= 1
        starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        starts = starts[starts <= last]
        if len(starts):
            values, first, which = np.unique(window_hashes(words, self.window)[starts], return_index=True, return_inverse=True)
            hit = np.zeros(len(values), bool)
            low, high = (np.searchsorted(self.hashes, values, side) for side in ("left", "right"))
            for v in np.flatnonzero(high > low):
                own = words[starts[first[v]] : starts[first[v]] + self.window]
                for k in range(low[v], high[v]):
                    p = self.places[k]
                    if self.words[self.owner[k]][p : p + self.window] == own:
                        hit[v] = True
                        items.add(self.ids[self.owner[k]])
            runs += [(int(w), int(w) + self.window) for w in starts[hit[which]]]
        return len(words), merged(runs), sorted(items), norm


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open runs, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(norm: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets in the original text of runs of words."""
    if not runs:
        return []
    at = [(m.start(), m.end()) for m in _WORD.finditer(norm)]
    out, done, points = [], 0, 0
    for byte in (b for first, last in runs for b in (at[first][0], at[last - 1][1])):
        # continuation bytes are those that start with the bits 10
        part = np.frombuffer(norm, np.uint8, byte - done, done)
        done, points = byte, points + len(part) - int(np.count_nonzero((part & 0xC0) == 0x80))
        out.append(points)
    return list(zip(out[::2], out[1::2], strict=True))


def _scanner(items: tuple[tuple[str, str], ...], window: int) -> Scanner:
    return held("benchmark", (items, window), lambda: Scanner(items, window))


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[tuple[str, str], ...]]:
    """Items as (id as string, text), in blocks of bounded size.

    Null ids and items without words have no windows. A block is what one
    automaton holds, and all that the driver has of the benchmark at once.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").dropna()
    block: list[tuple[str, str]] = []
    size = 0
    for row in items.toLocalIterator():
        n = len(row.text.encode("utf-8", "surrogatepass"))
        if block and size + n > block_bytes:
            yield tuple(block)
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += n
    yield tuple(block)


def _scan_block(docs: DataFrame, items: tuple[tuple[str, str], ...], window: int, offsets: bool) -> DataFrame:
    key = docs.columns[0]
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {_HITS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(items, window)
        for batch in batches:
            keys, counts, hits, spans, ids = [], [], [], [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, runs, found, norm = scanner.scan(text.as_py())
                keys.append(k)
                counts.append(n)
                hits.append([{"first": a, "last": b} for a, b in runs])
                spans.append([{"start": a, "stop": b} for a, b in original_spans(norm, runs if offsets else [])])
                ids.append(found)
            pair = lambda a, b: pa.list_(pa.struct([(a, pa.int64()), (b, pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, batch.schema.field(0).type),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pair("first", "last")),
                    pa.array(spans, pair("start", "stop")),
                    pa.array(ids, pa.list_(pa.string())),
                ],
                names=[key, "n_words", "hits", "spans", "items"],
            )

    return docs.mapInArrow(run, schema)


def _merge_hits(spark: SparkSession, docs: DataFrame, blocks, window: int, offsets: bool) -> DataFrame:
    """The way for a benchmark of several blocks: scan by block, then merge by row."""
    scratch = Scratch(spark, "decontaminate")
    rows = scratch.save(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    keyed = rows.select("_row", "text")
    parts = [scratch.save(_scan_block(keyed, b, window, offsets), f"block-{i}") for i, b in enumerate(blocks)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part.filter(F.size("hits") > 0))
    flat = lambda c: F.array_sort(F.flatten(F.collect_list(c)))
    every = both.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        flat("hits").alias("hits"),
        flat("spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = rows.select("_row", "doc_id").join(every, "_row").drop("_row")
    return joined.withColumn("hits", _union("hits", "first", "last")).withColumn("spans", _union("spans", "start", "stop"))


def _union(column: str, first: str, last: str):
    """Union of sorted half-open runs as an expression."""
    return F.expr(
        f"""aggregate({column}, cast(array() AS array<struct<{first}:long,{last}:long>>), (done, x) ->
              CASE WHEN size(done) > 0 AND x.{first} <= element_at(done, -1).{last}
                   THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
                          '{first}', element_at(done, -1).{first},
                          '{last}', greatest(element_at(done, -1).{last}, x.{last}))))
                   ELSE concat(done, array(x)) END)"""
    )


def find_contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, offsets: bool = True
) -> DataFrame:
    """One row per document row: doc_id, n_words, hits, spans, items.

    ``hits`` are runs of hit words (first, last exclusive), ``spans`` the same as
    code points of the original text (empty without ``offsets``), ``items`` the ids (as sorted strings) of the
    items that have an occurring window. Null and empty texts have no words and no
    hits; an empty benchmark hits nothing; repeated rows and repeated items count as
    they are (an item id once); other columns are not read.
    """
    blocks = benchmark_blocks(benchmark, block_bytes)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _scan_block(keyed, first, window, offsets)
    return _merge_hits(spark, keyed, chain((first, second), blocks), window, offsets)


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without any hit, all columns as they are.

    Null and empty texts have no words and stay, as do all rows where the benchmark is
    empty; each of repeated rows is judged alone. Columns may have any names but ``text``.
    """
    out = docs
    for items in benchmark_blocks(benchmark):
        out = _keep_clean(out, items, window)
    return out


def _keep_clean(docs: DataFrame, items: tuple[tuple[str, str], ...], window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(items, window)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for block in text_blocks(batch):
                clean = [not scanner.scan(t.as_py())[1] for t in block.column(at)]
                yield block.filter(pa.array(clean, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def contamination_digest(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def digest_of(items: list[str]) -> str:
    """The digest of item ids that the query returns."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
