"""Token ids as flat unsigned files with 64-bit document offsets.

A shard holds the documents of one doc_id range:

* ``<shard>.bin``: the ids of all its documents one after another, little-endian
  uint16 where the vocabulary fits, else uint32; each document ends with the end id;
* ``<shard>.idx``: uint64 offsets into the ids, one more than there are documents;
* ``<shard>.doc``: int64 doc_ids (null as the least int64).

Shards follow doc_id order. The position of a shard in the whole sequence is the
prefix sum of the id counts before it, taken from a manifest of one row a shard.
A task writes straight to the shared folder under a name of its own, and the manifest
names what counts, so a task that runs twice leaves an unused file at worst.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import accumulate, pairwise
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held, release, scratch_path, text_blocks

NULL_ID = -(2**63)
#: Ids that are put in order and written at once.
PART_IDS = 1 << 18
#: Bytes of remembered words a worker; others are encoded once a block.
CACHE_BYTES = 24 << 20
#: Places, by hash, where a worker marks the words that it has met.
MET_BYTES = 4 << 20
#: What an entry takes beside its key and value: its place in the table.
_ENTRY_BYTES = 100
#: Ids of a remote shard that are read at once.
READ_IDS = 4 << 20

_MANIFEST = "part int, shard string, n_docs long, n_ids long, width int"
_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _byte_letters() -> str:
    """The letter that byte-level BPE vocabularies use for each byte.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    code points from 256 on in ascending order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


class PieceEncoder:
    """Encodes blocks of texts with a byte-level BPE tokenizer file.

    The file's pre-tokenizer never joins characters across a single space that
    follows a visible character, so such texts are cut at their spaces and each
    distinct piece of a block is encoded once, with the same result. Any other text
    goes to the library whole: texts with two spaces in a row, or that hold one of
    the file's added tokens. Pieces with anything but plain Latin characters go to
    the library too. Words met twice are remembered while they fit ``CACHE_BYTES``; most
    are met once only.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.plain = regex.compile(r"[\n\x20-\x7E¡-ɏ]*")
        self.pre = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}
        self.room = cache_bytes
        self.met = bytearray(MET_BYTES)

    def _word(self, word: str) -> bytes:
        """The ids of one word of the pre-tokenizer, remembered from its second time on while there is room."""
        made = self.known.get(word)
        if made is None:
            shown = word.encode("utf-8").decode("latin-1").translate(self.letters)
            made = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            at = hash(word) % MET_BYTES
            if self.met[at]:
                cost = len(word) + len(made) + _ENTRY_BYTES
                if cost <= self.room:
                    self.room -= cost
                    self.known[word] = made
            else:
                self.met[at] = 1
        return made

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not self.plain.fullmatch(piece):
            return self._whole(piece)
        return b"".join(map(self._word, self.pre.findall(piece)))

    def _after_space(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that a space comes before, which is part of them."""
        made: list[bytes | None] = [None] * len(pieces)
        several = []
        for i, piece in enumerate(pieces):
            plain = (piece.isascii() and piece.isprintable()) or self.plain.fullmatch(piece)
            if not piece or not plain or piece[0] == "\n" or piece[-1] == "\n":
                made[i] = self._piece(" " + piece)
            elif piece.isalpha():
                made[i] = self._word(" " + piece)
            else:
                several.append(i)
        # Both ends of these are visible, so that they can be cut into words in one go:
        # a word starts with a space just where a piece starts.
        words = self.pre.findall("".join([f" {pieces[i]}" for i in several]))
        ids = list(map(self._word, words))
        starts = [k for k, word in enumerate(words) if word[0] == " "]
        for i, (a, b) in zip(several, pairwise([*starts, len(words)]), strict=True):
            made[i] = b"".join(ids[a:b])
        return made

    def encode_parts(self, texts: pa.Array, end_id: int) -> tuple[Iterator[np.ndarray], np.ndarray]:
        """(ids of all texts, each with the end id after it, in parts; number of ids by text)."""
        whole = pc.match_substring(texts, "  ")
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        pieces = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        found = pieces.flatten().dictionary_encode()
        made = self._after_space(_strings(found.dictionary))
        # a text is its head, which no space comes before, its other pieces and the end id
        first = pieces.offsets.to_numpy().astype(np.int64)
        first -= first[0]
        heads = pc.take(found.dictionary, pc.take(found.indices, pa.array(first[:-1])))
        at_head = len(made)
        for i, (head, is_whole) in enumerate(zip(heads.to_pylist(), whole.to_pylist(), strict=True)):
            made.append(self._whole(texts[i].as_py()) if is_whole else self._piece(head))
        order = found.indices.to_numpy().copy()
        order[first[:-1]] = np.arange(at_head, len(made))
        order = np.insert(order, first[1:], len(made))
        made.append(array("I", [end_id]).tobytes())

        sizes = np.fromiter(map(len, made), np.int32, len(made)) // 4
        flat = np.frombuffer(b"".join(made), "<u4")
        lengths = sizes[order]
        by_text = np.add.reduceat(lengths, first[:-1] + np.arange(len(texts)), dtype=np.int64)
        return self._gathered(flat, sizes, order, lengths), by_text

    @staticmethod
    def _gathered(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of the pieces in order, at most ``PART_IDS`` at once or those of one piece."""
        ends = np.cumsum(lengths, dtype=np.int64)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        a = 0
        while a < len(order):
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + PART_IDS, side="right")))
            at = np.repeat(starts[order[a:b]] - (ends[a:b] - lengths[a:b] - done), lengths[a:b])
            at += np.arange(len(at))
            yield flat[at]
            a = b

    def encode_block(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id after it; number of ids by text)."""
        parts, sizes = self.encode_parts(texts, end_id)
        return np.concatenate(list(parts)), sizes

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian uint32 bytes."""
        return self.encode_block(pa.array([text]), 0)[0][:-1].tobytes()


def _strings(pieces: pa.Array) -> list[str]:
    """The strings of an array without any space in them."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")
    return joined[0].as_py().split(" ") if len(pieces) else []


def _encoder(path: str) -> PieceEncoder:
    return held("pieces", path, lambda: PieceEncoder(path))


def _local(path: str) -> str | None:
    """The path on a mounted file system, or None for a remote store."""
    at = urlparse(path)
    return at.path if at.scheme in ("", "file") else None


def _store(path: str):
    """(file system, path in it) of a remote store; Hadoop's names of S3 are S3."""
    from pyarrow import fs

    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


@contextmanager
def _writing(path: str):
    """A stream to a new file on a mounted or remote store."""
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as out:
            yield out
    else:
        store, at = _store(path)
        with store.open_output_stream(at) as out:
            yield out


def _write(tokenizer: str, end_id: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        width = 2 if encoder.size <= 1 << 16 else 4
        context = TaskContext.get()
        shard = f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}"
        # 16 bytes a document of the partition stay here until its ids are written
        lengths, docs = [np.zeros(0, "<i8")], [np.zeros(0, "<i8")]
        with _writing(shard + ".bin") as out:
            for batch in batches:
                for block in text_blocks(batch):
                    parts, sizes = encoder.encode_parts(block.column(1), end_id)
                    for ids in parts:
                        out.write(ids.astype(f"<u{width}"))
                    lengths.append(sizes.astype("<i8"))
                    docs.append(block.column(0).fill_null(NULL_ID).to_numpy().astype("<i8"))
        sizes = np.concatenate(lengths)
        with _writing(shard + ".idx") as out:
            out.write(np.r_[0, np.cumsum(sizes)].astype("<u8").tobytes())
        with _writing(shard + ".doc") as out:
            out.write(np.concatenate(docs).tobytes())
        release()
        row = {"part": context.partitionId(), "shard": shard, "n_docs": len(sizes), "n_ids": int(sizes.sum()), "width": width}
        if len(sizes):
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            arrays = [pa.array([v], kind) for v, kind in zip(row.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(row))

    return run


def write_token_files(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None
) -> DataFrame:
    """Encode whole texts into shards in ascending doc_id order; returns the manifest.

    The manifest (part, shard, n_docs, n_ids, width) has one row a shard, in
    ``part`` order. Null text counts as empty and gives the end id alone. Rows with
    equal doc_id keep the order of their texts; null doc_ids come first. An empty
    table writes no shard that counts. Columns other than doc_id and text are not
    read, whatever their names. ``folder`` is a new folder.
    """
    folder = folder or scratch_path(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    made = dealt.mapInArrow(_write(tokenizer, end_id, folder), _MANIFEST)
    return Scratch(spark, "token-manifest").save(made, "shards")


def _ids_of(shard: str, width: int, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each document of a shard: mapped, or read in parts from a remote store."""
    kind = f"<u{width}"
    if local := _local(shard):
        ids = np.memmap(local + ".bin", kind, "r")
        yield from (ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))
        return
    store, at = _store(shard + ".bin")
    with store.open_input_stream(at) as src:
        first = 0
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + READ_IDS, side="right")) - 1)
            ids = np.frombuffer(src.read(int(offsets[last] - offsets[first]) * width), kind)
            for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1], strict=True):
                yield ids[a - offsets[first] : b - offsets[first]]
            first = last


def _numbers(path: str, kind: str) -> np.ndarray:
    if local := _local(path):
        return np.memmap(local, kind, "r")
    store, at = _store(path)
    with store.open_input_stream(at) as src:
        return np.frombuffer(src.read(), kind)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, base, width in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            offsets = _numbers(shard + ".idx", "<u8").astype(np.int64)
            docs = _numbers(shard + ".doc", "<i8")
            crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in _ids_of(shard, width, offsets)]
            arrays = [
                pa.array(docs, mask=docs == NULL_ID),
                pa.array(offsets[:-1] + base),
                pa.array(np.diff(offsets)),
                pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read shards back: doc_id, start, n_tokens, ids_crc32 of every document.

    ``start`` counts the ids of all documents before it over all shards. A document has its
    end token at least, rows that repeat a doc_id are documents of their own, and no shards
    give an empty table.
    """
    # One row a shard: bounded by the number of partitions that wrote.
    shards = manifest.orderBy("part").collect()
    bases = [0, *accumulate(s.n_ids for s in shards)]
    rows = [(s.shard, b, s.width) for s, b in zip(shards, bases, strict=False)]
    table = spark.createDataFrame(rows, "shard string, base long, width int")
    return table.repartition(max(1, len(rows))).mapInArrow(_read, _DOCS)
