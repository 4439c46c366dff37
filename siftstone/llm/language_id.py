"""Language by compression: the smallest zstandard encoding wins.

Each language has a raw-content dictionary cut from texts of that language. A text
is normalised (lower-cased; anything in ASCII but a-z becomes one space), cut into
pieces of ``PIECE_BYTES`` so that the dictionary counts all along, and every piece
of the whole text is encoded with every dictionary. The language with the smallest
sum is chosen; the margin to the second is the score, and a narrow one is rejected.
zstandard stores a short text as it is where that is no longer, so that all sizes tie;
a text of at most ``SHORT_BYTES`` with a narrow margin is judged by its size ``COPIES``
times over instead, where the dictionary's matches count.

Every language is learned, from a bounded sample: ``SAMPLE_ROWS`` rows in hash order and
``DICT_BYTES`` bytes of dictionary a language. Beyond ``FULL_LANGS`` languages they share
what so many would have, down to ``LEAST_ROWS`` rows and ``LEAST_BYTES`` bytes each.
Everything else covers all rows and whole texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import held, release, text_blocks

SAMPLE_ROWS = 120
DICT_BYTES = 65_536
#: Sampled texts are cut into pieces of so many bytes, so that many rows share a dictionary.
SAMPLE_PIECE = 1_024
#: So many languages have a whole sample and dictionary.
FULL_LANGS = 64
LEAST_ROWS, LEAST_BYTES = 8, 1_024
PIECE_BYTES = 2_048
COPIES = 8
SHORT_BYTES = PIECE_BYTES // COPIES
LEVEL = 6
#: Margins below this share of the second-best size are narrow.
NARROW = 0.01
UNDETERMINED = "und"

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    return b" " + b" ".join(words) + b" "


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) as (lang, place, piece): normalised whole texts cut into pieces, in hash order."""
    import xxhash

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = normalised(text.as_py())
            pieces = [raw[i : i + SAMPLE_PIECE] for i in range(0, len(raw), SAMPLE_PIECE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(pieces), pa.string()),
                    pa.array([xxhash.xxh3_64_intdigest(p, i) >> 1 for i, p in enumerate(pieces)], pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                names=["lang", "place", "piece"],
            )


def learn_dictionaries(docs: DataFrame, learn: Column) -> tuple[tuple[str, bytes], ...]:
    """(language, dictionary) pairs, the most frequent language first.

    Only rows where ``learn`` holds and text and lang are not null are looked at.
    The sample is the rows with the smallest hash of doc_id, so reruns agree. Their
    whole texts are cut into pieces, and pieces in hash order fill the dictionary.
    """
    rows = docs.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"), "text"
    )
    top = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not top:
        return ()
    crowd = max(len(top), FULL_LANGS)
    n_rows = max(SAMPLE_ROWS * FULL_LANGS // crowd, LEAST_ROWS)
    n_bytes = max(DICT_BYTES * FULL_LANGS // crowd, LEAST_BYTES)
    # A hash threshold a language that lets through about four times the sample.
    share = {r["lang"]: min(1.0, 4.0 * n_rows / r["count"]) for r in top}
    cut = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v)])[F.col("lang")]
    some = rows.filter((F.col("h") / F.lit(2.0**64) + 0.5) < cut)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    some = some.withColumn("rank", rank).filter(F.col("rank") <= n_rows).select("lang", "text")
    pieces = some.mapInArrow(_cut, "lang string, place long, piece binary")
    order = Window.partitionBy("lang").orderBy("place", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("piece")).over(order), F.lit(0))
    pieces = pieces.withColumn("before", before).filter(F.col("before") < n_bytes)
    # What a dictionary holds and a piece more at most, by language.
    by: dict[str, list] = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: (r["lang"], r["before"])):
        by[r["lang"]].append(r["piece"])
    return tuple((r["lang"], b"".join(by[r["lang"]])[:n_bytes]) for r in top)


class LanguageModel:
    """Compressors by language; predicts from whole texts."""

    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        import zstandard

        self.langs: list[str] = []
        self.encode = []
        for lang, raw in dictionaries:
            kept = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(level=LEVEL)
            made = zstandard.ZstdCompressor(
                dict_data=kept, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self.langs.append(lang)
            self.encode.append(made.compress)

    def sizes(self, text: str) -> list[int]:
        raw = normalised(text)
        pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        return [sum(len(f(p)) for p in pieces) for f in self.encode]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, margin); equal sizes go to the more frequent language."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        lang, margin = self._least(self.sizes(text))
        if margin < NARROW and len(raw := normalised(text)) <= SHORT_BYTES:
            return self._least([len(f(raw * COPIES)) for f in self.encode])
        return lang, margin

    def _least(self, sizes: list[int]) -> tuple[str, float]:
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.langs[best], (second - sizes[best]) / second


def _model(dictionaries: tuple[tuple[str, bytes], ...]) -> LanguageModel:
    return held("languages", dictionaries, lambda: LanguageModel(dictionaries))


def identify_language(docs: DataFrame, dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """One row per document row: doc_id, lang_pred, score, rejected.

    Text that is null or has no letter is ``und`` with score 0. ``rejected`` marks
    these and narrow margins; the prediction stays beside it. Without anything
    learned every row is ``und``. Repeated rows get equal answers; an empty table
    gives an empty result; only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(dictionaries)
        for batch in batches:
            got = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[0] == UNDETERMINED or g[1] < NARROW for g in got], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """The rows whose language is not rejected, all columns as they are.

    Null texts and texts without letters are rejected; without any learned language all
    rows are. Repeated rows are judged alike. Columns may have any names but ``text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(dictionaries)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for block in text_blocks(batch):
                got = [model.predict(t.as_py()) for t in block.column(at)]
                yield block.filter(pa.array([g[0] != UNDETERMINED and g[1] >= NARROW for g in got], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo; the folds of the contracts."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor
