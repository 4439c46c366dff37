"""How far the sources of a language differ: distances between their word shares.

One pass over the texts counts terms by (lang, source). The terms that enough documents of
a language hold make its vocabulary, which is dealt into chunks; a source's counts in a
chunk are one packed row. The distances of all pairs of sources are computed by tiles:

* sources are cut into blocks, and each packed row is copied to the tiles of its block
  with every block of the language, so a pair of sources meets in one tile;
* a tile reads the chunks one after the other and holds the rows of two blocks for one
  chunk, and the sums of its submatrix;
* stripes of chunks are tiles of their own, whose sums are added, so that a language with
  few sources and a large vocabulary is many tasks too.

Shares are whole numbers and all sums are exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, release

#: Distinct (lang, source, term) that a task counts before it passes them on.
HELD_TERMS = 200_000
#: A share of 1 as a whole number.
UNIT = 1_000_000_000
#: Occurrences that every term of the vocabulary gets besides its own.
PRIOR = 5

#: What parts terms becomes a space: all of ASCII but letters; A-Z are lower-cased.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Audit:
    """Least documents of a term, terms listed a source, and the sizes of tiles."""

    least_docs: int = 30
    top: int = 50
    chunk: int = 4_096
    stripe: int = 16
    block: int = 32


_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("c", pa.int64()), ("df", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms, occurrences and documents of each group; a row without term for the group itself."""
    times: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in times.items():
            terms, df = list(counts), docs[lang, source]
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array([None if t is None else t.decode("utf-8", "surrogatepass") for t in part], pa.string()),
                        pa.array([counts[t] for t in part], pa.int64()),
                        pa.array([df[t] for t in part], pa.int64()),
                    ],
                    schema=_COUNTED,
                )
        times.clear()
        docs.clear()

    for batch in batches:
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for group, text in zip(groups, batch.column(2).cast(pa.binary()), strict=True):
            words = text.as_py().translate(_TERMS).split()
            times[group][None] += 0
            times[group].update(words)
            docs[group].update(set(words))
        if sum(map(len, times.values())) > HELD_TERMS:
            yield from flush()
    yield from flush()
    release()


def exact_shares(counts: np.ndarray, total: int) -> np.ndarray:
    """floor(UNIT * counts / total), exactly, for 0 <= counts <= total."""
    digits, rest, out = 9, counts.astype(np.int64), np.zeros(len(counts), np.int64)
    # as many decimal digits at once as leave room in 64 bits
    step = 9 if total < 9 * 10**9 else 3 if total < 9 * 10**15 else 1
    if total >= 9 * 10**17:
        return np.array([UNIT * int(c) // total for c in counts], np.int64)
    for _ in range(digits // step):
        whole, rest = np.divmod(rest * 10**step, total)
        out = out * 10**step + whole
    return out


_TILE = "lang string, a int, b int, value long"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of the sources of each tile; rows come by (lang, stripe, lo, hi, chunk, g)."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
    tile = chunk = sums = None
    ids: list[int] = []
    blocks: list[int] = []
    rows: list[np.ndarray] = []

    def add() -> None:
        """The distances within one chunk; each source of the low block against the high one."""
        nonlocal sums
        shares, of = np.stack(rows), np.array(blocks)
        low, high = (np.flatnonzero(of == b) for b in tile[2:])
        if sums is None:
            sums = np.zeros((len(low), len(high)), np.int64), np.array(ids)[low], np.array(ids)[high]
        across = shares[high]
        for i, row in enumerate(low):
            sums[0][i] += np.abs(across - shares[row]).sum(axis=1, dtype=np.int64)

    def done() -> pa.RecordBatch:
        values, low, high = sums
        i, j = np.nonzero(low[:, None] < high[None, :])
        arrays = [pa.array([tile[0]] * len(i), pa.string()), pa.array(low[i], pa.int32()), pa.array(high[j], pa.int32())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(values[i, j])], schema=schema)

    for batch in batches:
        for lang, stripe, lo, hi, at, g, block, words, terms, size, pos, counts in zip(*batch.columns, strict=True):
            now = lang.as_py(), stripe.as_py(), lo.as_py(), hi.as_py()
            if rows and (now, at.as_py()) != (tile, chunk):
                add()
                ids, blocks, rows = [], [], []
            if now != tile:
                if sums is not None:
                    yield done()
                tile, sums = now, None
            chunk = at.as_py()
            total = words.as_py() + PRIOR * terms.as_py()
            held = np.full(size.as_py(), PRIOR, np.int64)
            if pos.is_valid:
                held[pos.values.to_numpy()] += counts.values.to_numpy()
            ids.append(g.as_py())
            blocks.append(block.as_py())
            # at most UNIT + 1, and so are the differences
            rows.append((exact_shares(held, total) + 1).astype(np.int32) if total else np.zeros(0, np.int32))
    if rows:
        add()
        yield done()
    release()


def _share(count: str, total: str) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / total) in decimals."""
    return F.expr(f"1 + (CAST({UNIT} AS decimal(10, 0)) * CAST({count} + {PRIOR} AS decimal(20, 0))) DIV CAST({total} AS decimal(20, 0))")


class _Audit:
    def __init__(self, spark: SparkSession, docs: DataFrame, rule: Audit):
        self.spark, self.rule, self.scratch = spark, rule, Scratch(spark, "audit")
        names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
        self.docs = docs.select(*names)

    def count(self) -> None:
        """The vocabulary, the counts of every source in it, and the groups with their totals."""
        rule, save = self.rule, self.scratch.save
        counted = self.docs.mapInArrow(_count, "lang string, source string, term string, c long, df long")
        counted = save(counted.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("df").alias("df")), "counted")
        terms = counted.filter("term IS NOT NULL")
        kept = terms.groupBy("lang", "term").agg(F.sum("c").alias("lang_c"), F.sum("df").alias("df")).filter(f"df >= {rule.least_docs}")
        kept = save(kept.drop("df"), "kept")
        langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_c").alias("lang_n"))
        groups = counted.filter("term IS NULL").select("lang", "source")
        zero = F.lit(0).cast("long")
        langs = groups.select("lang").distinct().join(langs, "lang", "left").fillna(0, ["v", "lang_n"])
        langs = langs.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(rule.chunk))).cast("long"))
        langs = save(langs, "langs")
        chunked = kept.join(langs.select("lang", "chunks"), "lang").withColumn("chunk", F.expr("pmod(xxhash64(term), chunks)")).drop("chunks")
        pos = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1
        self.vocabulary = save(chunked.withColumn("pos", pos), "vocabulary")
        held = terms.select("lang", "source", "term", "c").join(self.vocabulary, ["lang", "term"])
        self.held = save(held, "held")
        totals = self.held.groupBy("lang", "source").agg(F.sum("c").alias("n"))
        g = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        groups = groups.withColumn("g", g).join(totals, ["lang", "source"], "left").withColumn("n", F.coalesce("n", zero))
        last = F.max("g").over(Window.partitionBy("lang"))
        groups = groups.join(langs, "lang").withColumn("blocks", F.floor(last / F.lit(rule.block)) + 1)
        self.groups = save(groups, "groups")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of every ordered pair of sources of a language."""
        rule = self.rule
        packed = self.held.groupBy("lang", "source", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "c"))).alias("t"))
        packed = packed.select("lang", "source", "chunk", F.col("t.pos").alias("pos"), F.col("t.c").alias("c"))
        sizes = self.vocabulary.groupBy("lang", "chunk").agg(F.count("*").alias("size"))
        rows = self.groups.withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
        rows = rows.join(sizes, ["lang", "chunk"], "left").join(packed, ["lang", "source", "chunk"], "left")
        block = F.floor(F.col("g") / F.lit(rule.block))
        rows = rows.withColumns({"block": block, "stripe": F.expr(f"chunk DIV {rule.stripe}"), "size": F.coalesce("size", F.lit(0))})
        rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        tile = ["lang", "stripe", "lo", "hi"]
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.select(*tile, "chunk", "g", "block", "n", "v", "size", "pos", "c").repartition(n, *tile)
        sums = dealt.sortWithinPartitions(*tile, "chunk", "g").mapInArrow(_tiles, _TILE)
        sums = self.scratch.save(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "sums")
        both = sums.unionAll(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        of_a = self.groups.select("lang", F.col("g").alias("a"), "source")
        of_b = self.groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
        return both.join(of_a, ["lang", "a"]).join(of_b, ["lang", "b"]).select("lang", "source", "item", "value")

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of terms that a source uses more than its language."""
        rows = self.held.join(self.groups.select("lang", "source", "n", "v", "lang_n"), ["lang", "source"])
        more = _share("c", f"(n + {PRIOR} * v)") - _share("lang_c", f"(lang_n + {PRIOR} * v)")
        return rows.select("lang", "source", F.col("term").alias("item"), more.cast("long").alias("value")).filter("value > 0")

    def run(self) -> DataFrame:
        self.count()
        by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        rank = F.row_number().over(by).alias("rank")
        columns = ["lang", "source", "part", "item", "value", "rank"]
        pairs = self.pairs().select("*", F.lit("pair").alias("part"), rank).select(columns)
        # the limit of ranks reaches below the exchange: a task passes on its own first ones only
        terms = self.terms().select("*", F.lit("term").alias("part"), rank).filter(F.col("rank") <= self.rule.top).select(columns)
        result = self.scratch.save(pairs.unionAll(terms), "audit")
        self.scratch.clear(keep="audit")
        return result


def audit_sources(spark: SparkSession, docs: DataFrame, rule: Audit = Audit()) -> DataFrame:  # noqa: B008
    """Distances of sources and the terms that mark them: lang, source, part, item, value, rank.

    Null lang, source and text are empty. Every row is a document, also where rows repeat
    or share a doc_id; only these three columns are read. A language without vocabulary
    gives its pairs with value 0 and no terms, a language with one source no pairs, an
    empty table no rows. Equal values rank by item in UTF-8 order.
    """
    return _Audit(spark, docs, rule).run()


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = f"""
    WITH d AS (
      SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
      FROM documents
    ), g AS (
      SELECT DISTINCT lang, source FROM d
    ), occ AS (
      SELECT lang, source, r, unnest(w) AS term FROM d
    ), kept AS (
      SELECT lang, term, count(*) AS c FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 30
    ), l AS (
      SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
    ), c AS (
      SELECT lang, source, term, count(*) AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL
    ), n AS (
      SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL
    ), p AS (
      SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * l.v) AS p,
             1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN kept AS k USING (lang) JOIN l USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
    ), f AS (
      SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), parts AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50
"""
