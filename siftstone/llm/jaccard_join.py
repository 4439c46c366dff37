"""Exact Jaccard join over word shingles, up to connected components.

Jaccard regions around pivot documents do not work on such data: nearly all pairs
of documents are at distance 1, so a window of twice the radius copies nearly every
document into every region (the README has figures). The join keeps what makes the
method exact, windows from the triangle inequality, and changes the pivots:

* **Rings.** In the symmetric-difference metric the distance to the empty set is the
  size of a set. Sets are dealt to rings of sizes; a set whose window reaches into
  the next ring is replicated there.
* **Projections.** In a ring, linked sets differ in at most D shingles. Shingles fall
  by hash into D + 1 + e classes, so linked sets are equal in at least 1 + e classes.
  A region is the sets that are equal in one class. Equal empty classes prove
  nothing; a set with at most e of them leaves them out. With a fifth of D for e, a
  linked set has many regions in common with another, and a set with too few shared
  regions is dropped at once, which frees most that share a line or a passage only.
* **Pivots in regions.** The most central set of a region is its pivot. All others
  are compared with it; what it links is settled. Regions that still hold more than
  one component go on: small ones give the pairs between components, large ones are
  joined block by block. Either way a pair must agree in as many classes as its two
  sizes demand before its sets are compared.

Rows with equal shingle sets are one node, and regions are found by a range
partitioning of (key, doc_id), so that neither copies nor a region that many
documents share meet in one task. Every link is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, held, lowered, release
from .components import connected_components

#: Regions up to this many sets compare pairs; larger ones are joined by block.
PAIR_REGION = 24
#: Rounds in which sets with too few shared regions are dropped.
PEELS = 2
#: Sets in a block of a large region.
BLOCK = 384
#: Ids whose texts are fetched by a broadcast join; 8 bytes each.
BROADCAST_IDS = 2_000_000
#: Words whose hash a worker remembers.
WORD_CACHE = 250_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        made = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE and len(word) <= 40:
            self[word] = made
        return made


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    Words are separated by ASCII white space, A-Z lower-cased. A text with fewer
    words than the width is one shingle; without words the set is empty.
    """
    words = lowered(text).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    known = held("word hashes", 0, _WordHashes)
    h = np.array([known[w] for w in words], dtype=np.uint64)
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out * _M1 + h[k : k + n])
    return np.unique(out)


@dataclass(frozen=True)
class Rule:
    """Sets link when den * |A & B| >= num * |A | B|; shingles have ``width`` words."""

    width: int
    num: int
    den: int

    def __post_init__(self):
        if not 0 < self.num <= self.den:
            raise ValueError("the similarity must be above 0 and at most 1")

    def differ(self, sizes):
        """Most shingles in which linked sets of this total size differ."""
        return sizes - 2 * -(-self.num * sizes // (self.num + self.den))

    @cached_property
    def rings(self) -> list[tuple[int, int, int, int]]:
        """(least size, largest size, classes, spare classes), up to 2^40 shingles."""
        out, low = [], 1
        growth = max(1.7, self.den / self.num + 0.1)
        while low < 1 << 40:
            high = max(low, int(low * growth))
            most = 2 * high * (self.den - self.num) // (self.den + self.num)
            # most is 0 where only equal sets link; such a ring has no classes
            spare = 2 + -(-(most + 1) // 5)
            out.append((low, high, most + 1 + spare if most else 0, spare))
            low = high + 1
        return out

    @cached_property
    def _highs(self) -> np.ndarray:
        return np.array([r[1] for r in self.rings])

    def ring(self, size: int) -> int:
        return int(np.searchsorted(self._highs, size))

    def reach(self, size: int) -> int:
        """The ring of the largest set that can link with a set of this size."""
        return self.ring(size * self.den // self.num)

    def class_keys(self, hashes: np.ndarray, ring: int) -> tuple[np.ndarray, int]:
        """One key a class, 0 for an empty class that is left out; and how many may hide.

        The second number bounds the equal classes of a linked pair that do not show
        as equal keys: the empty ones, as far as either side leaves them out.
        """
        _, _, classes, spare = self.rings[ring]
        cls = ((hashes >> np.uint64(20)) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(cls, kind="stable")
        cls, values = cls[order], hashes[order]
        first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
        sums = np.zeros(classes, dtype=np.uint64)
        sums[cls[first]] = np.add.reduceat(_mix(values + _M1), first)
        own = np.arange(classes, dtype=np.uint64) * np.uint64(1 << 12) + np.uint64(ring + 1)
        # the low bits name the ring, so that agreement can be counted ring by ring
        keys = _mix(sums + _mix(own * _M1)) & ~np.uint64(127) | np.uint64(ring * 2 + 1)
        void = classes - len(first)
        if void <= spare:
            empty = np.ones(classes, dtype=bool)
            empty[cls[first]] = False
            keys[empty] = 0
        return keys, min(void, spare)


def _lists(values: list[np.ndarray], kind=np.int64) -> pa.ListArray:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values).view(kind) if values else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


_SIGNED = (
    "doc_id long, n long, hi long, lo long, ring int, keys array<long>, void int, "
    "next_ring int, next_keys array<long>, next_void int"
)


def _sign(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        nothing = np.empty(0, dtype=np.uint64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                n, digest, rings, keys, nexts, next_keys = [], [], [], [], [], []
                for text in part.column(1):
                    h = shingle_set(text.as_py(), rule.width)
                    n.append(len(h))
                    digest.append(np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), dtype="<i8"))
                    ring = rule.ring(len(h)) if len(h) else 0
                    own = bool(len(h)) and rule.rings[ring][2] > 0
                    rings.append(ring)
                    keys.append(rule.class_keys(h, ring) if own else nothing)
                    further = rule.reach(len(h)) if len(h) else 0
                    more = further > ring and rule.rings[further][2] > 0
                    nexts.append(further)
                    next_keys.append(rule.class_keys(h, further) if more else nothing)
                digest = np.array(digest).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        pa.array(rings, pa.int32()),
                        _lists([k for k, _ in keys]),
                        pa.array([v for _, v in keys], pa.int32()),
                        pa.array(nexts, pa.int32()),
                        _lists([k for k, _ in next_keys]),
                        pa.array([v for _, v in next_keys], pa.int32()),
                    ],
                    names=["doc_id", "n", "hi", "lo", "ring", "keys", "void", "next_ring", "next_keys", "next_void"],
                )
        release()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by (key, doc_id): rows whose key others have too.

    The first and the last run may go on in a neighbouring partition and are kept.
    """
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])
    held_key, held_doc = np.empty(0, np.int64), np.empty(0, np.int64)
    keep_head = True  # the run in front counts as shared

    def out(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(docs)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
        docs = np.concatenate([held_doc, batch.column(1).to_numpy(zero_copy_only=False)])
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])]
        keys, docs = keys[fresh], docs[fresh]
        last = keys == keys[-1]  # this run may go on and waits
        if last.all():
            if len(keys) > 100_000:  # a long run is shared for certain
                yield out(keys[:-1], docs[:-1])
                keys, docs, keep_head = keys[-1:], docs[-1:], True
            held_key, held_doc = keys, docs
            continue
        same = keys[1:] == keys[:-1]
        keep = np.r_[same, False] | np.r_[False, same]
        if keep_head:
            keep |= keys == keys[0]
            keep_head = False
        keep &= ~last
        if keep.any():
            yield out(keys[keep], docs[keep])
        held_key, held_doc = keys[last], docs[last]
    if len(held_key):
        yield out(held_key, held_doc)


def _sets(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                made = [shingle_set(t.as_py(), rule.width) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(made)], names=["doc_id", "hashes"])
        release()

    return run


def _block_links(rule: Rule):
    """Links between components in one pair of blocks, verified on the whole sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id"], kind="stable")
        docs, n, roots = (pdf[c].to_numpy() for c in ("doc_id", "n", "root"))
        blocks, low, high = pdf["block"].to_numpy(), pdf["low"].iloc[0], pdf["high"].iloc[0]
        ring = int(pdf["ring"].iloc[0])
        classes = rule.rings[ring][2]
        sets = [np.asarray(h).view(np.uint64) for h in pdf["hashes"]]  # in the order they were sorted
        vectors = np.stack([rule.class_keys(h, ring)[0] for h in sets])
        void = (vectors == 0).sum(axis=1)
        out_a, out_b = [], []
        for i in range(len(docs) - 1):
            # sizes ascend, so the partners of i end where the window does
            stop = np.searchsorted(n, n[i] * rule.den // rule.num, side="right")
            j = np.arange(i + 1, stop)
            j = j[roots[j] != roots[i]]
            if low != high:
                j = j[blocks[j] != blocks[i]]
            if not len(j):
                continue
            agree = (vectors[j] == vectors[i]).sum(axis=1)
            # classes left out by one side only may be equal without showing it
            unseen = np.where((void[j] > 0) == (void[i] > 0), 0, np.maximum(void[j], void[i]))
            j = j[agree >= classes - rule.differ(n[i] + n[j]) - unseen]
            if not len(j):
                continue
            at = np.searchsorted(sets[i], flat := np.concatenate([sets[k] for k in j]))
            hit = sets[i][np.minimum(at, len(sets[i]) - 1)] == flat
            common = np.add.reduceat(hit, np.r_[0, np.cumsum(n[j])[:-1]], dtype=np.int64)
            j = j[common * rule.den >= (n[i] + n[j] - common) * rule.num]
            out_a.append(np.full(len(j), docs[i]))
            out_b.append(docs[j])
        made = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b))
        return pd.DataFrame(dict(zip("ab", made, strict=True)))

    return run


def by_ids(rows: DataFrame, ids: DataFrame, on: list[str], how: str) -> DataFrame:
    """Rows that a semi or anti join with a saved table of ids leaves, without exchanging them.

    Ids are broadcast; more than ``BROADCAST_IDS`` values go in parts by hash, each with the rows of
    its part, so that rows are read once a part and never moved.
    """
    parts = max(-(-ids.count() * len(on) // BROADCAST_IDS), 1)
    # ids keep their own names, as rows may be what they were made of
    own = ids.select(*[F.col(c).alias(f"__{c}") for c in on])
    match = [F.col(c) == F.col(f"__{c}") for c in on]
    found = []
    for part in range(parts):
        of = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(parts)) == part  # noqa: B023, E731
        some, few = (rows.filter(of(on[0])), own.filter(of(f"__{on[0]}"))) if parts > 1 else (rows, own)
        found.append(some.join(F.broadcast(few), match, how))
    return reduce(DataFrame.unionAll, found)


class _Join:
    def __init__(self, spark: SparkSession, docs: DataFrame, rule: Rule):
        self.spark, self.rule, self.scratch = spark, rule, Scratch(spark, "jaccard")
        self.rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def signed(self) -> DataFrame:
        """Rows with their size and the digest of their set; the node of a set.

        The class keys, about as much as the texts, stay in a table of their own until
        the shared ones are known.
        """
        self.keyed = self.scratch.save(self.rows.mapInArrow(_sign(self.rule), _SIGNED), "keyed")
        several = F.expr("size(keys) > 0").alias("own"), F.expr("size(next_keys) > 0").alias("more")
        signed = self.scratch.save(self.keyed.select("doc_id", "n", "hi", "lo", "ring", "void", "next_ring", "next_void", *several), "signed")
        copies = (
            signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), F.count("*").alias("c"))
        )
        self.copies = self.scratch.save(copies.filter("c > 1").drop("c"), "copies")
        return signed

    def shared_keys(self, signed: DataFrame) -> DataFrame:
        """(key, doc_id) of the nodes whose key another node has."""
        own = self.keyed.filter("doc_id IS NOT NULL AND (size(keys) > 0 OR size(next_keys) > 0)")
        # the class keys stay where they are: a copy is told by its id
        copied = signed.filter("n > 0 AND doc_id IS NOT NULL").join(self.copies, ["hi", "lo"]).filter("least <> doc_id")
        nodes = by_ids(own, self.scratch.save(copied.select("doc_id", "hi", "lo"), "copied"), ["doc_id", "hi", "lo"], "left_anti")
        keys = nodes.select("doc_id", F.explode(F.concat("keys", "next_keys")).alias("key")).filter("key <> 0")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = keys.select("key", "doc_id").repartitionByRange(n, "key", "doc_id").sortWithinPartitions("key", "doc_id")
        found = self.scratch.save(dealt.mapInArrow(_shared, "key long, doc_id long"), "shared-0")
        self.scratch.drop("keyed")
        self.scratch.settle()
        needs = self._needs(signed)
        for step in range(PEELS):
            found = self._peeled(found, needs, step)
        sizes = self.scratch.save(found.groupBy("key").agg(F.count("*").alias("g")).filter("g > 1"), "sizes")
        regions = self.scratch.save(found.join(sizes, "key"), "regions")
        self.scratch.drop(f"shared-{PEELS}", "sizes")
        self.scratch.settle()
        return regions

    def _needs(self, signed: DataFrame) -> DataFrame:
        """(doc_id, ring, need): in how many classes a set agrees with any it links with."""
        own = signed.filter("own").select("doc_id", "n", "ring", "void")
        more = signed.filter("more").select("doc_id", "n", F.col("next_ring").alias("ring"), F.col("next_void").alias("void"))
        high = F.element_at(F.array(*[F.lit(r[1]) for r in self.rule.rings]), F.col("ring") + 1)
        largest = F.least(high, F.expr(f"n * {self.rule.den} DIV {self.rule.num}"))
        # rows that repeat a doc_id are one node, held to the least of their needs
        need = self._classes() - self._differ(F.col("n") + largest) - F.col("void")
        return own.unionAll(more).select("doc_id", "ring", need.alias("need")).groupBy("doc_id", "ring").agg(F.min("need").alias("need"))

    def _peeled(self, found: DataFrame, needs: DataFrame, step: int) -> DataFrame:
        """Without the sets that have fewer shared regions than a link takes."""
        sizes = found.groupBy("key").agg(F.count("*").alias("g")).filter("g > 1").select("key")
        shared = self.scratch.save(found.join(sizes, "key", "left_semi"), f"several-{step}")
        counted = shared.groupBy("doc_id", self._ring().alias("ring")).agg(F.count("*").alias("c"))
        enough = counted.join(needs, ["doc_id", "ring"]).filter("c >= need").select("doc_id", "ring")
        enough = self.scratch.save(enough, f"enough-{step}")
        left = shared.withColumn("ring", self._ring()).join(enough, ["doc_id", "ring"], "left_semi").select("key", "doc_id")
        left = self.scratch.save(left, f"shared-{step + 1}")
        self.scratch.drop(f"shared-{step}", f"several-{step}", f"enough-{step}")
        return left

    def _ring(self) -> Column:
        """The ring of a key."""
        return F.shiftright(F.col("key").bitwiseAND(F.lit(127)), 1).cast("int")

    def _classes(self) -> Column:
        return F.element_at(F.array(*[F.lit(r[2]) for r in self.rule.rings]), F.col("ring") + 1)

    def _differ(self, sizes: Column) -> Column:
        """A bound on Rule.differ that grows with the sizes, as an expression."""
        rule = self.rule
        return F.floor(sizes * (rule.den - rule.num) / F.lit(rule.den + rule.num))

    def fetch_sets(self, regions: DataFrame) -> DataFrame:
        ids = self.scratch.save(regions.select("doc_id").distinct(), "ids")
        wanted = by_ids(self.rows, ids, ["doc_id"], "left_semi")
        return self.scratch.save(wanted.mapInArrow(_sets(self.rule), "doc_id long, hashes array<long>"), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that link, by their whole sets."""
        a = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"))
        b = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"))
        common = F.size(F.array_intersect("ha", "hb"))
        union = F.size("ha") + F.size("hb") - F.col("common")
        both = pairs.join(a, "a").join(b, "b").withColumn("common", common)
        links = self.scratch.save(both.filter(F.col("common") * self.rule.den >= union * self.rule.num).select("a", "b"), name)
        self.scratch.settle()
        return links

    def links(self, signed: DataFrame) -> DataFrame:
        """Links that connect what the rule connects; not every linked pair is listed."""
        regions = self.shared_keys(signed)
        sets = self.fetch_sets(regions)
        # The pivot of a region: the set whose regions are largest, then the least id.
        central = regions.groupBy("doc_id").agg(F.sum("g").alias("score"))
        scored = regions.join(central, "doc_id")
        pivots = scored.groupBy("key").agg(F.max(F.struct("score", -F.col("doc_id"))).alias("p"))
        pivots = self.scratch.save(pivots.select("key", (-F.col("p.col2")).alias("pivot")), "pivots")
        rays = regions.join(pivots, "key").filter("doc_id <> pivot")
        rays = rays.groupBy(F.col("doc_id").alias("a"), F.col("pivot").alias("b"), self._ring().alias("ring"))
        rays = self.scratch.save(rays.agg(F.max("g").alias("g"), F.count("*").alias("shared")), "rays")
        links = self.verified(self._often(rays, signed, "rays"), sets, "links-pivot")
        roots = connected_components(self.scratch, links, "pivot").withColumnRenamed("node", "doc_id")
        settled = regions.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        settled = self.scratch.save(settled, "settled")
        open_keys = settled.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
        left = settled.join(self.scratch.save(open_keys.select("key"), "open"), "key")
        left = self.scratch.save(left, "left")
        self.scratch.drop("regions", "pivots", "settled", "open")
        few = self.verified(self._pairs(left, signed), sets, "links-small")
        many = self.scratch.save(self._blocks(left, rays, signed, sets), "links-large")
        return links.unionAll(few).unionAll(many)

    def _pairs(self, left: DataFrame, signed: DataFrame) -> DataFrame:
        """Pairs between components that small regions bring together often enough.

        Linked sets agree in all classes but those in which they differ. A linked
        pair that no large region holds has all these regions here, so it is found
        by counting them; any other is found by block.
        """
        rows = self.scratch.save(left.filter(f"g <= {PAIR_REGION}").select("key", "doc_id", "root"), "small")
        a = rows.select("key", F.col("doc_id").alias("a"), F.col("root").alias("ra"))
        b = rows.select("key", F.col("doc_id").alias("b"), F.col("root").alias("rb"))
        met = a.join(b, "key").filter("a < b AND ra <> rb")
        met = met.groupBy("a", "b", self._ring().alias("ring")).agg(F.count("*").alias("shared"))
        return self._often(self.scratch.save(met, "met"), signed, "small")

    def _often(self, pairs: DataFrame, signed: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b, ring, shared) within the size window that share enough classes."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        ids = self.scratch.save(ids, f"{name}-ids")
        sizes = signed.select("doc_id", "n", F.greatest("void", "next_void").alias("void"))
        sizes = sizes.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
        sizes = sizes.groupBy("doc_id").agg(F.min("n").alias("n"), F.max("n").alias("n1"), F.max("void").alias("void"))
        sizes = self.scratch.save(sizes, f"{name}-sizes")
        sa = sizes.select(*[F.col(c).alias(d) for c, d in (("doc_id", "a"), ("n", "na"), ("n1", "na1"), ("void", "va"))])
        sb = sizes.select(*[F.col(c).alias(d) for c, d in (("doc_id", "b"), ("n", "nb"), ("n1", "nb1"), ("void", "vb"))])
        within = F.least("na1", "nb1") * self.rule.den >= F.greatest("na", "nb") * self.rule.num
        need = self._classes() - self._differ(F.col("na1") + F.col("nb1")) - F.greatest("va", "vb")
        sized = pairs.join(sa, "a").join(sb, "b")
        return sized.filter(within & (F.col("shared") >= need)).select("a", "b").distinct()

    def _blocks(self, left: DataFrame, rays: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between components in large regions, by block of their groups."""
        ids = self.scratch.save(left.filter(f"g > {PAIR_REGION}").select("doc_id", "root").distinct(), "large-ids")
        groups = connected_components(self.scratch, rays.filter(f"g > {PAIR_REGION}").select("a", "b"), "groups")
        members = ids.join(groups.withColumnRenamed("node", "doc_id").withColumnRenamed("root", "grp"), "doc_id")
        members = self.scratch.save(members, "members")
        few = members.count() <= BROADCAST_IDS
        own = signed.filter("n > 0").join(F.broadcast(members) if few else members, "doc_id")
        vectors = own.filter("own").select("doc_id", "root", "grp", "n", "ring").unionAll(
            own.filter("more").select("doc_id", "root", "grp", "n", F.col("next_ring").alias("ring"))
        )
        vectors = vectors.join(sets, "doc_id").filter(F.size("hashes") == F.col("n"))
        vectors = self.scratch.save(vectors, "vectors")
        sizes = vectors.groupBy("grp", "ring").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).alias("blocks"))
        dealt = vectors.join(sizes, ["grp", "ring"]).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        dealt = dealt.withColumn("other", other)
        dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
        return dealt.groupBy("grp", "ring", "low", "high").applyInPandas(_block_links(self.rule), "a long, b long")

    def run(self) -> DataFrame:
        signed = self.signed()
        links = self.links(signed)
        # A doc_id on several rows is one node: tie it to the node of each of its sets.
        again = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
        slim = signed.select("doc_id", "n", "hi", "lo")
        node = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
        tied = slim.join(again, "doc_id", "left_semi").join(self.copies, ["hi", "lo"], "left")
        links = links.unionAll(tied.select(F.col("doc_id").alias("a"), node.alias("b")))
        roots = connected_components(self.scratch, links, "all").select(F.col("node"), "root")
        placed = slim.join(self.copies, ["hi", "lo"], "left").withColumn("node", node)
        placed = placed.join(roots, "node", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id")
        )
        placed = self.scratch.save(placed, "placed")
        self.scratch.clear(keep="placed")
        return placed


def jaccard_components(spark: SparkSession, docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, the row's own
    included. Sets without shingles (null, empty or blank text) link with nothing.
    Rows with the same doc_id are one node; a row without doc_id links with nothing
    and has no component. An empty table gives an empty result; only doc_id and
    text are read.
    """
    return _Join(spark, docs, rule).run()


def drop_near_copies(spark: SparkSession, docs: DataFrame, rule: Rule) -> DataFrame:
    """One row of each component stays, the one with the smallest doc_id.

    Rows that repeat a doc_id are one document: the one with the least text stays.
    Rows without doc_id stay. All columns are kept as they are.
    """
    placed = jaccard_components(spark, docs, rule)
    scratch = Scratch(spark, "jaccard-gone")
    gone = scratch.save(placed.filter("doc_id <> component_id").select("doc_id").distinct(), "ids")
    scratch.settle()
    kept = by_ids(docs, gone, ["doc_id"], "left_anti")
    again = scratch.save(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    single = by_ids(kept, again, ["doc_id"], "left_anti")
    several = by_ids(kept, again, ["doc_id"], "left_semi")
    first = F.row_number().over(
        Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    )
    several = several.withColumn("__first", first).filter("__first = 1").drop("__first")
    return single.unionAll(several)
