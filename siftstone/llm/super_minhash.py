"""Near duplicates by SuperMinHash: banding, verification on whole sets, union-find.

A signature has ``SLOTS`` slots. Each element of a set draws one random permutation of the
slots; the element at place j of its permutation offers j plus a fraction to that slot,
and a slot keeps its least offer. Offers below j are final once places before j are
drawn, so drawing stops as soon as every slot has one: a set of a thousand elements
draws one or two places of each element, not all.

Documents that agree in all slots of a band share a bucket. Two linked documents (similarity
0.8) miss all 32 bands of 4 slots with probability 5e-8, and the test of agreement that
comes before verification loses one with less than that.

* Equal sets are one node, so copies cost nothing after their signature.
* Each bucket has a pivot, its most central document; all others are compared with it.
* Buckets that still hold several components go on without their pivot: small ones by
  pairs, large ones by tiles. The documents of large buckets that hang together are dealt by
  classes of set sizes and blocks within them, and only tiles whose sizes can link are
  made. A tile joins its links by union-find and passes on those that connect something.

Every link is verified on the full sets. What is compared in a tile grows with the square
of documents that are near, but not near enough to link; the rows passed on do not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release
from .components import connected_components
from .jaccard_join import BROADCAST_IDS, PAIR_REGION, Rule, _Join, _lists, _mix, _shared, shingle_set

SLOTS, BANDS = 128, 32
#: Slots in which two documents must agree before their sets are compared; at similarity
#: 0.8 the agreement is 102 on average, with a standard deviation of 4.5 at most.
LEAST_AGREE = 77
#: Elements whose permutations are drawn at once, with 128 bytes each.
BATCH = 100_000
#: Documents and bytes of sets in a block of a tile.
BLOCK_ROWS, BLOCK_BYTES = 384, 16 << 20

_STEP = 0xD1342543DE82EF95
_FREE = np.uint64(2**64 - 1)


def _draw(elements: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """What each element draws for this place: a slot from the rest, and a fraction of 48 bits."""
    seed = _mix(elements + np.uint64(_STEP * (place + 1) % 2**64))
    rest = np.uint64(SLOTS - place)
    return (((seed >> np.uint64(32)) * rest) >> np.uint64(32)).astype(np.int64) + place, _mix(seed) >> np.uint64(16)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set of 64-bit hashes; the row of an empty set is all ones.

    A slot holds the place (upper 16 bits) and the fraction of its least offer.
    """
    sizes = [len(s) for s in sets]
    out = np.full((len(sets), SLOTS), _FREE, np.uint64)
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), sizes)
    slot, fraction = _draw(elements, 0)
    np.minimum.at(flat, of * SLOTS + slot, fraction)
    open_sets = (out == _FREE).any(axis=1)
    active = open_sets[of]
    elements, of, first = elements[active], of[active], slot[active]
    rows = np.arange(len(of))
    order = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(of), 1))
    order[rows, first] = 0  # the swap of place 0
    for place in range(1, SLOTS):
        if not len(of):
            break
        slot, fraction = _draw(elements, place)
        taken = order[rows, slot]
        order[rows, slot] = order[:, place]
        np.minimum.at(flat, of * SLOTS + taken, fraction | np.uint64(place << 48))
        open_sets = (out == _FREE).any(axis=1)
        active = open_sets[of]
        if not active.all():
            elements, of, order = elements[active], of[active], order[active]
            rows = np.arange(len(of))
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band of each row."""
    width = SLOTS // BANDS
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_STEP)
    for k in range(width):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, k::width])
    return keys


_SIGNED = "doc_id long, n long, hi long, lo long, bands array<long>, signature binary"


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    import xxhash

    return np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype="<i8") for s in sets]).reshape(-1, 2)


def _parts(sizes: list[int]) -> Iterator[slice]:
    """Runs of sets with at most ``BATCH`` elements together, one set at least."""
    begin = total = 0
    for at, n in enumerate(sizes):
        if at > begin and total + n > BATCH:
            yield slice(begin, at)
            begin, total = at, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "hi", "lo", "bands", "signature"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                rows = batch.slice(at, 1_000)
                sets = [shingle_set(t.as_py(), width) for t in rows.column(1)]
                for part in _parts([len(s) for s in sets]):
                    own = sets[part]
                    made = signatures(own)
                    digest = _digests(own)
                    bands = [k if len(s) else k[:0] for k, s in zip(band_keys(made), own, strict=True)]
                    short = (_mix(made) >> np.uint64(48)).astype("<u2")
                    arrays = [
                        rows.column(0).slice(part.start, len(own)),
                        pa.array([len(s) for s in own], pa.int64()),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        _lists(bands),
                        pa.array([s.tobytes() for s in short], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
        release()

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                rows = batch.slice(at, 1_000)
                sets = [shingle_set(t.as_py(), width) for t in rows.column(1)]
                digest = _digests(sets)
                arrays = [rows.column(0), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _lists(sets)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "hi", "lo", "hashes"])
        release()

    return run


def _slots(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, SLOTS)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, signature, signature) whose signatures agree enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, 5_000):
            rows = batch.slice(at, 5_000)
            agree = (_slots(rows.column(2)) == _slots(rows.column(3))).sum(axis=1)
            yield pa.RecordBatch.from_arrays(rows.columns[:2], names=["a", "b"]).filter(pa.array(agree >= LEAST_AGREE))


def _tile_links(rule: Rule):
    """Links of one tile that connect components, found by union-find."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, n = pdf["doc_id"].to_numpy(), pdf["n"].to_numpy()
        side = pdf["side"].to_numpy()
        _, group = np.unique(pdf["root"].to_numpy(), return_inverse=True)
        slots = np.frombuffer(b"".join(pdf["signature"]), dtype="<u2").reshape(-1, SLOTS)
        sets = [np.asarray(h).view(np.uint64) for h in pdf["hashes"]]
        a, b = [], []
        for i in np.flatnonzero(side != 1):
            # side 2 is a block with itself: each pair once
            j = np.arange(i + 1, len(docs)) if side[i] == 2 else np.flatnonzero(side == 1)
            j = j[group[j] != group[i]]
            j = j[(np.minimum(n[j], n[i]) * rule.den >= np.maximum(n[j], n[i]) * rule.num)]
            j = j[(slots[j] == slots[i]).sum(axis=1) >= LEAST_AGREE]
            if not len(j):
                continue
            flat = np.concatenate([sets[k] for k in j])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            common = np.add.reduceat(sets[i][at] == flat, np.r_[0, np.cumsum(n[j])[:-1]], dtype=np.int64)
            for k in j[common * rule.den >= (n[i] + n[j] - common) * rule.num]:
                if group[k] != group[i]:
                    a.append(docs[i])
                    b.append(docs[k])
                    group[group == group[k]] = group[i]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


class _Near(_Join):
    """The Jaccard join with buckets of bands for regions."""

    def signed(self) -> DataFrame:
        signed = self.scratch.save(self.rows.mapInArrow(_sign(self.rule.width), _SIGNED), "signed")
        copies = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), F.count("*").alias("c"))
        self.copies = self.scratch.save(copies.filter("c > 1").drop("c"), "copies")
        return signed

    def links(self, signed: DataFrame) -> DataFrame:
        own = signed.filter("n > 0 AND doc_id IS NOT NULL").join(self.copies, ["hi", "lo"], "left")
        nodes = own.filter("least IS NULL OR least = doc_id").drop("least")
        nodes = self.scratch.save(nodes, "nodes")
        buckets = self.buckets(nodes)
        rays, pivots = self.rays(buckets)
        links = self.confirmed(rays, nodes, "pivot")
        roots = connected_components(self.scratch, links, "pivot").withColumnRenamed("node", "doc_id")
        settled = buckets.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        settled = self.scratch.save(settled, "settled")
        open_keys = settled.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1 AND key IS NOT NULL")
        left = settled.join(open_keys.select("key"), "key").join(pivots, "key").filter("doc_id <> pivot AND g > 2")
        left = self.scratch.save(left.select("key", "doc_id", "root", "g"), "left")
        small = left.filter(f"g <= {PAIR_REGION}")
        a = small.select("key", F.col("doc_id").alias("a"), F.col("root").alias("ra"))
        b = small.select("key", F.col("doc_id").alias("b"), F.col("root").alias("rb"))
        met = a.join(b, "key").filter("a < b AND ra <> rb").select("a", "b").distinct()
        few = self.confirmed(self.scratch.save(met, "met"), nodes, "small")
        many = self.scratch.save(self.tiles(left, rays, nodes), "links-large")
        return links.unionAll(few).unionAll(many)

    def buckets(self, nodes: DataFrame) -> DataFrame:
        """(key, doc_id, g) of the buckets with g > 1 nodes."""
        keys = nodes.select("doc_id", F.explode("bands").alias("key")).select("key", "doc_id")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = keys.repartitionByRange(n, "key", "doc_id").sortWithinPartitions("key", "doc_id")
        found = self.scratch.save(dealt.mapInArrow(_shared, "key long, doc_id long"), "shared")
        sizes = self.scratch.save(found.groupBy("key").agg(F.count("*").alias("g")).filter("g > 1"), "sizes")
        return self.scratch.save(found.join(sizes, "key"), "buckets")

    def rays(self, buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(a, b, g): every document with the pivots of its buckets; and the pivot of each."""
        central = buckets.groupBy("doc_id").agg(F.sum("g").alias("score"))
        pivots = buckets.join(central, "doc_id").groupBy("key").agg(F.max(F.struct("score", -F.col("doc_id"))).alias("p"))
        pivots = self.scratch.save(pivots.select("key", (-F.col("p.col2")).alias("pivot")), "pivots")
        rays = buckets.join(pivots, "key").filter("doc_id <> pivot")
        rays = rays.groupBy(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).agg(F.max("g").alias("g"))
        return self.scratch.save(rays, "rays"), pivots

    def confirmed(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        """The pairs that link: by sizes, then by signatures, then by the full sets."""
        a = nodes.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
        b = nodes.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
        sized = pairs.select("a", "b").join(a, "a").join(b, "b")
        sized = sized.filter(F.least("na", "nb") * self.rule.den >= F.greatest("na", "nb") * self.rule.num)
        likely = sized.select("a", "b", "sa", "sb").mapInArrow(_likely, "a long, b long").distinct()
        likely = self.scratch.save(likely, f"likely-{name}")
        sets = self.sets(likely.select(F.explode(F.array("a", "b")).alias("doc_id")), name)
        links = self.verified(likely, sets, f"links-{name}")
        self.scratch.drop(f"sets-{name}")
        return links

    def sets(self, ids: DataFrame, name: str) -> DataFrame:
        """(doc_id, hi, lo, hashes) of these documents."""
        ids = self.scratch.save(ids.distinct(), f"ids-{name}")
        wanted = self.rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
        return self.scratch.save(wanted.mapInArrow(_sets(self.rule.width), "doc_id long, hi long, lo long, hashes array<long>"), f"sets-{name}")

    def tiles(self, left: DataFrame, rays: DataFrame, nodes: DataFrame) -> DataFrame:
        """Links between components in large buckets, by tiles of blocks whose sizes can link."""
        ids = self.scratch.save(left.filter(f"g > {PAIR_REGION}").select("doc_id", "root").distinct(), "large")
        groups = connected_components(self.scratch, rays.filter(f"g > {PAIR_REGION}").select("a", "b"), "groups")
        members = ids.join(groups.withColumnRenamed("node", "doc_id").withColumnRenamed("root", "grp"), "doc_id")
        # sizes of linked sets differ by less than this, so their classes differ by at most one
        width = math.log(self.rule.den / self.rule.num * 1.01)
        size_class = F.floor(F.log(F.col("n")) / F.lit(width))
        own = nodes.drop("bands").join(members, "doc_id").withColumn("cls", size_class)
        own = own.join(self.sets(ids.select("doc_id"), "large"), ["doc_id", "hi", "lo"])
        own = self.scratch.save(own, "members")
        blocks = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("n") * 8 / F.lit(BLOCK_BYTES)))
        sizes = self.scratch.save(own.groupBy("grp", "cls").agg(blocks.alias("blocks")), "classes")
        above = sizes.select("grp", (F.col("cls") - 1).alias("cls"), F.col("blocks").alias("above"))
        below = sizes.select("grp", (F.col("cls") + 1).alias("cls"), F.col("blocks").alias("below"))
        sizes = sizes.join(above, ["grp", "cls"], "left").join(below, ["grp", "cls"], "left").fillna(0, ["above", "below"])
        dealt = own.join(sizes, ["grp", "cls"]).withColumn("block", F.pmod(F.xxhash64("hi", "lo"), "blocks"))
        # side 0 and 1 are the two blocks of a tile, 2 is a block with itself
        upto = "IF({0} > 0, sequence(0L, {0} - 1), CAST(array() AS array<bigint>))"
        same = f"transform({upto.format('blocks')}, o -> struct(cls AS c, least(o, block) AS i, cls AS d, greatest(o, block) AS j, IF(o = block, 2, IF(o > block, 0, 1)) AS side))"
        up = f"transform({upto.format('above')}, o -> struct(cls AS c, block AS i, cls + 1 AS d, o AS j, 0 AS side))"
        down = f"transform({upto.format('below')}, o -> struct(cls - 1 AS c, o AS i, cls AS d, block AS j, 1 AS side))"
        dealt = dealt.withColumn("tile", F.explode(F.expr(f"concat({same}, {up}, {down})")))
        dealt = dealt.select("grp", "tile.*", "doc_id", "n", "root", "signature", "hashes")
        return dealt.groupBy("grp", "c", "i", "d", "j").applyInPandas(_tile_links(self.rule), "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included;
    ``kept`` says whether it is the row's own. Null, empty and blank texts have no shingles
    and link with nothing. Rows with the same doc_id are one node. A row without doc_id
    links with nothing, has no component and is kept. An empty table gives an empty
    result; only doc_id and text are read.
    """
    if 100 * rule.num < 80 * rule.den:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    placed = _Near(spark, docs, rule).run()
    return placed.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
