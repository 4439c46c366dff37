"""Prefix trie of conversations, built as a compressed (Patricia) tree.

A turn is a key (a digest of role and text) and a number of words; a conversation is
the path of its keys. Paths are sorted over the whole cluster, so every node of the trie
is a range of them, and each partition builds the compressed tree of its own range in one
pass with a stack: points only where paths branch, end or stop. Aggregates are summed up
the compressed edges as points leave the stack.

* **Ranges meet at their borders.** A node that reaches into another partition lies on
  the first or the last path of its partition. All nodes of these two paths become points
  with an id, and records with the same id are added up. They are few: two paths a
  partition.
* **Long conversations are cut** into segments of ``SEGMENT`` turns, each a row of its own.
  Segments with the same turns before them form one tree; its root is the lowest node of
  the segment before. Totals of trees are added up the chain of segments by doubling, so a
  conversation of n segments takes log2(n) rounds, and no row or task holds a whole one.
* **Copies** sort by conversation id behind their path, so a path that many share spreads
  over partitions. The ids of conversations that end at a node are written as chunks of
  text in id order and hashed chunk by chunk.

Unary nodes exist only in the last step, which expands every edge: they share the counts
of the point below and add the suffix sum of the words on their edge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, Scratch

#: Turns in a segment. It bounds a row and the keys that a range partitioning samples.
SEGMENT = 16
#: Conversation ids in one chunk of the list that a node's digest is made of.
CHUNK = 50_000
#: Conversations whose first turns are shared: the first of each so many.
BLOCK = 20
#: Characters of a turn's key.
_KEY = 32

_PIECE = pa.schema(
    [
        ("id", pa.string()),
        ("parent", pa.string()),
        ("seg", pa.int64()),
        ("d", pa.int64()),
        ("edge", pa.list_(pa.int64())),
        ("n", pa.int64()),
        ("least", pa.int64()),
        ("kids", pa.int64()),
        ("leaves", pa.int64()),
        ("below", pa.int64()),
        ("next", pa.string()),
        ("forced", pa.bool_()),
        ("up", pa.list_(pa.string())),
        ("first", pa.int64()),
        ("ends", pa.string()),
    ]
)
_PIECE_SQL = (
    "id string, parent string, seg long, d long, edge array<long>, n long, least long, kids long, leaves long, "
    "below long, next string, forced boolean, up array<string>, first long, ends string"
)


def placed_turns(scratch: Scratch, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, key, words) of every turn, and (conv_id, len) of every conversation.

    Turns go by ``turn``, null first; ties go by the digest of role and text, so equal
    rows are all kept and their order says nothing. Null role or text is empty. Rows
    without conv_id belong to no conversation and are left out. Other columns are not
    read. A conversation of any length is spread over the partitions that its range covers.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(digest, 1, _KEY).alias("key"),
        F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")).cast("long").alias("words"),
    )
    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "key"]
    dealt = turns.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = scratch.save(dealt.select("conv_id", "key", "words", F.monotonically_increasing_id().alias("at")), "turns")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    runs = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first_at"), F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = scratch.save(runs.withColumn("before", F.coalesce(before, F.lit(0))), "runs")
    pos = F.col("at") - F.col("first_at") + F.col("before") + 1
    placed = dealt.join(runs, ["conv_id", "part"]).select("conv_id", pos.alias("pos"), "key", "words")
    return scratch.save(placed, "placed"), runs.groupBy("conv_id").agg(F.sum("c").alias("len"))


def with_shared_openings(scratch: Scratch, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that open like the first of their block, and their depths.

    Conversation c takes the first h turns of conversation c - c % 20 (all if it has fewer,
    none if there is no such one) in place of its own first h; h is crc32 of the decimal c
    modulo 4. ``%`` is SQL's, whose result has the sign of c. Returns (conv_id, pos, key,
    words, depth) and (conv_id, depth); a conversation may be left without turns.
    """
    placed, lengths = placed_turns(scratch, conversations)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = placed.filter(f"conv_id % {BLOCK} = 0 AND pos <= 3").groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("head"))
    based = lengths.withColumns({"base": F.expr(f"conv_id - conv_id % {BLOCK}"), "h": h}).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.expr("CAST(array() AS array<struct<pos: bigint, key: string, words: bigint>>)")), F.lit(1), F.col("h"))
    convs = based.select("conv_id", "len", "h", head.alias("head"))
    convs = convs.withColumn("depth", F.size("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0)))
    convs = scratch.save(convs, "convs")
    firsts = convs.select("conv_id", F.explode("head").alias("t"), "depth").select("conv_id", "t.pos", "t.key", "t.words", "depth")
    own = placed.filter(F.col("pos") > h).join(convs.select("conv_id", "h", F.size("head").alias("taken"), "depth"), "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words", "depth")
    return firsts.unionAll(own), convs.select("conv_id", "depth")


def _segments(scratch: Scratch, turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """(seg, grp, path, conv_id, words, cont): one row a segment.

    ``grp`` stands for all turns before the segment, ``cont`` for those up to its end; it
    is null where the conversation ends in this segment.
    """
    cut = turns.withColumn("seg", F.expr(f"(pos - 1) DIV {segment}")).groupBy("conv_id", "seg")
    cut = cut.agg(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("t"), F.max("depth").alias("depth"))
    cut = cut.select(
        "conv_id", "seg", F.array_join(F.col("t.key"), "").alias("path"), F.col("t.words").alias("words"), "depth"
    )
    none = convs.filter("depth = 0").select(
        "conv_id", F.lit(0).cast("long").alias("seg"), F.lit("").alias("path"), F.expr("CAST(array() AS array<bigint>)").alias("words"), "depth"
    )
    cut = scratch.save(cut.unionAll(none), "cut")
    last = F.lit(None).cast("string").alias("cont")
    short = cut.filter(F.col("depth") <= segment).select("seg", F.lit("").alias("grp"), "path", "conv_id", "words", last)
    by = Window.partitionBy("conv_id").orderBy("seg")
    lanes = [F.xxhash64(F.lit(k), "seg", "path").cast("decimal(38,0)") for k in (1, 2)]

    def key(upto: int) -> Column:
        sums = [F.sum(lane).over(by.rowsBetween(Window.unboundedPreceding, upto)).cast("string") for lane in lanes]
        return F.concat_ws(":", *[F.coalesce(s, F.lit("")) for s in sums])

    long = cut.filter(F.col("depth") > segment)
    long = long.withColumns({"grp": F.when(F.col("seg") == 0, "").otherwise(key(-1)), "cont": key(0)})
    goes_on = F.col("depth") > (F.col("seg") + 1) * segment
    long = long.select("seg", "grp", "path", "conv_id", "words", F.when(goes_on, F.col("cont")).alias("cont"))
    return short.unionAll(long)


def _node_id(seg: int, grp: str, prefix: str) -> str:
    return hashlib.blake2b(f"{seg}|{grp}|{prefix}".encode(), digest_size=16).hexdigest()


class _Point:
    """An open point of the stack, with what its closed children have given it."""

    __slots__ = ("below", "d", "forced", "id", "kids", "least", "leaves", "n", "next")

    def __init__(self, d: int, node: str, forced: bool):
        self.d, self.id, self.forced = d, node, forced
        self.n = self.kids = self.leaves = self.below = 0
        self.least: int | None = None
        self.next: str | None = None


class _Tree:
    """Builds the compressed trees of one sorted partition."""

    def __init__(self):
        self.stack: list[_Point] = []
        self.group: tuple[int, str] | None = None
        self.path, self.words = "", []
        self.ids: list[int] = []  # conversations that end at the current path
        self.out: list[dict] = []

    def add(self, seg: int, grp: str, path: str, conv_id: int, words: list[int], cont: str | None) -> None:
        if (seg, grp) != self.group:
            first = self.group is None
            self._flush_ends()
            while self.stack:
                self._close()
            self.group = seg, grp
            self.stack.append(_Point(0, _node_id(seg, grp, ""), first))
            self._open(0, path, words, first)
        elif path != self.path:
            self._flush_ends()
            same, most = 0, min(len(path), len(self.path)) // _KEY
            while same < most and path[same * _KEY : (same + 1) * _KEY] == self.path[same * _KEY : (same + 1) * _KEY]:
                same += 1
            while self.stack[-1].d > same:
                if self.stack[-2].d < same:  # the edge branches here
                    self.stack.insert(-1, _Point(same, _node_id(seg, grp, path[: same * _KEY]), False))
                self._close()
            self._open(same, path, words, False)
        top = self.stack[-1]
        top.n += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        if cont is not None:
            top.next = _node_id(seg + 1, cont, "")
        else:
            self.ids.append(conv_id)
            if len(self.ids) >= CHUNK:
                self._flush_ends()

    def _open(self, same: int, path: str, words: list[int], forced: bool) -> None:
        """The end of the path as a point; with ``forced`` every node on the way too."""
        depth = len(path) // _KEY
        for d in range(same + 1 if forced else max(depth, same + 1), depth + 1):
            self.stack.append(_Point(d, _node_id(*self.group, path[: d * _KEY]), forced))
        self.path, self.words = path, words

    def _flush_ends(self) -> None:
        if self.ids:
            self.out.append({"id": self.stack[-1].id, "first": self.ids[0], "ends": ",".join(map(str, self.ids))})
            self.ids = []

    def _close(self) -> None:
        """Take the deepest point off the stack and add it to the one above."""
        c = self.stack.pop()
        if not c.forced and not c.kids:
            c.leaves = 0 if c.next else 1
        seg, grp = self.group
        parent, edge = None, [0]
        if self.stack:
            p = self.stack[-1]
            parent, edge = p.id, self.words[p.d : c.d]
            p.n += c.n
            p.least = c.least if p.least is None else min(p.least, c.least)
            if not c.forced:
                p.kids += 1
                p.leaves += c.leaves
                p.below += c.below + (c.n - 1) * sum(edge)
        up = [_node_id(seg, grp, self.path[: d * _KEY]) for d in range(c.d + 1)] if c.forced or c.next else None
        self.out.append(
            dict(id=c.id, parent=parent, seg=seg, d=c.d, edge=edge, n=c.n, least=c.least, kids=c.kids, leaves=c.leaves)
            | dict(below=c.below, next=c.next, forced=c.forced, up=up)
        )

    def finish(self) -> None:
        """Close the last path, whose nodes may go on in the next partition."""
        self._flush_ends()
        if not self.stack:
            return
        known = {p.d: p for p in self.stack}
        depth = self.stack[-1].d
        self.stack = [known.get(d) or _Point(d, _node_id(*self.group, self.path[: d * _KEY]), True) for d in range(depth + 1)]
        for p in self.stack:
            p.forced = True
        while self.stack:
            self._close()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = _Tree()
    for batch in batches:
        for at in range(0, batch.num_rows, 5_000):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, 5_000).columns], strict=True):
                tree.add(*row)
            if tree.out:
                yield pa.RecordBatch.from_pylist(tree.out, schema=_PIECE)
                tree.out = []
    tree.finish()
    if tree.out:
        yield pa.RecordBatch.from_pylist(tree.out, schema=_PIECE)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, digest) of chunks sorted by (id, first); one digest is open at a time."""
    schema = pa.schema([("id", pa.string()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        done = []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            text = text.as_py().encode()
            if at == node:
                digest.update(b"," + text)
                continue
            if node is not None:
                done.append((node, digest.hexdigest()))
            node, digest = at, hashlib.sha256(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], schema=schema)


def _spare() -> Column:
    """Members of a node beyond the first: so often its words are saved."""
    return F.col("n") - 1


def _points(scratch: Scratch, pieces: DataFrame) -> DataFrame:
    """Every point once, with the aggregates of its own segment's tree."""
    points = pieces.filter("ends IS NULL").drop("ends", "first")
    inner = points.filter("NOT forced").drop("forced")
    same = [F.first(c).alias(c) for c in ("parent", "seg", "d", "edge", "up")]
    sums = [F.sum(c).alias(c) for c in ("n", "kids", "leaves", "below")]
    border = points.filter("forced").groupBy("id").agg(*same, *sums, F.min("least").alias("least"), F.max("next").alias("next"))
    border = scratch.save(border, "border")
    forced_kids = border.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("more"))
    border = border.join(forced_kids, "id", "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0))).drop("more")
    border = border.withColumn("leaves", F.when(F.expr("kids = 0 AND next IS NULL"), 1).otherwise(F.col("leaves")))
    own = _spare() * F.element_at("edge", -1)
    given = border.select(F.explode("up").alias("id"), F.col("leaves").alias("l"), (F.col("below") + own).alias("b"))
    given = given.groupBy("id").agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    border = border.join(given, "id").withColumns({"leaves": F.col("l"), "below": F.col("b") - own})
    return scratch.save(inner.unionByName(border.select(*inner.columns)), "points")


def _chained(scratch: Scratch, points: DataFrame) -> DataFrame:
    """Points with what the segments after theirs add; (root, node's values) by way of ``next``.

    Each tree's totals are added to the tree 1, 2, 4 … segments before it.
    """
    bottoms = points.filter("next IS NOT NULL").select("id", "next", "up")
    before = bottoms.select(F.col("next").alias("root"), F.element_at("up", 1).alias("anc"))
    trees = points.filter("d = 0").select(F.col("id").alias("root"), "leaves", "below").join(before, "root", "left")
    trees, step = scratch.save(trees, "trees-0"), 0
    while not trees.filter("anc IS NOT NULL").isEmpty():
        add = trees.filter("anc IS NOT NULL").groupBy(F.col("anc").alias("root")).agg(F.sum("leaves").alias("l"), F.sum("below").alias("b"))
        far = trees.select(F.col("root").alias("anc"), F.col("anc").alias("further"))
        new = trees.join(add, "root", "left").join(far, "anc", "left")
        zero = F.lit(0)
        new = new.select(
            "root",
            (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"),
            (F.col("below") + F.coalesce("b", zero)).alias("below"),
            F.col("further").alias("anc"),
        )
        step += 1
        trees = scratch.save(new, f"trees-{step}")
        scratch.drop(f"trees-{step - 1}")
    totals = trees.select(F.col("root").alias("next"), F.col("leaves").alias("l"), F.col("below").alias("b"))
    given = bottoms.join(totals, "next").select(F.explode("up").alias("id"), "l", "b")
    given = given.groupBy("id").agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    roots = points.filter("d = 0").select(F.col("id").alias("next"), F.col("kids").alias("more"))
    zero = F.lit(0)
    new = points.join(given, "id", "left").join(roots, "next", "left")
    new = new.withColumns(
        {
            "leaves": F.col("leaves") + F.coalesce("l", zero),
            "below": F.col("below") + F.coalesce("b", zero),
            "kids": F.col("kids") + F.coalesce("more", zero),
        }
    )
    return scratch.save(new.select(*points.columns), "chained")


def prefix_trie(scratch: Scratch, turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, pos, key, words, depth), pos from 1 without gaps.

    ``convs`` (conv_id, depth) lists every conversation; one of depth 0 ends at the root.
    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. No conversations give no nodes, not even a
    root. Turns with equal keys are equal: keys are 128 bits of SHA-256.
    """
    rows = _segments(scratch, turns, convs, segment)
    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["seg", "grp", "path", "conv_id"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*order, "words", "cont")
    pieces = scratch.save(dealt.mapInArrow(_build, _PIECE_SQL), "pieces")
    points = _points(scratch, pieces)
    if not points.filter("next IS NOT NULL").isEmpty():
        points = _chained(scratch, points)
    chunks = pieces.filter("ends IS NOT NULL").select("id", "first", "ends")
    chunks = chunks.repartition(n, "id").sortWithinPartitions("id", "first")
    ends = chunks.mapInArrow(_hash_chunks, "id string, ends_sha256 string")
    # the root of a later segment is the node in which the segment before it ends
    nodes = points.filter("d > 0 OR seg = 0")
    above = nodes.select(F.col("id").alias("parent"), F.col("least").alias("above"))
    above = above.unionAll(nodes.filter("next IS NOT NULL").select(F.col("next").alias("parent"), F.col("least").alias("above")))
    nodes = nodes.drop("up", "next").join(above, "parent", "left").join(ends, "id", "left")
    nodes = nodes.select("*", F.posexplode("edge").alias("j", "w"))
    is_last = F.col("j") == F.size("edge") - 1
    suffix = F.expr("aggregate(slice(edge, j + 1, size(edge)), 0L, (s, x) -> s + x)")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return nodes.select(
        F.col("least").alias("conv_id"),
        (F.col("seg") * segment + F.col("d") - F.size("edge") + 1 + F.col("j")).alias("depth"),
        F.when(F.col("parent").isNotNull(), F.when(F.col("j") == 0, F.col("above")).otherwise(F.col("least"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_last, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"),
        (F.col("below") + _spare() * suffix).cast("long").alias("saved_tokens"),
        F.when(is_last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )


def conversation_trie(spark: SparkSession, conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The trie of conversations that share openings; see ``with_shared_openings``."""
    scratch = Scratch(spark, "trie")
    nodes = scratch.save(prefix_trie(scratch, *with_shared_openings(scratch, conversations), segment), "nodes")
    scratch.clear(keep="nodes")
    return nodes


#: One step of crc32 a bit, eight a byte, over the decimal digits of c.
_CRC = """xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
            lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                                     lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

ORACLE_SQL = f"""
    WITH r AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ), t AS (
      SELECT conv_id, {{'role': role, 'text': text}} AS say,
             len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                substring(sha256(length(role) || ':' || role || text), 1, 32)) AS pos
      FROM r
    ), c AS (
      SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM r)
    ), made AS (
      SELECT c.conv_id, 0 AS part, b.pos, b.say, b.words FROM c JOIN t AS b ON b.conv_id = c.conv_id - c.conv_id % 20 AND b.pos <= c.h
      UNION ALL
      SELECT conv_id, 1, pos, say, words FROM c JOIN t USING (conv_id) WHERE pos > h
    ), paths AS (
      SELECT conv_id, coalesce(path, []) AS path, coalesce(words, []) AS words
      FROM c LEFT JOIN (
        SELECT conv_id, list(say ORDER BY part, pos) AS path, list(words ORDER BY part, pos) AS words FROM made GROUP BY conv_id
      ) USING (conv_id)
    ), pre AS (
      SELECT conv_id, d, path[1 : d] AS pre, len(path) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS w
      FROM paths, unnest(range(0, len(path) + 1)) AS u(d)
    ), node AS (
      SELECT d, pre, min(conv_id) AS rep, count(*) AS n, min(w) AS w,
             string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ids
      FROM pre GROUP BY d, pre
    ), spot AS (
      SELECT conv_id, d, rep FROM pre JOIN node USING (d, pre)
    ), kids AS (
      SELECT p.rep, p.d, count(*) AS kids
      FROM node JOIN spot AS p ON p.conv_id = node.rep AND p.d = node.d - 1 GROUP BY p.rep, p.d
    ), sub AS (
      SELECT a.rep, a.d, count(*) FILTER (kids.kids IS NULL) AS leaves, sum((node.n - 1) * node.w) AS saved
      FROM node LEFT JOIN kids USING (rep, d) JOIN spot AS a ON a.conv_id = node.rep AND a.d <= node.d GROUP BY a.rep, a.d
    )
    SELECT node.rep AS conv_id, node.d AS depth, p.rep AS parent_conv_id, node.n AS n_convs, coalesce(kids, 0) AS n_children,
           leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM node JOIN sub USING (rep, d) LEFT JOIN kids USING (rep, d) LEFT JOIN spot AS p ON p.conv_id = node.rep AND p.d = node.d - 1
"""
