"""The conversation trie against a plain program that lists every prefix."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from siftstone.llm import prefix_trie
from siftstone.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, key string, path string, seg int, id string"


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    """conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends of every node."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, key(role or "", text or ""), (role or "", text or "")))
    said = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # the sign of c, as in SQL
        paths[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(who) - 1) * words
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(spark, rows, segment):
    full = [(*r, 1, "k", "p", 2, "i") for r in rows]
    nodes = conversation_trie(spark, spark.createDataFrame(full, SCHEMA), segment)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in nodes.select(names).collect())


def conversations(seed):
    """Few distinct turns, so that paths meet, stop inside others and repeat."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(90), 55):
        length = rng.choice([1, 1, 2, 3, 4, 5, 8, 13])
        for turn in range(length):
            rows.append((c, turn, rng.choice(["user", None, ""]), rng.choice(["a b", "", None, " \t", "a", "x y z"][: rng.choice([1, 2, 6])])))
    long = [(turn, "user", f"t {turn // 7}") for turn in range(40)]
    rows += [(c, *t) for c in (100, 101, 102, 141) for t in long[: 40 if c < 102 else 31]]
    rows += [(200, None, "user", "first"), (200, 0, "user", "second"), (200, 0, "bot", "second"), (200, 0, "bot", "second")]
    rows += [(None, 0, "user", "nobody"), (-5, 0, "user", "minus")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [2, 3, 16])
def test_random_conversations(spark, segment):
    rows = conversations(segment)
    assert found(spark, rows, segment) == plain(rows)


def test_one_conversation_that_many_repeat(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", f"line {t}") for c in range(20, 220) for t in range(5)] + [(3, 0, "user", "other")]
    assert found(spark, rows, 2) == plain(rows)


def test_turnless_and_empty(spark):
    # 9 has h = 1 and its block's first conversation is absent: no turn is left
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(short, 0, "user", "gone")]
    none = hashlib.sha256(str(short).encode()).hexdigest()
    assert found(spark, rows, 4) == plain(rows) == [(short, 0, None, 1, 0, 1, 0, none)]
    assert found(spark, [], 4) == []
    assert found(spark, [(None, 0, "user", "nobody")], 4) == []


def test_a_very_long_text_is_one_turn(spark):
    rows = [(c, 0, "user", "word " * 200_000) for c in (40, 41, 42, 43)]
    assert found(spark, rows, 4) == plain(rows)
