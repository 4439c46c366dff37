"""SuperMinHash against the sequential algorithm, and its components against all pairs."""

import random

import numpy as np
import pytest

from siftstone.llm import super_minhash
from siftstone.llm.jaccard_join import Rule, shingle_set
from siftstone.llm.super_minhash import SLOTS, _draw, near_duplicates, signatures

RULE = Rule(width=2, num=80, den=100)


def sequential(elements):
    """One element after the other, each with a whole permutation drawn place by place."""
    least = [None] * SLOTS
    for e in elements:
        order = list(range(SLOTS))
        for place in range(SLOTS):
            slot, fraction = _draw(np.array([e], np.uint64), place)
            k = int(slot[0])
            order[place], order[k] = order[k], order[place]
            offer = (place << 48) + int(fraction[0])
            if least[order[place]] is None or offer < least[order[place]]:
                least[order[place]] = offer
    return least


def random_sets(seed, sizes):
    rng = np.random.default_rng(seed)
    return [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in sizes]


def test_signatures_equal_the_sequential_algorithm():
    sets = random_sets(3, [1, 2, 3, 7, 0, 20, 60, 128, 300])
    made = signatures(sets)
    for s, row in zip(sets, made, strict=True):
        if len(s):
            assert row.tolist() == sequential(s)
    assert (made[4] == 2**64 - 1).all()


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    errors, simple = [], 0.0
    for _ in range(300):
        pool = rng.integers(0, 2**64, 60, dtype=np.uint64)
        a, b = np.sort(pool[:50]), np.sort(pool[10:])  # 40 of 60
        made = signatures([a, b])
        errors.append((made[0] == made[1]).mean() - 2 / 3)
        simple = 2 / 9 / SLOTS  # variance of independent slots
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.9 * simple


def plain(rows):
    sets = [set(shingle_set(t, 2).tolist()) for _, t in rows]
    ids = [r[0] for r in rows]
    root = {d: d for d in ids if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if ids[i] is None or ids[j] is None or not a or not b:
                continue
            if min(len(a), len(b)) * 10 < 8 * max(len(a), len(b)):
                continue
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(ids[i]), find(ids[j])))
                root[y] = x
    out = []
    for d, s in zip(ids, sets, strict=True):
        top = None if d is None else find(d)
        out.append((d, len(s), top, d is None or d == top))
    return sorted(out, key=str)


def found(spark, docs, rows):
    got = near_duplicates(spark, docs(*rows), RULE)
    return sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def texts(seed):
    """Families: copies, chains of small changes, and variants that are near but not linked."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]

    def changed(base, share):
        return [rng.choice(words) if rng.random() < share else w for w in base]

    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "a b"), (7, "A B"), (None, "a b"), (8, "a b c")]
    at = 100
    for length in (12, 40, 150):
        base = rng.choices(words, k=length)
        for share, times in ((0, 12), (0.02, 25), (0.06, 25), (0.1, 20)):
            for _ in range(times):
                rows.append((at, " ".join(changed(base, share))))
                at += 1
        chain = base
        for _ in range(15):
            chain = changed(chain, 0.04)
            rows.append((at, " ".join(chain).upper()))
            at += 1
    passage = rng.choices(words, k=60)
    for _ in range(60):  # a passage that many share: in the same buckets, linked with few
        rows.append((at, " ".join(passage + rng.choices(words, k=rng.choice([12, 16, 25])))))
        at += 1
    rows += [(rows[30][0], rows[200][1]), (rows[31][0], None)]  # a doc_id on several rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("region", "block"), [(24, 384), (2, 7)])
def test_components(spark, docs, monkeypatch, region, block):
    monkeypatch.setattr(super_minhash, "PAIR_REGION", region)
    monkeypatch.setattr(super_minhash, "BLOCK_ROWS", block)
    rows = texts(region)
    assert found(spark, docs, rows) == plain(rows)


def test_empty_table_and_very_long_texts(spark, docs):
    assert found(spark, docs, []) == []
    rng = random.Random(1)
    long = [f"v{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-2000])), (3, " ".join(long[: len(long) // 2])), (4, "short text")]
    assert found(spark, docs, rows) == plain(rows)


def test_a_lower_similarity_is_refused(spark, docs):
    with pytest.raises(ValueError, match=r"0\.8"):
        near_duplicates(spark, docs(), Rule(width=2, num=70, den=100))
