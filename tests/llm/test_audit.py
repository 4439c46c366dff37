"""The source audit against a plain program over all groups and terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftstone.llm import source_audit
from siftstone.llm.source_audit import Audit, audit_sources, exact_shares

SCHEMA = "doc_id long, text string, lang string, source string, g int, chunk int, value long, rank int, term string, n long"
TINY = Audit(least_docs=3, top=4, chunk=5, stripe=2, block=2)


def plain(rows, rule):
    texts = [(t or "", lang or "", s or "") for _, t, lang, s in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in texts]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for (_, lang, s), w in zip(texts, words, strict=True):
        df[lang].update(set(w))
        counts[lang, s].update(w)
        groups[lang].add(s)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= rule.least_docs]
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[: rule.top])):
                items = sorted(items, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(items, 1)]
    return sorted(out)


def found(spark, rows, rule):
    full = [(*r, 1, 2, 3, 4, "t", 5) for r in rows]
    got = audit_sources(spark, spark.createDataFrame(full, SCHEMA), rule)
    return sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect())


def documents(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdeÉ日" for b in ("x", "Y", "ß", "")]
    rows = []
    for i in range(160):
        source = rng.choice(["s1", "s1", "s1", "s2", "S3", "é", None, "s6", "s7"])
        few = vocabulary[: rng.choice([3, 9, len(vocabulary)])]
        text = rng.choice([" ", "7", "\n", "_", "\x7f"]).join(rng.choice(few) for _ in range(rng.randrange(12)))
        rows.append((rng.choice([i, 5, None]), rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "de", None]), source))
    rows += [(900, "solo words here", "it", "only")] * 4  # one source
    rows += [(901, "nothing", "pt", "a"), (902, "shared", "pt", "b"), (903, None, "pt", None)]  # no vocabulary
    return rows + rows[:30]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_program(spark, seed, monkeypatch):
    monkeypatch.setattr(source_audit, "HELD_TERMS", 10)
    rows = documents(seed)
    want = plain(rows, TINY)
    assert found(spark, rows, TINY) == want
    assert {r[2] for r in want if r[0] == "pt"} == {"pair"} and all(r[4] == 0 for r in want if r[0] == "pt")
    assert not [r for r in want if r[0] == "it" and r[2] == "pair"]


def test_empty_table_and_a_very_long_text(spark):
    assert found(spark, [], TINY) == []
    rows = [(k, "aa bb " * 100_000 if k < 3 else "aa cc", "en", "s" if k % 2 else "t") for k in range(8)]
    assert found(spark, rows, TINY) == plain(rows, TINY)


@pytest.mark.parametrize("total", [7, 9 * 10**9 - 1, 9 * 10**9, 9 * 10**15 - 1, 9 * 10**15, 9 * 10**17 - 1, 2 * 10**18])
def test_shares_are_exact_at_every_size(total):
    counts = [0, 1, 5, total // 3, total // 2 + 1, total - 1, total]
    assert exact_shares(np.array(counts), total).tolist() == [10**9 * c // total for c in counts]
