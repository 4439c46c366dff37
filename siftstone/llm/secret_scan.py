"""Secret scan with multipart credential linking.

Three base kinds are found by pattern and always reported. Credentials often come
in parts, none of which says much alone: an identifier, a secret and an endpoint.
Weak candidates for these parts are joined, as intervals, with all parts of the
other roles in the same scope (lines without a blank line between them) at a gap of
``WINDOW`` code points or less. A weak candidate is reported only when it meets a
strong part of another role, or parts of both other roles.

The join sorts the parts of a scope by start and keeps the furthest end so far, so
each candidate costs a binary search; no pairs are listed.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 200

#: Kinds in the order that breaks ties; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ROLE = {
    "assign": "secret",
    "hex": "secret",
    "weak_secret": "secret",
    "access": "id",
    "weak_id": "id",
    "endpoint": "endpoint",
}
STRONG = frozenset(KINDS[:3])

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 24 or more is a maximal run, as the search starts at the leftmost place.
_HEX = re.compile(r"[0-9a-f]{24,}")
_WEAK_ID = re.compile(
    r"""\b(?:client_?id|account(?:_?id)?|access_?key_?id|user(?:_?name)?|login)["']?[ \t]*[:=][ \t]*["']?[A-Za-z0-9._@-]{3,}""",
    re.I | re.A,
)
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_-]{16,}={0,2}")
_ENDPOINT = re.compile(
    r"""\b[a-z][a-z0-9+]{1,15}://[^\s"'<>]{3,}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?(?![\d.])|\b(?i:host|server|endpoint)["']?[ \t]*[:=][ \t]*["']?[A-Za-z0-9.-]{3,}""",
    re.A,
)
_SCOPE_END = re.compile(r"\n[ \t\r]*\n")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    stop: int

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.stop}"


def ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.stop))


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each base kind that are long enough."""
    found = [Span("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [Span("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [Span("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return ordered(found)


def _looks_random(token: str) -> bool:
    return any(map(str.isdigit, token)) and any(map(str.isalpha, token)) and len(set(token)) >= 9


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates that overlap no base span of their own role.

    Nor may one lie within a base span of another role: it is the same text, and
    would be its own complement.
    """
    found = [Span("weak_id", m.start(), m.end()) for m in _WEAK_ID.finditer(text)]
    found += [Span("weak_secret", m.start(), m.end()) for m in _WEAK_SECRET.finditer(text) if _looks_random(m[0])]
    found += [Span("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    taken = {role: _Taken([b for b in base if ROLE[b.kind] == role]) for role in ("id", "secret")}

    def free(s: Span) -> bool:
        return not any(t.overlaps(s) if role == ROLE[s.kind] else t.holds(s) for role, t in taken.items())

    return [s for s in found if free(s)]


class _Taken:
    """Base spans of a role by start, with the furthest end so far."""

    def __init__(self, spans: list[Span]):
        found = sorted((s.start, s.stop) for s in spans)
        self.starts = [start for start, _ in found]
        self.ends = _running_max([stop for _, stop in found])

    def overlaps(self, s: Span) -> bool:
        k = bisect_right(self.starts, s.stop - 1)
        return k > 0 and self.ends[k - 1] > s.start

    def holds(self, s: Span) -> bool:
        k = bisect_right(self.starts, s.start)
        return k > 0 and self.ends[k - 1] >= s.stop


def _running_max(values: list[int]) -> list[int]:
    out, top = [], -1
    for v in values:
        top = max(top, v)
        out.append(top)
    return out


class _Intervals:
    """Parts by start, with the furthest end among those that start no later."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans, key=lambda s: s.start)
        self.starts = [s.start for s in self.spans]
        self.furthest: list[Span] = []
        for s in self.spans:
            last = self.furthest[-1] if self.furthest else s
            self.furthest.append(s if s.stop >= last.stop else last)

    def near(self, s: Span, window: int) -> Span | None:
        """A part at a gap of at most ``window``: the one that reaches furthest."""
        k = bisect_right(self.starts, s.stop + window)
        if k and self.furthest[k - 1].stop >= s.start - window:
            return self.furthest[k - 1]
        return None


def link_parts(text: str, window: int = WINDOW) -> tuple[list[Span], list[Span], list[tuple[Span, Span]]]:
    """(base spans, reported weak spans, links from a weak span to a complement)."""
    base = base_spans(text)
    weak = weak_spans(text, base) if base or "://" in text or _WEAK_ID.search(text) else []
    if not weak:
        return base, [], []
    ends = [m.start() for m in _SCOPE_END.finditer(text)]
    scopes: dict[int, list[Span]] = {}
    for s in [*base, *weak]:
        scopes.setdefault(bisect_right(ends, s.start), []).append(s)
    reported, links = [], []
    for parts in scopes.values():
        strong, every = {}, {}
        for role in ("id", "secret", "endpoint"):
            own = [s for s in parts if ROLE[s.kind] == role]
            every[role] = _Intervals(own)
            strong[role] = _Intervals([s for s in own if s.kind in STRONG])
        for s in parts:
            if s.kind in STRONG:
                continue
            others = [r for r in every if r != ROLE[s.kind]]
            firm = [p for r in others if (p := strong[r].near(s, window))]
            met = [p for r in others if (p := every[r].near(s, window))]
            if firm or len(met) == len(others):
                reported.append(s)
                links += [(s, p) for p in (firm if firm else met)]
    return base, ordered(reported), links


_FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "links array<struct<kind:string,start:long,stop:long,to_kind:string,to_start:long,to_stop:long>>"
)
_LINK = pa.struct(
    [
        ("kind", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        ("to_kind", pa.string()),
        ("to_start", pa.int64()),
        ("to_stop", pa.int64()),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS[:3]}
        shas, spans, links = [], [], []
        for text in batch.column(1):
            base, weak, joined = link_parts(text.as_py() or "")
            for kind, column in counts.items():
                column.append(sum(s.kind == kind for s in base))
            shas.append(hashlib.sha256(",".join(map(str, base)).encode()).hexdigest())
            spans.append(",".join(map(str, ordered([*base, *weak]))))
            links.append(
                [
                    {"kind": a.kind, "start": a.start, "stop": a.stop, "to_kind": b.kind, "to_start": b.start, "to_stop": b.stop}
                    for a, b in joined
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(counts[k], pa.int64()) for k in KINDS[:3]],
                pa.array(shas, pa.string()),
                pa.array(spans, pa.string()),
                pa.array(links, pa.list_(_LINK)),
            ],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "links"],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document row with its counts, spans and links.

    Offsets are code points, ends exclusive. Null text counts as empty and has no
    spans. Repeated rows get equal answers, an empty table an empty result, and
    columns other than doc_id and text are not read.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(_scan, _FOUND)
