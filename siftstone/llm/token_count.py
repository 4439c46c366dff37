"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary gives every piece that ends at each
character; dynamic programming carries the best score and its piece count. No
pieces are built. The rules are those of the tokenizers library's Unigram model
behind a Metaspace pre-tokenizer:

* text is cut before each space (written as U+2581), one being put in front;
* of equal scores the segmentation whose last piece starts first is kept;
* a character that is no piece scores ten below the least score; runs of such
  characters become one unknown piece, or its UTF-8 bytes with byte fallback.

Counts of words are remembered up to ``CACHE_ENTRIES`` a worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 48


def read_pieces(path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) in id order and the unknown id of a sentencepiece file."""
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(made.id_to_piece(i), made.get_score(i)) for i in range(made.get_piece_size())], made.unk_id()


class UnigramCounter:
    """Counts the pieces of the best segmentation of texts."""

    def __init__(self, pieces: list[tuple[str, float]], unk_id: int, byte_fallback: bool = True):
        import ahocorasick

        self.pieces = {p: s for p, s in pieces}
        self.unknown_piece = pieces[unk_id][0]
        self.byte_fallback = byte_fallback and all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = frozenset(p for p in self.pieces if len(p) == 1)
        # No piece joins a pair of characters that is in none: a cut there is free.
        self.pairs = frozenset(p[i : i + 2] for p in self.pieces for i in range(len(p) - 1))
        self.cache: dict[str, int] = {}

    def _all_known(self, word: str) -> int:
        best, count, last = [0.0] * (len(word) + 1), [0] * (len(word) + 1), 0
        for end, (size, score) in self.automaton.iter(word):
            # pieces that end here come longest first, so an earlier start wins ties
            start = end + 1 - size
            total = best[start] + score
            if end >= last:
                last = end + 1
                best[last], count[last] = total, count[start] + 1
            elif total > best[last]:
                best[last], count[last] = total, count[start] + 1
        return count[-1]

    def _with_unknown(self, word: str) -> int:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, (size, score) in self.automaton.iter(word):
            ends[end + 1].append((end + 1 - size, score))
        best, back = [0.0] * (n + 1), [(0, False)] * (n + 1)
        for end in range(1, n + 1):
            options = [(start, score, False) for start, score in ends[end]]
            if word[end - 1] not in self.singles:
                options.append((end - 1, self.unknown_score, True))
            for k, (start, score, unknown) in enumerate(options):
                total = best[start] + score
                if k == 0 or total > best[end]:
                    best[end], back[end] = total, (start, unknown or word[start:end] == self.unknown_piece)
        count, end = 0, n
        while end:
            start, unknown = back[end]
            if not unknown:
                count, end = count + 1, start
                continue
            stop = end  # a run of unknown pieces is one
            while end and back[end][1]:
                end = back[end][0]
            run = word[end:stop]
            known = run in self.pieces or not self.byte_fallback
            count += 1 if known else len(run.encode("utf-8", "surrogatepass"))
        return count

    def _count(self, word: str) -> int:
        return self._all_known(word) if self._plain(word) else self._with_unknown(word)

    def word(self, word: str) -> int:
        """Pieces of one pre-token, which starts with the mark."""
        head = word
        for i in range(1, len(word)):
            if not word[i].isalnum():
                head = word[:i]
                break
        if len(head) < len(word) and word[len(head) - 1 : len(head) + 1] not in self.pairs and self._plain(word):
            return self._cached(head) + self._count(word[len(head) :])
        return self._count(word)

    def _plain(self, word: str) -> bool:
        # the unknown piece, spelt out or not, joins with its neighbours
        return self.singles.issuperset(word) and self.unknown_piece not in word

    def _cached(self, word: str) -> int:
        found = self.cache.get(word)
        if found is None:
            found = self._count(word)
            if len(self.cache) < CACHE_ENTRIES and len(word) <= CACHE_CHARS:
                self.cache[word] = found
        return found

    def count(self, text: str) -> int:
        """Pieces of a whole text; an empty text has none."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        words = marked.split(MARK)
        if marked[0] == MARK:
            words = words[1:]
        total, cache = 0, self.cache
        for w in words:
            found = cache.get(w)
            if found is None:
                found = self.word(MARK + w)
                if len(cache) < CACHE_ENTRIES and len(w) <= CACHE_CHARS:
                    cache[w] = found
            total += found
        return total


def _counter(path: str, byte_fallback: bool) -> UnigramCounter:
    def make() -> UnigramCounter:
        pieces, unk_id = read_pieces(path)
        return UnigramCounter(pieces, unk_id, byte_fallback)

    return held("unigram", (path, byte_fallback), make)


def count_tokens(docs: DataFrame, path: str, byte_fallback: bool = True) -> DataFrame:
    """One row per document row: doc_id, n_tokens.

    ``path`` names a sentencepiece file; its pieces and scores are the vocabulary.
    Null and empty texts have no tokens. Repeated rows get equal answers, an empty
    table an empty result; only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, byte_fallback)
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(run, "doc_id long, n_tokens long")
