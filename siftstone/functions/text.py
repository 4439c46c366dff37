"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind, unlike trim."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def word_count(text: Column) -> Column:
    """Words between white space; an empty or blank text has none."""
    return F.when(strip(text) == "", 0).otherwise(F.size(F.split(strip(text), r"(?U)\s+"))).cast("long")


def padded_id(prefix: str, number: Column, width: int = 5) -> Column:
    """A prefix and a zero-padded number, which grows beyond the width."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", number.cast("long")))


def hash_order(seed: int, key: Column) -> Column:
    """The order of every seeded choice: hex sha256 of "seed:key"."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def hash_remainder(text: Column, divisor: int) -> Column:
    """sha256 of the text as one large number, modulo a small divisor."""
    quads = F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: F.conv(F.substring(F.sha2(text, 256), i * 4 + 1, F.lit(4)), 16, 10).cast("long"),
    )
    return F.aggregate(quads, F.lit(0).cast("long"), lambda a, q: (a * 65536 + q) % divisor)


def near_normal(text: Column) -> Column:
    """For near-duplicate shingles: lower case, digits as 0, other signs as one space."""
    digits = F.regexp_replace(F.lower(text), r"(?U)\d", "0")
    return F.trim(F.regexp_replace(F.regexp_replace(digits, "[^a-z0-9 ]+", " "), " +", " "))


def char_shingles(norm: Column, size: int) -> Column:
    """Distinct character shingles; a text no longer than the size is its own."""
    # a look-ahead gives the overlapping pieces in one pass over the text
    cut = F.array_distinct(F.regexp_extract_all(norm, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))
    return F.when(F.length(norm) <= size, F.array(norm)).otherwise(cut)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


@F.udf(T.LongType(), useArrow=True)
def common_subsequence(a: list, b: list):
    """Length of the longest common subsequence of two arrays; null where either is null.

    The row of the table is one integer: a bit of ``a`` is clear where the length grows.
    """
    if a is None or b is None:
        return None
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    whole = row = (1 << len(a)) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & whole
    return len(a) - row.bit_count()


def rouge_l(reference: Column, candidate: Column) -> Column:
    """ROUGE-L F1 over word tokens; 0 where either side has none in common, null for a null text."""
    ref, cand = tokens(reference), tokens(candidate)
    common = common_subsequence(ref, cand)
    # 2pr / (p + r) with p and r the shares of common words
    return F.when(common > 0, 2.0 * common / (F.size(ref) + F.size(cand))).when(common == 0, 0.0)
