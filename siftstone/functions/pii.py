"""Replacing e-mail addresses, card and phone numbers by placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, applied in this order, and their placeholders.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
CARD = r"\b(?:\d[ -]?){12,18}\d\b"
PHONE = r"(?<![\w-])(?:\+\d{1,3}[\s.-]?)?(?:\(\d{2,4}\)[\s.-]?)?\d{2,4}(?:[\s.-]?\d{2,4}){2,4}(?![\w-])"
PHONE_DIGITS = 9
PLACEHOLDERS = {"email": "[EMAIL]", "card": "[CARD]", "phone": "[PHONE]"}


def _unicode(pattern: str) -> Column:
    """Java's classes know ASCII only unless told otherwise."""
    return F.lit(f"(?U){pattern}")


def _is_phone(match: Column) -> Column:
    return F.length(F.regexp_replace(match, r"(?U)\D", "")) >= PHONE_DIGITS


def scrub_email(text: Column) -> Column:
    return F.regexp_replace(text, _unicode(EMAIL), F.lit(PLACEHOLDERS["email"]))


def scrub_card(text: Column) -> Column:
    return F.regexp_replace(text, _unicode(CARD), F.lit(PLACEHOLDERS["card"]))


def phone_matches(text: Column) -> Column:
    """Every match of the phone pattern, those with too few digits included."""
    return F.regexp_extract_all(text, _unicode(PHONE), F.lit(0))


def _joined(between: Column, found: Column) -> Column:
    """The text again, with matches of enough digits replaced."""

    def after(match: Column) -> Column:
        return F.coalesce(F.when(_is_phone(match), PLACEHOLDERS["phone"]).otherwise(match), F.lit(""))

    # side by side, so that the matches are found once a text and not once a part
    return F.array_join(F.zip_with(between, found, lambda part, match: F.concat(part, after(match))), "")


def scrub_phone(text: Column) -> Column:
    """Matches with enough digits are replaced; the text between them is put back."""
    return _joined(F.split(text, f"(?U){PHONE}", -1), phone_matches(text))


def scrub(text: Column) -> Column:
    """All kinds in order: e-mail, card, phone."""
    return scrub_phone(scrub_card(scrub_email(text)))


def with_scrubbed(df: DataFrame, text: str, clean: str, found: str) -> DataFrame:
    """Adds ``scrub`` and ``counts`` of a text column, each pattern run once and phones twice.

    A text is cut where a pattern matches: the pieces give both the text with
    placeholders and the number of matches. The columns in between are of their own
    steps, so that none is computed for each of its uses.
    """
    cut = lambda value, pattern: F.split(value, f"(?U){pattern}", -1)
    steps = df.withColumn("__email", cut(F.col(text), EMAIL))
    steps = steps.withColumn("__card", cut(F.array_join("__email", PLACEHOLDERS["email"]), CARD))
    steps = steps.withColumn("__rest", F.array_join("__card", PLACEHOLDERS["card"]))
    steps = steps.withColumns({"__phone": phone_matches(F.col("__rest")), "__between": cut(F.col("__rest"), PHONE)})
    n = {"email": F.size("__email") - 1, "card": F.size("__card") - 1, "phone": F.size(F.filter("__phone", _is_phone))}
    every = F.create_map(*[x for kind, c in n.items() for x in (F.lit(kind), c.cast("long"))])
    made = {clean: _joined(F.col("__between"), F.col("__phone")), found: F.map_filter(every, lambda _, c: c > 0)}
    return steps.withColumns(made).drop("__email", "__card", "__rest", "__phone", "__between")


def counts(text: Column) -> Column:
    """map<kind, matches> of the kinds that occur."""
    after_email = scrub_email(text)
    after_card = scrub_card(after_email)
    n = {
        "email": F.regexp_count(text, _unicode(EMAIL)),
        "card": F.regexp_count(after_email, _unicode(CARD)),
        "phone": F.size(F.filter(phone_matches(after_card), _is_phone)),
    }
    every = F.create_map(*[x for kind, c in n.items() for x in (F.lit(kind), c.cast("long"))])
    return F.map_filter(every, lambda _, c: c > 0)
