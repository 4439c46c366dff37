"""Keyword triage as a chain of CASE expressions: the offline teacher and student."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keywords by class, in the order in which classes are tried.
INTENT_WORDS = {
    "other": ("partnership", "collaborat", "seo services", "resume", "job opening", "sponsor", "backlinks"),
    "account_access": (
        "password", "log in", "login", "logged out", "sign in", "2fa", "two-factor", "verification code", "hacked",
        "locked out",
    ),
    "billing_issue": (
        "charged twice", "double charge", "charged me", "invoice", "receipt", "payment failed", "card was declined",
        "unknown charge", "wrong amount", "billed",
    ),
    "cancellation": ("cancel",),
    "refund_request": ("refund", "money back", "reimburse"),
    "return_exchange": (
        "return", "exchange", "replacement", "swap", "arrived damaged", "arrived broken", "wrong item",
    ),
    "order_status": (
        "where is my order", "tracking", "not arrived", "hasn't arrived", "has not arrived", "delivery", "shipped",
        "package", "still waiting",
    ),
    "setup_help": ("how do i", "how to", "set up", "setup", "install", "pair", "configure", "new "),
    "technical_issue": (
        "offline", "not working", "stopped", "crash", "error", "disconnect", "won't", "doesn't", "broken", "keeps",
    ),
    "product_question": (
        "compatible", "does the", "do you", "difference", "in stock", "warranty", "support for", "?",
    ),
    "feedback": ("love", "great", "suggestion", "feature request", "would be nice", "awesome", "thank"),
}
PRODUCT_WORDS = {
    "subscription": ("protect", "subscription", "cloud", "plan", "recordings"),
    "doorbell": ("doorbell", "chime"),
    "camera": ("camera", "sentry", "cam "),
    "thermostat": ("thermostat", "aura", "heating", "heat", "cooling"),
    "lighting": ("bulb", "light", "lamp", "glow", "strip"),
    "app_account": ("app", "account", "password", "login", "log in", "email"),
}
NEGATIVE_WORDS = (
    "angry", "terrible", "ridiculous", "unacceptable", "worst", "frustrat", "disappoint", "annoy", "!!", "useless",
    "awful", "fed up", "still waiting", "again", "wtf", "joke",
)
POSITIVE_WORDS = ("love", "great", "awesome", "amazing", "fantastic", "happy", "excellent", "perfect")
HIGH_URGENCY_WORDS = (
    "hacked", "smoke", "spark", "burning", "overheat", "no heat", "freezing", "not heating", "security", "break-in",
    "chargeback", "lawyer", "legal", "third time", "3rd time", "today", "asap", "urgent", "immediately",
)
LOW_URGENCY_INTENTS = ("product_question", "feedback", "other", "setup_help")
ORDER_ID = r"(?:#\s*)?\b(?:BL[\s-]?)?(\d{6})\b"
ORDER_CONTEXT = r"order|#|\bbl[\s-]?\d{6}"


def _hits(text: Column, words: tuple[str, ...]) -> Column:
    """How many different words the text contains."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda word: F.contains(text, word)))


def _first(names, hits: Column, default: str) -> Column:
    chain = F.lit(default)
    for name in reversed(names):
        chain = F.when(hits[name] > 0, name).otherwise(chain)
    return chain


def order_id(text: Column) -> Column:
    """The first six-digit order number of a text that speaks of an order."""
    digits = F.regexp_extract(text, f"(?iU){ORDER_ID}", 1)
    return F.when(F.rlike(text, F.lit(f"(?iU){ORDER_CONTEXT}")) & (digits != ""), F.concat(F.lit("BL-"), digits))


#: Keywords by what they count for.
_COUNTED = {**INTENT_WORDS, **PRODUCT_WORDS, "negative": NEGATIVE_WORDS, "positive": POSITIVE_WORDS, "high": HIGH_URGENCY_WORDS}


def _decided(hits: Column, number: Column, strict_urgency: bool) -> Column:
    intent, product = _first(INTENT_WORDS, hits, "other"), _first(PRODUCT_WORDS, hits, "none")
    won = F.coalesce(*[F.nullif(hits[name], F.lit(0)) for name in INTENT_WORDS], F.lit(0))
    sentiment = (
        F.when(hits["negative"] > hits["positive"], "negative").when(hits["positive"] > hits["negative"], "positive").otherwise("neutral")
    )
    low = intent.isin(*LOW_URGENCY_INTENTS)
    urgency = F.when(hits["high"] >= (2 if strict_urgency else 1), "high").when(low, "low").otherwise("medium")
    words = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    about = F.when(product == "none", "").otherwise(F.concat(F.lit(" about their "), words(product)))
    order = F.coalesce(F.concat(F.lit(" (order "), number, F.lit(")")), F.lit(""))
    summary = F.concat(F.lit("Customer has a "), words(intent), F.lit(" request"), about, order, F.lit("."))
    sure = F.least(F.lit(1.0), 0.35 + 0.2 * won + F.when(product != "none", 0.1).otherwise(0.0))
    return F.struct(
        intent.alias("intent"),
        urgency.alias("urgency"),
        sentiment.alias("sentiment"),
        product.alias("product_area"),
        number.alias("order_id"),
        summary.alias("summary"),
        F.bround(sure, 3).alias("confidence"),
    )


def with_keyword_triage(df: DataFrame, text: Column, strict_urgency: bool = False, name: str = "k") -> DataFrame:
    """Adds struct<intent, urgency, sentiment, product_area, order_id, summary, confidence>.

    Strict urgency asks for two urgent words instead of one; the second of the
    offline teachers uses it. The struct is made in three generate steps, so that the
    planner copies neither the lowered text nor the counts into what is built on them.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    made = F.struct(F.concat(F.lit(" "), F.lower(text), F.lit(" ")).alias("lowered"), order_id(text).alias("number"))
    read = df.select(*kept, F.explode(F.array(made)).alias("__read"))
    counts = F.struct(*[_hits(F.col("__read.lowered"), words).alias(k) for k, words in _COUNTED.items()])
    said = read.select(*kept, F.col("__read.number").alias("__number"), F.explode(F.array(counts)).alias("__hits"))
    return said.select(*kept, F.explode(F.array(_decided(F.col("__hits"), F.col("__number"), strict_urgency))).alias(name))
