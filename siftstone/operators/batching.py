"""Batches, systematic samples and the matrix of generation seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hash_order, padded_id
from ..schemas import INTENTS, PRODUCT_AREAS
from ..sources.tables import with_pos

# The axes of the seed matrix and their weights.
TONES = ("angry", "frustrated", "neutral", "polite", "happy")
LENGTHS = (("short", 4), ("medium", 4), ("long", 2))
STYLES = (
    "clean and well written",
    "several typos and missing punctuation",
    "all lowercase, chat style, no greeting",
    "non-native English speaker",
    "formal email with greeting and sign-off",
    "very terse, a few words",
)
ORDER_TOPICS = ("order_status", "refund_request", "return_exchange", "cancellation", "billing_issue")
TOPIC_PRODUCTS = {
    "account_access": ("app_account",),
    "cancellation": tuple(p for p in PRODUCT_AREAS if p != "app_account"),
    "billing_issue": ("subscription", "none", "camera", "thermostat"),
    "other": ("none",),
}
ORDER_SHARE, OTHER_ORDER_SHARE, CONTACT_SHARE = 0.7, 0.12, 0.15


def batch_id(pos: Column, size: int) -> Column:
    """Consecutive batches of a size; the last may be short."""
    return F.floor(pos / F.lit(size)).cast("long")


def with_batches(df: DataFrame, size: int, pos: str = "pos") -> DataFrame:
    return df.withColumn("batch", batch_id(F.col(pos), size))


def systematic_sample(df: DataFrame, limit: int, pos: str = "pos") -> DataFrame:
    """Every n-th row, n so that the rows span the table, and the first ``limit`` of them."""
    step = max(1, df.count() // limit)
    return df.filter(F.col(pos) % step == 0).orderBy(pos).limit(limit)


def uniform(seed: str, key: Column, axis: str) -> Column:
    """A number in [0, 1) that depends on the seed, the key and the axis alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:{axis}:"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def _pick(u: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def _weighted(u: Column, values: tuple[tuple[str, int], ...]) -> Column:
    return _pick(u, tuple(v for v, w in values for _ in range(w)))


def seed_matrix(spark: SparkSession, num: int, seed: int = 42, topics: tuple[str, ...] = INTENTS, prefix: str = "s") -> DataFrame:
    """Generation seeds (pos, id, topic, ..., contact_details), shuffled by hash.

    Topics take turns. Each axis of a row is drawn by a hash of its id, so the rows
    do not depend on how many there are or how they are partitioned.
    """
    name = str(seed) if prefix == "s" else f"{seed}-{prefix}"
    rows = spark.range(num).withColumn("id_", padded_id(prefix, F.col("id")))
    key = F.col("id_")
    topic = F.element_at(F.array(*[F.lit(t) for t in topics]), (F.col("id") % len(topics) + 1).cast("int"))
    product = _pick(uniform(name, key, "product"), tuple(p for p in PRODUCT_AREAS if p != "none"))
    for t, products in TOPIC_PRODUCTS.items():
        product = F.when(topic == t, _pick(uniform(name, key, "product"), products)).otherwise(product)
    tone = _pick(uniform(name, key, "tone"), TONES)
    again = _pick(uniform(name, key, "tone-again"), ("happy", "frustrated"))
    share = F.when(topic.isin(*ORDER_TOPICS), ORDER_SHARE).otherwise(OTHER_ORDER_SHARE)
    made = rows.select(
        key.alias("id"),
        topic.alias("topic"),
        product.alias("product"),
        F.when((topic == "feedback") & (tone == "neutral"), again).otherwise(tone).alias("tone"),
        _weighted(uniform(name, key, "length"), LENGTHS).alias("length"),
        _pick(uniform(name, key, "style"), STYLES).alias("style"),
        (uniform(name, key, "order") < share).alias("order_number"),
        (uniform(name, key, "contact") < CONTACT_SHARE).alias("contact_details"),
    )
    return with_pos(made.orderBy(hash_order(seed, F.col("id"))))


def seed_map(df: DataFrame) -> DataFrame:
    """Adds ``seed``, the axes as a map of strings."""
    axes = [c for c in df.columns if c != "pos"]
    return df.withColumn("seed", F.create_map(*[x for c in axes for x in (F.lit(c), F.col(c).cast("string"))]))
