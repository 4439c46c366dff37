"""Students: the keyword stand-in, confidences, and a trainable baseline.

The baseline replaces a fine-tuned language model where none can run: hashed words
into one logistic regression a field, whose class probability is the confidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contract import triage_json
from ..functions.heuristics import order_id, with_keyword_triage
from ..schemas import ENUMS, STRUCTURED, TRIAGE


def _same_for_all(confidence: Column) -> Column:
    return F.create_map(*[x for f in STRUCTURED for x in (F.lit(f), confidence)])


def keyword_student(texts: DataFrame) -> DataFrame:
    """Predictions of the keyword student for (pos, id, text)."""
    made = with_keyword_triage(texts, F.col("text"))
    triage = F.struct(*[F.col(f"k.{f}").alias(f) for f in (*STRUCTURED, "summary")]).cast(TRIAGE)
    return made.withColumn("triage", triage).select(
        "pos",
        "id",
        triage_json(F.col("triage")).alias("raw"),
        "triage",
        F.lit(True).alias("json_valid"),
        F.lit(None).cast("string").alias("error"),
        F.col("k.confidence").alias("confidence"),
        _same_for_all(F.col("k.confidence")).alias("field_confidence"),
        F.lit(0.0).alias("latency_s"),
    )


def field_confidences(text: Column, token_ends: Column, token_probs: Column) -> Column:
    """map<field, probability of the first token of its value> of a generated answer.

    ``token_ends`` are the character offsets where tokens end. A field that is not
    in the text, or has no token after it, is left out.
    """
    tokens = F.arrays_zip(token_ends.alias("end"), token_probs.alias("prob"))

    def confidence(field: str) -> Column:
        before = F.regexp_extract(text, rf'(?s)^(.*?"{field}"\s*:\s*"?)', 1)
        after = F.filter(tokens, lambda t: t["end"] > F.length(before))
        return F.when(before != "", F.bround(F.get(after, F.lit(0))["prob"], 4))

    every = F.create_map(*[x for f in STRUCTURED for x in (F.lit(f), confidence(f))])
    return F.map_filter(every, lambda _, v: v.isNotNull())


def answer_confidence(confidences: Column) -> Column:
    """The least confidence of the structured fields; 0 if any is missing."""
    values = [F.try_element_at(confidences, F.lit(f)) for f in STRUCTURED]
    whole = F.forall(F.array(*values), lambda v: v.isNotNull())
    return F.when(F.coalesce(whole, F.lit(False)), F.least(*values)).otherwise(0.0)


def train_baseline(examples: DataFrame, features: int = 1 << 12):
    """A pipeline model over (text, triage): hashed words, one classifier an enum field."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer, StringIndexer

    rows = examples.select("text", *[F.col(f"triage.{f}").alias(f) for f in ENUMS])
    stages = [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W+"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
    ]
    for f in ENUMS:
        stages.append(StringIndexer(inputCol=f, outputCol=f"{f}_index", handleInvalid="skip"))
        stages.append(
            LogisticRegression(
                labelCol=f"{f}_index", featuresCol="features", predictionCol=f"{f}_pred", probabilityCol=f"{f}_prob",
                rawPredictionCol=f"{f}_raw", maxIter=20, regParam=0.01,
            )
        )
    return Pipeline(stages=stages).fit(rows)


def baseline_student(model, texts: DataFrame) -> DataFrame:
    """Predictions of the trained baseline for (pos, id, text)."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import StringIndexerModel
    from pyspark.ml.functions import vector_to_array

    out, confidences = texts, {}
    labels = {s.getInputCol(): s.labels for s in model.stages if isinstance(s, StringIndexerModel)}
    for stage in model.stages:
        if not isinstance(stage, StringIndexerModel):
            out = stage.transform(out)
        if isinstance(stage, LogisticRegressionModel):
            f = stage.getLabelCol().removesuffix("_index")
            names = F.array(*[F.lit(x) for x in labels[f]])
            out = out.withColumn(f, F.element_at(names, F.col(f"{f}_pred").cast("int") + 1))
            confidences[f] = F.array_max(vector_to_array(f"{f}_prob"))
    number = order_id(F.col("text"))
    summary = F.concat(F.lit("Customer has a "), F.replace("intent", F.lit("_"), F.lit(" ")), F.lit(" request."))
    triage = F.struct(*[F.col(f) for f in ENUMS], number.alias("order_id"), summary.alias("summary")).cast(TRIAGE)
    confidences["order_id"] = F.lit(1.0)
    each = F.create_map(*[x for f, c in confidences.items() for x in (F.lit(f), c)])
    return out.select("pos", "id", triage.alias("triage"), each.alias("field_confidence")).select(
        "pos",
        "id",
        triage_json(F.col("triage")).alias("raw"),
        "triage",
        F.lit(True).alias("json_valid"),
        F.lit(None).cast("string").alias("error"),
        answer_confidence(F.col("field_confidence")).alias("confidence"),
        "field_confidence",
        F.lit(0.0).alias("latency_s"),
    )
