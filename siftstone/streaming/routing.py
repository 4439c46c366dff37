"""Streams: the student-first router over arriving texts, and event windows.

The event windows are an extension; the batch engine has no counterpart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import valid_request
from ..operators.router import compare_answers, decide
from ..operators.student import keyword_student
from ..operators.teacher import label_tickets, offline_answers
from ..schemas import TRIAGE
from ..sources.scratch import Scratch
from ..sources.tables import with_pos, write_jsonl

#: How a teacher is asked, and what takes the answers of a batch with its number.
Ask = Callable[..., DataFrame]
Sink = Callable[[DataFrame, int], None]
ANSWER = f"id string, triage {TRIAGE}, source string, reason string, confidence double, batch long"


def routed(texts: DataFrame, threshold: float) -> DataFrame:
    """Student predictions with their route; works on batches and streams alike."""
    rows = texts if "pos" in texts.columns else texts.withColumn("pos", F.lit(0).cast("long"))
    made = keyword_student(rows.filter(valid_request(F.col("text"))))
    found = decide(F.col("json_valid"), F.col("triage"), F.col("confidence"), threshold)
    return made.withColumn("d", found).select("*", "d.*").drop("d")


def _labelled(rows: DataFrame, teacher: str, ask: Ask, store: Scratch | None) -> DataFrame:
    """(id, teacher, teacher_model, teacher_error) of rows (pos, id, text), by one teacher."""
    label = F.get("labels", F.lit(0))
    made = label_tickets(rows, [teacher], ask=ask, store=store)
    return made.select("id", label["triage"].alias("teacher"), label["model"].alias("teacher_model"), label["error"].alias("teacher_error"))


def answer_batch(texts: DataFrame, threshold: float, teacher: str | None, ask: Ask = offline_answers, store: Scratch | None = None) -> DataFrame:
    """Final answers of a batch (id, text): the student's, or the teacher's where routed to it.

    ``source`` is student, teacher, or none where the teacher is missing or failed; a
    failure is told in ``reason``. ``ask`` is how a teacher is asked, and ``store`` keeps
    the tables in between, so that the caller may delete them with the batch.
    """
    rows = with_pos(texts.filter(valid_request(F.col("text"))).select("id", "text"), scratch=store)
    judged = routed(rows, threshold).select("id", "triage", "route", "reason", "confidence")
    if teacher is None:
        kept = F.when(F.col("route") == "student", F.col("triage"))
        source = F.when(F.col("route") == "student", "student").otherwise("none")
        return judged.select("id", kept.alias("triage"), source.alias("source"), "reason", "confidence")
    asked = rows.join(judged.filter("route = 'teacher'").select("id"), "id", "left_semi")
    both = judged.join(_labelled(asked, teacher, ask, store), "id", "left")
    answer = F.when(F.col("route") == "student", F.col("triage")).otherwise(F.col("teacher"))
    source = F.when(F.col("route") == "student", "student").when(F.col("teacher").isNotNull(), "teacher").otherwise("none")
    failed = F.concat(F.lit("; teacher error: "), F.col("teacher_error"))
    reason = F.concat("reason", F.coalesce(F.when(source == "none", failed), F.lit("")))
    return both.select("id", answer.alias("triage"), source.alias("source"), reason.alias("reason"), "confidence")


def compare_batch(texts: DataFrame, threshold: float, teacher: str | None, ask: Ask = offline_answers, store: Scratch | None = None) -> DataFrame:
    """Student and teacher side by side for texts (id, text), and ``teacher`` if some are answered.

    The teacher is asked for every text that has no answer yet, whatever the route, and no
    other. Without a teacher or after a failure its answer is null and ``teacher_error``
    says why; ``differs`` lists the fields on which the two differ. Texts that no request
    may hold are left out.
    """
    rows = with_pos(texts.filter(valid_request(F.col("text"))), scratch=store)
    judged = routed(rows.select("pos", "id", "text"), threshold)
    judged = judged.select("id", F.col("triage").alias("student"), "confidence", "route", "reason")
    known = rows.select("id", F.col("teacher").cast(TRIAGE).alias("known") if "teacher" in texts.columns else F.lit(None).cast(TRIAGE).alias("known"))
    if teacher is None:
        asked = rows.select("id", F.lit(None).cast(TRIAGE).alias("teacher"), F.lit(None).cast("string").alias("teacher_model"), F.lit("no teacher").alias("teacher_error"))
    else:
        open_rows = rows.select("pos", "id", "text").join(known.filter("known IS NULL").select("id"), "id", "left_semi")
        asked = _labelled(open_rows, teacher, ask, store)
    both = judged.join(known, "id").join(asked, "id", "left")
    error = F.when(F.col("known").isNull(), F.col("teacher_error"))
    both = both.withColumns({"teacher": F.coalesce("known", "teacher"), "teacher_error": error})
    model = F.when(F.col("known").isNull(), F.col("teacher_model"))
    return compare_answers(both.withColumn("teacher_model", model).drop("known"))


def batch_sink(folder: str) -> Sink:
    """A sink that writes each batch of answers as a JSON-lines folder named by its number.

    A batch that comes again replaces what its first try left, as a whole.
    """

    def sink(answers: DataFrame, number: int) -> None:
        write_jsonl(answers.withColumn("batch", F.lit(number).cast("long")), f"{folder}/batch-{number:010d}", order=None)

    return sink


def written_answers(spark: SparkSession, folder: str) -> DataFrame:
    """What ``batch_sink`` has written: the answers of every finished batch, with its number."""
    return spark.read.schema(ANSWER).json(f"{folder}/batch-{'[0-9]' * 10}")


def start_router(
    stream: DataFrame, threshold: float, teacher: str | None, sink: Sink, checkpoint: str, compare: bool = False, ask: Ask = offline_answers
):
    """Answer (or ``compare``) every micro-batch and hand it to a sink with its number.

    A batch may come again after a failure; a sink that overwrites by batch number
    is then exactly once. Tables in between go when the sink is done.
    """
    made = compare_batch if compare else answer_batch

    def run(batch: DataFrame, number: int) -> None:
        store = Scratch(batch.sparkSession, f"batch-{number}")
        try:
            sink(made(batch, threshold, teacher, ask, store), number)
        finally:
            store.clear()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).start()


def event_time(events: DataFrame) -> DataFrame:
    """Events with a time that watermarks accept."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, window: Column, lateness: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; ``window`` is F.window or F.session_window over ts."""
    held = event_time(events)
    if held.isStreaming:
        held = held.withWatermark("ts", lateness)
    return held.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total"
    )
