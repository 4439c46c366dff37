"""Answers of remote models: cache, ledger and budget as tables.

A request is known by the hash of all that decides its answer. Cached answers are joined
and the rest is asked for. Each call is written to a journal within its task, as a file of
its own that is complete or absent, before the task goes on: a task that runs again reads
what its partition has asked already and spends nothing twice. After a pass the journal
is added to cache and ledger; what a broken pass has left is added by the next one.
"""

from __future__ import annotations

import json
import math
import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER
from .scratch import Scratch, delete
from .tables import exists

# The longest waits in seconds and the spread of a wait.
RETRY_AFTER_CAP, BACKOFF_CAP, JITTER = 120.0, 90.0, (0.75, 1.25)
FREE = ":free"
#: Statuses worth another try; others below 500 are final.
RETRYABLE = frozenset({408, 409, 429})


#: Columns of the ledger but its time, in order.
LEDGER_COLUMNS = [column.split()[0] for column in LEDGER.split(", ")][1:]


def cache_key(provider: Column, system: Column, user: Column, schema_text: Column, extra: Column) -> Column:
    """Hex sha256 of the request, keys in order."""
    request = F.struct(extra.alias("extra"), provider.alias("provider"), schema_text.alias("schema"), system.alias("system"), user.alias("user"))
    return F.sha2(F.to_json(request, {"ignoreNullFields": "false"}), 256)


def split_cached(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their answers, misses) of requests by key."""
    return requests.join(cache, "key"), requests.join(cache.select("key"), "key", "left_anti")


def is_retryable(status: int | None) -> bool:
    """Without a status (timeouts, empty answers) and for overload, yes."""
    return status is None or status in RETRYABLE or status >= 500


def backoff(attempt: int, base: float, retry_after: float | None, rng: random.Random) -> float:
    """Seconds to wait before the next try."""
    if retry_after is not None:
        return min(retry_after, RETRY_AFTER_CAP)
    return min(base * 2**attempt, BACKOFF_CAP) * rng.uniform(*JITTER)


#: What the cache keeps of an answer.
CACHED = "key string, text string, served_model string, latency_s double, input_tokens int, output_tokens int, items int"
#: A call in the journal: all that cache and ledger keep of it.
JOURNAL = "key string, text string, " + LEDGER
#: The status of a request that was not asked; it is no call and has no place in the ledger.
UNASKED = "unasked"
#: A call starts within this share of the spacing after its slot begins, or waits for the next.
GUARD = 0.05


@dataclass(frozen=True)
class Journal:
    """Calls of one pass, a file each in the folder of its partition.

    Tasks write through Arrow's file systems, so the folder is one that all executors
    reach: a shared mount, HDFS or an object store.
    """

    path: str

    def _at(self, part: int):
        from pyarrow import fs

        scheme = "://" in self.path or self.path.startswith("file:/")
        store, root = fs.FileSystem.from_uri(self.path) if scheme else (fs.LocalFileSystem(), self.path)
        return store, f"{root}/{part}"

    def put(self, part: int, record: dict) -> None:
        """Add a call; its file appears under its name when it is complete."""
        store, folder = self._at(part)
        store.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{folder}/_{name}") as out:  # readers skip names with an underscore
            out.write(json.dumps(record, ensure_ascii=False).encode("utf-8", "replace"))
        store.move(f"{folder}/_{name}", f"{folder}/{name}.json")

    def records(self, part: int) -> list[dict]:
        """What the partition has asked, by earlier attempts of its task too."""
        from pyarrow import fs

        store, folder = self._at(part)
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        out = []
        for info in found:
            if not info.base_name.startswith("_"):
                with store.open_input_stream(info.path) as stream:
                    out.append(json.loads(stream.read()))
        return out


def next_slot(now: float, spacing: float, part: int, parts: int, after: int) -> tuple[int, float]:
    """The slot in which a task may start its next call, and the seconds until then.

    Time is cut into slots a little longer than ``spacing``, dealt to the tasks in turn, and
    a call starts in the first moments of a slot of its task. Starts of all tasks are thus
    ``spacing`` apart without a word between them; a slot whose task has no call is lost.
    """
    width = spacing * (1 + GUARD)
    slot = max(math.floor(now / width), after + 1)
    slot += (part - slot) % parts
    if now > slot * width + spacing * GUARD:
        slot += parts
    return slot, max(0.0, slot * width - now)


@dataclass(frozen=True)
class Asker:
    """Asks for the requests of one partition; see ``ask_remote``."""

    make_client: Callable
    spacing: float
    retries: int
    base: float
    shares: tuple[int, ...]
    journal: Journal
    after: int
    now: str

    def __call__(self, part: int, requests: Iterator) -> Iterator[tuple]:
        """(key, status, error) of each request's end; calls go to the journal."""
        past = self.journal.records(part)
        answered = {r["key"] for r in past if r["status"] == "ok"}
        failed = {r["key"]: r["error"] for r in past if r["status"] == "error"}
        tried: dict[str, int] = {}
        for r in past:
            tried[r["key"]] = tried.get(r["key"], 0) + 1
        left, slot, client, rng = self.shares[part] - len(past), self.after, None, random.Random(part)
        for r in requests:
            if r.key in answered:
                yield r.key, "ok", None
                continue
            if r.key in failed:
                yield r.key, "error", failed[r.key]
                continue
            for attempt in range(tried.get(r.key, 0), self.retries + 1):
                if left <= 0:
                    yield r.key, UNASKED, "budget is used up"
                    break
                client = client or self.make_client()
                while self.spacing > 0:
                    slot_now, wait = next_slot(time.time(), self.spacing, part, len(self.shares), slot)
                    if not wait:
                        slot = slot_now
                        break
                    time.sleep(wait)
                left -= 1
                began = time.monotonic()
                call = {"key": r.key, "ts": self.now, "stage": r.stage, "task": r.task, "provider": r.provider, "items": int(r.items)}
                try:
                    text, model, n_in, n_out = client(r.system, r.user)
                except Exception as error:  # becomes a row, whatever the client raises
                    final = getattr(error, "final", False) or not is_retryable(getattr(error, "status", None))
                    again = not final and attempt < self.retries
                    call |= {"status": "retryable_error" if again else "error", "error": str(error)[:300]}
                    self.journal.put(part, call | {"latency_s": time.monotonic() - began, "input_tokens": 0, "output_tokens": 0})
                    if not again:
                        yield r.key, "error", call["error"]
                        break
                    time.sleep(backoff(attempt, self.base, getattr(error, "retry_after", None), rng))
                else:
                    call |= {"text": text, "served_model": model, "status": "ok", "input_tokens": n_in, "output_tokens": n_out}
                    self.journal.put(part, call | {"latency_s": time.monotonic() - began})
                    yield r.key, "ok", None
                    break
            else:  # the task was lost after the last try was written as one to be repeated
                if tried.get(r.key, 0) > self.retries:
                    yield r.key, "error", "no try is left"


def shares_of(budget: int, sizes: list[int]) -> tuple[int, ...]:
    """The calls of each partition: one a request as far as they go, the rest for further tries."""
    out, left = [0] * len(sizes), budget
    while left > 0 and any(o < s for o, s in zip(out, sizes, strict=True)):
        wanting = [p for p, s in enumerate(sizes) if out[p] < s]
        each, more = divmod(left, len(wanting))
        for at, p in enumerate(wanting):
            given = min(sizes[p] - out[p], each + (at < more))
            out[p] += given
            left -= given
    each, more = divmod(left, len(sizes))
    return tuple(o + each + (p < more) for p, o in enumerate(out))


def ask_remote(
    requests: DataFrame, make_client: Callable, journal: Journal, now: str, spacing: float, retries: int, base: float, budget: int, tasks: int = 4
) -> DataFrame:
    """(key, status, error) of each request (key, stage, task, provider, system, user, items).

    ``make_client`` runs once a task, when it has a call to make, and returns a function
    (system, user) to (text, model, tokens_in, tokens_out), raising an error with ``status``
    and ``retry_after``, or with ``final`` where another try can't help. Requests are dealt
    to ``tasks`` tasks by key. Starts of calls are ``spacing`` seconds apart over all tasks
    and passes of a run. The budget is shared out by the requests of each task; a request
    beyond it is ``unasked``.
    """
    parts = max(1, tasks)
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    counts = {r["p"]: r["c"] for r in requests.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect()}
    shares = shares_of(budget, [counts.get(p, 0) for p in range(parts)])
    width = spacing * (1 + GUARD)
    asker = Asker(make_client, spacing, retries, base, shares, journal, math.floor(time.time() / width) if spacing else 0, now)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId()
        rows = (r for batch in batches for r in batch.itertuples())
        for row in asker(at, rows):
            yield pd.DataFrame([row], columns=["key", "status", "error"])

    return requests.repartitionById(parts, part).mapInPandas(run, "key string, status string, error string")


def fold_journals(spark: SparkSession, journals: str, cache: str, ledger: str) -> None:
    """Add all journals to cache and ledger and delete them.

    A driver lost between the two leaves a journal that is added again: calls may then
    count twice against the budget, but none is missed; answers are known by their key.
    """
    if not exists(spark, journals):
        return
    calls = spark.read.schema(JOURNAL).option("recursiveFileLookup", True).json(journals)
    names = [c.split()[0] for c in CACHED.split(", ")]
    calls.filter("status = 'ok'").select(names).write.mode("append").json(cache)
    calls.select("ts", *LEDGER_COLUMNS).write.mode("append").json(ledger)
    delete(spark, journals)


def asked(spark: SparkSession, requests: DataFrame, make_client: Callable, cache: str, ledger: str, now: str, budget: int, **pace) -> DataFrame:
    """A row a request: what the cache has of it or else the client answers, and ``failure`` in place of an answer.

    Every call is in the journal beside the cache before its task goes on, and counts
    against the budget. Equal requests are asked once.
    """
    journals = f"{cache.rstrip('/')}-journal"
    fold_journals(spark, journals, cache, ledger)
    known = spark.read.schema(CACHED).json(cache).dropDuplicates(["key"]) if exists(spark, cache) else None
    unique = requests.dropDuplicates(["key"])
    scratch = Scratch(spark, "calls")
    misses = scratch.save(unique if known is None else split_cached(unique, known)[1], "misses")
    left = calls_left(spark, ledger, budget)
    made = scratch.save(ask_remote(misses, make_client, Journal(f"{journals}/{uuid.uuid4().hex}"), now, budget=left, **pace), "made")
    fold_journals(spark, journals, cache, ledger)
    failed = made.filter("status <> 'ok'").groupBy("key").agg(F.first("error").alias("failure"))
    if exists(spark, cache):
        answers = spark.read.schema(CACHED).json(cache).dropDuplicates(["key"])
    else:
        answers = spark.createDataFrame([], CACHED)
    return requests.select("key").join(answers, "key", "left").join(failed, "key", "left")


def asked_once(spark: SparkSession, requests: DataFrame, make_client: Callable, folder: str, now: str, budget: int, **pace) -> DataFrame:
    """(key, text) of requests that have an answer, with cache and ledger in a folder."""
    every = asked(spark, requests, make_client, f"{folder}/cache", f"{folder}/ledger", now, budget, **pace)
    return every.filter("text IS NOT NULL").select("key", "text")


def calls_left(spark: SparkSession, path: str, budget: int) -> int:
    """The budget of a run folder less the calls its ledger has."""
    used = spark.read.schema(LEDGER).json(path).count() if exists(spark, path) else 0
    return max(0, budget - used)


def ledger_rollup(ledger: DataFrame) -> DataFrame:
    """(stage, status, served_model, count), an unknown model as "-"."""
    model = F.coalesce("served_model", F.lit("-")).alias("served_model")
    return ledger.groupBy("stage", "status", model).agg(F.count("*").alias("count"))


def ledger_view(ledger: DataFrame) -> DataFrame:
    """One row: totals by status, and whether all that was used is free."""
    free = lambda c: F.endswith(c, F.lit(FREE))
    paid = ~free(F.coalesce("provider", F.lit(""))) | ~free(F.coalesce("served_model", F.lit(FREE)))
    return ledger.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "retryable_error").alias("retried"),
        F.count_if(F.col("status") == "error").alias("failed"),
        (F.count_if(paid) == 0).alias("all_free"),
    )


def ledger_counts(ledger: DataFrame) -> DataFrame:
    """(kind, name, count): calls by served model and by stage, the most frequent first."""
    names = F.array(
        F.struct(F.lit("model").alias("kind"), F.coalesce("served_model", F.lit("-")).alias("name")),
        F.struct(F.lit("stage").alias("kind"), F.col("stage").alias("name")),
    )
    counted = ledger.select(F.explode(names).alias("n")).groupBy("n.kind", "n.name").agg(F.count("*").alias("count"))
    return counted.orderBy("kind", F.desc("count"), "name")


def check_free(models: list[str], always_paid: tuple[str, ...] = ("anthropic", "openai")) -> None:
    """Raise unless every provider/model id ends in the free suffix."""
    paid = [m for m in models if not m.endswith(FREE) or m.split("/", 1)[0] in always_paid]
    if paid:
        raise ValueError(f"only free models are allowed, not {', '.join(paid)}")


def free_models(listing: list[dict], structured: bool = False) -> list[str]:
    """Ids of a model listing that are free, and take a response format if asked."""
    return [m["id"] for m in listing if m["id"].endswith(FREE) and (not structured or "response_format" in m.get("supported_parameters", []))]
