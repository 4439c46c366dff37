"""Tables on disk and the routed stream."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siftstone.operators import teacher
from siftstone.sources import calls, tables
from siftstone.streaming import routing

# workers do not import tests, so the scripted clients travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", None), (1, "é", "x")], "pos long, id string, note string")
    tables.write_jsonl(df, f"{tmp_path}/t.jsonl")
    back = tables.read_jsonl(spark, f"{tmp_path}/t.jsonl", "id string, note string").orderBy("pos").collect()
    assert [(r.pos, r.id, r.note) for r in back] == [(0, "a", None), (1, "é", "x")]


def test_bad_lines_raise(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a"}\n\n{bad\n')
    with pytest.raises(Exception, match="not a JSON record"):
        tables.read_jsonl(spark, str(tmp_path / "x.jsonl"), "id string").collect()


def test_bad_lines_are_named_by_file_and_line(spark, tmp_path):
    """In files that several tasks read, with blank lines and more than one bad one."""
    folder = tmp_path / "many"
    folder.mkdir()
    for name, bad in (("a", (700, 20)), ("b", ())):
        lines = ["" if i % 7 == 3 else json.dumps({"id": f"é{i}"}, ensure_ascii=False) for i in range(1, 1001)]
        for i in bad:
            lines[i - 1] = "{bad"
        (folder / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in kept:
            spark.conf.set(k, "1000b" if "max" in k else "0b")
        with pytest.raises(ValueError, match="a.jsonl:20: not a JSON record: {bad"):
            tables.read_jsonl(spark, str(folder), "id string")
        found = tables.bad_lines(spark, str(folder), "id string")
        assert {(r.file.rsplit("/", 1)[-1], r.line, r.text) for r in found.collect()} == {("a.jsonl", 700, "{bad"), ("a.jsonl", 20, "{bad")}
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
        (folder / "a.jsonl").unlink()
        ids = [r.id for r in tables.read_jsonl(spark, str(folder), "id string").orderBy("pos").collect()]
        assert ids == [f"é{i}" for i in range(1, 1001) if i % 7 != 3]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("line", ['[{"n": 1}]', "7", '"x"', '{"n": "x"}', '{"n": 1} more', '{"n": [1]}'])
def test_lines_that_break_the_schema_raise(spark, tmp_path, line):
    (tmp_path / "x.jsonl").write_text('{"n": 1}\n' + line + "\n")
    with pytest.raises(ValueError, match="x.jsonl:2: not a JSON record"):
        tables.read_jsonl(spark, str(tmp_path / "x.jsonl"), "n long")


def test_a_failed_write_leaves_the_rows_of_before(spark, tmp_path):
    path = f"file://{tmp_path}/t.jsonl"
    tables.write_jsonl(spark.range(3), path)
    half = spark.range(9, numPartitions=3).select(F.when(F.col("id") == 8, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_jsonl(half, path)
    rows = lambda: sorted(r.id for r in tables.read_jsonl(spark, path, "id long").collect())
    assert rows() == [0, 1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["t.jsonl"]
    # a table may replace itself, and one whose swap did not end is read under its old name
    tables.write_jsonl(spark.read.schema("id long").json(path).filter("id > 0"), path)
    assert rows() == [1, 2]
    (tmp_path / "t.jsonl").rename(tmp_path / "t.jsonl.old")
    assert tables.exists(spark, path) and rows() == [1, 2]
    tables.write_jsonl(spark.range(1), path)
    assert rows() == [0] and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t.jsonl"]
    tables.write_document(spark, {"a": 1}, f"{path}.doc")
    tables.write_document(spark, {"a": 2}, f"{path}.doc")
    assert tables.read_document(spark, f"{path}.doc") == {"a": 2}


def test_imports(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,text\n,"  one, with ""quotes"" "\nb,two\n')
    got = {r.pos: (r.id, r.text, r.source) for r in tables.import_records(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {0: ("imp00000", 'one, with "quotes"', "imported"), 1: ("b", "two", "imported")}
    (tmp_path / "t.jsonl").write_text(json.dumps({"text": " "}) + "\n")
    with pytest.raises(Exception, match="no text in row 1"):
        tables.import_records(spark, str(tmp_path / "t.jsonl")).collect()
    with pytest.raises(ValueError, match="cannot import"):
        tables.import_records(spark, "x.txt")


def test_append_rejects_known_ids(spark):
    a = spark.createDataFrame([(0, "a")], "pos long, id string")
    assert {(r.pos, r.id) for r in tables.append_records(a, spark.createDataFrame([(0, "b")], "pos long, id string")).collect()} == {(0, "a"), (1, "b")}
    with pytest.raises(ValueError, match="exists already"):
        tables.append_records(a, a)


def test_stream_of_texts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("1", "Where is my order? The package is late"), ("2", "zzz")], "id string, text string").write.parquet(str(tmp_path / "in/a"))
    got = {}

    def sink(batch, number):
        got.update({r.id: r.source for r in batch.select("id", "source").collect()})

    stream = spark.readStream.schema("id string, text string").parquet(str(tmp_path / "in/*"))
    q = routing.start_router(stream, 0.5, None, sink, str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    assert got == {"1": "student", "2": "none"}


def failing(tickets, model, repairing):
    """A teacher that is away."""
    made = tickets.groupBy("batch").agg(F.lit(None).cast("string").alias("text"))
    return made.withColumn("failure", F.lit("busy"))


TEXTS = [("1", "Where is my order? The package is late"), ("2", "zzz"), ("3", "my bulb, my bulb, what a bulb")]


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/answers"
    sink, texts = routing.batch_sink(folder), spark.createDataFrame(TEXTS, "id string, text string")
    for number, rows in ((0, texts), (1, texts.filter("id = 2")), (0, texts)):
        sink(routing.answer_batch(rows, 0.5, None), number)
    got = routing.written_answers(spark, folder).collect()
    assert sorted((r.batch, r.id) for r in got) == [(0, "1"), (0, "2"), (0, "3"), (1, "2")]
    assert {r.id: r.triage.intent for r in got if r.triage}["1"] == "order_status"


def test_a_teacher_that_fails_is_told(spark):
    texts = spark.createDataFrame(TEXTS, "id string, text string")
    got = {r.id: r for r in routing.answer_batch(texts, 0.5, "offline-a", failing).collect()}
    assert got["1"].source == "student" and "teacher" not in got["1"].reason
    assert got["2"].source == "none" and got["2"].triage is None and "; teacher error: " in got["2"].reason


def test_comparison_asks_for_what_has_no_answer(spark):
    from siftstone.schemas import TRIAGE

    own = ("other", "high", "neutral", "none", None, "A text of three letters.")
    rows = [(i, t, own if i == "2" else None) for i, t in TEXTS] + [("4", "", None)]
    texts = spark.createDataFrame(rows, f"id string, text string, teacher {TRIAGE}")
    seen = []

    def ask(tickets, model, repairing):
        seen.extend(r.id for r in tickets.select("id").collect())
        return teacher.offline_answers(tickets, model, repairing)

    got = {r.id: r for r in routing.compare_batch(texts, 0.5, "offline-b", ask).collect()}
    assert sorted(set(seen)) == ["1", "3"] and sorted(got) == ["1", "2", "3"]  # a student's sure answer is asked for too
    assert got["2"].differs == ["urgency", "summary"] and got["2"].teacher_model is None
    assert got["1"].teacher_model == "offline-b" and got["1"].route == "student" and got["1"].teacher is not None
    away = {r.id: r for r in routing.compare_batch(texts.drop("teacher"), 0.5, "offline-b", failing).collect()}
    assert all(r.teacher is None and r.teacher_error and r.student is not None and r.differs == [] for r in away.values())
    alone = routing.compare_batch(texts.drop("teacher"), 0.5, None).collect()
    assert {r.teacher_error for r in alone} == {"no teacher"}


def scripted():
    """Makes clients that are busy at first and then answer; texts with "bad" fail for good."""

    def make():
        tried = []

        def failure(status, text):
            error = Exception(text)
            error.status, error.retry_after = status, 0.0
            return error

        def ask(system, user):
            tried.append(user)
            if "bad" in user:
                raise failure(404, "no such model")
            if user.startswith("busy") and tried.count(user) < 3:
                raise failure(503, "try again")
            return user.upper(), "m:free", 3, 2

        return ask

    return make


REQUEST = "key string, stage string, task string, provider string, system string, user string, items int"


def requests(spark, *users):
    return spark.createDataFrame([(u, "label", "label", "p:free", "s", u, 1) for u in users], REQUEST)


def made(spark, folder, users, budget, tasks=2, **pace):
    """Ends of requests by key, and the calls in the journal."""
    journal = calls.Journal(f"{folder}/{budget}-{tasks}")
    pace = {"spacing": 0.0, "retries": 3, "base": 0.0} | pace
    ends = calls.ask_remote(requests(spark, *users), scripted(), journal, "now", budget=budget, tasks=tasks, **pace).collect()
    return {r.key: (r.status, r.error) for r in ends}, [c for p in range(tasks) for c in journal.records(p)]


def test_remote_calls_retry_and_keep_to_the_budget(spark, tmp_path):
    ends, journal = made(spark, tmp_path, ["a", "busy b", "bad c"], 20)
    assert ends == {"a": ("ok", None), "bad c": ("error", "no such model"), "busy b": ("ok", None)}
    assert sorted((c["key"], c.get("text"), c["status"]) for c in journal if c["status"] != "retryable_error") == [
        ("a", "A", "ok"), ("bad c", None, "error"), ("busy b", "BUSY B", "ok"),
    ]
    assert sum(c["status"] == "retryable_error" for c in journal) == 2
    for budget in (0, 1, 3, 7):
        ends, journal = made(spark, tmp_path, [f"u{i}" for i in range(12)], budget, 3)
        assert len(ends) == 12 and len(journal) == budget
        assert sorted(ends.values(), key=str) == [("ok", None)] * budget + [("unasked", "budget is used up")] * (12 - budget)


def test_shares_use_the_whole_budget():
    assert calls.shares_of(7, [1, 9, 2]) == (1, 4, 2)
    assert calls.shares_of(3, [5, 5, 5]) == (1, 1, 1)
    assert calls.shares_of(20, [1, 0, 2]) == (7, 6, 7)
    assert calls.shares_of(0, [3]) == (0,)


PACE = {"spacing": 0.0, "retries": 1, "base": 0.0}


def test_answers_are_cached_and_counted(spark, tmp_path):
    once = lambda budget, *users: {
        r.key: r.text for r in calls.asked_once(spark, requests(spark, *users), scripted(), str(tmp_path), "now", budget, **PACE).collect()
    }
    assert once(10, "a", "b", "a", "bad") == {"a": "A", "b": "B"}
    assert calls.calls_left(spark, f"{tmp_path}/ledger", 10) == 7
    got = once(4, "b", "c", "d")  # one call is left, for one of the two that are new
    assert got["b"] == "B" and len(got) == 2
    ledger = spark.read.schema(calls.LEDGER).json(f"{tmp_path}/ledger")
    assert {(r.kind, r.name): r["count"] for r in calls.ledger_counts(ledger).collect()}[("model", "m:free")] == 3
    assert calls.ledger_view(ledger).first().all_free


def test_only_real_calls_count_against_a_budget_that_is_raised(spark, tmp_path):
    users = [f"u{i}" for i in range(10)]
    run = lambda budget: calls.asked(spark, requests(spark, *users), scripted(), f"{tmp_path}/cache", f"{tmp_path}/ledger", "now", budget, **PACE).collect()
    for budget, answers in ((3, 3), (8, 8), (8, 8), (20, 10)):
        rows = run(budget)
        assert sum(r.text is not None for r in rows) == answers
        assert all((r.text is None) == (r.failure == "budget is used up") for r in rows)
        assert spark.read.schema(calls.LEDGER).json(f"{tmp_path}/ledger").filter("status = 'ok'").count() == answers
        assert calls.calls_left(spark, f"{tmp_path}/ledger", budget) == budget - answers


def noted(folder, dies_after=None):
    """Makes clients that note each call with its time; one call may take its worker down."""

    def make():
        def ask(system, user):
            import os
            import time
            import uuid

            seen = os.listdir(folder)
            if dies_after is not None and len(seen) >= dies_after and "died" not in seen:
                open(f"{folder}/died", "w").close()
                os._exit(1)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write(f"{user} {time.time()}")
            return user.upper(), "m:free", 1, 1

        return ask

    return make


def notes(folder):
    return [(u, float(t)) for u, t in (p.read_text().split() for p in folder.iterdir() if p.name != "died")]


def test_a_lost_task_asks_nothing_twice(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    users = [f"u{i}" for i in range(12)]
    run = lambda: calls.asked_once(spark, requests(spark, *users), noted(log, 5), f"{tmp_path}/run", "now", 12, tasks=1, **PACE).collect()
    with pytest.raises(Exception, match="(?i)worker|crash"):  # one try a task on this master
        run()
    assert len(notes(log)) == 5
    assert {r.key: r.text for r in run()} == {u: u.upper() for u in users}
    assert sorted(u for u, _ in notes(log)) == sorted(users)
    assert spark.read.schema(calls.LEDGER).json(f"{tmp_path}/run/ledger").count() == 12


def test_a_task_that_runs_again_goes_on(tmp_path):
    """A second attempt of a task replays its journal, its failures and its share of the budget."""
    from types import SimpleNamespace

    rows = [SimpleNamespace(key=u, stage="label", task="label", provider="p:free", system="s", user=u, items=1) for u in ("a", "bad", "b", "c", "d")]
    asker = calls.Asker(scripted(), 0.0, 1, 0.0, (4,), calls.Journal(str(tmp_path)), 0, "now")
    first = asker(0, iter(rows))
    assert [next(first)[:2] for _ in range(2)] == [("a", "ok"), ("bad", "error")]
    first.close()  # the executor is gone
    ends = list(asker(0, iter(rows)))
    assert [e[:2] for e in ends] == [("a", "ok"), ("bad", "error"), ("b", "ok"), ("c", "ok"), ("d", "unasked")]
    assert sorted(r["key"] for r in asker.journal.records(0)) == ["a", "b", "bad", "c"]


def test_starts_of_all_tasks_and_passes_keep_apart(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    for users in (range(8), range(4, 14)):
        asking = requests(spark, *[f"u{i}" for i in users])
        calls.asked_once(spark, asking, noted(log), f"{tmp_path}/run", "now", 99, tasks=4, **PACE | {"spacing": 0.3}).collect()
    starts = sorted(t for _, t in notes(log))
    assert len(starts) == 14
    assert min(b - a for a, b in zip(starts, starts[1:])) >= 0.3 - 0.002  # the note is made after the start


def test_slots_never_meet():
    taken = {}
    for part in range(3):
        now, slot = 100.0 + part / 7, 10
        for _ in range(40):
            slot, wait = calls.next_slot(now, 0.5, part, 3, slot)
            assert slot not in taken
            now += wait
            begin = slot * 0.5 * (1 + calls.GUARD)
            assert begin <= now + 1e-9 and now <= begin + 0.5 * calls.GUARD + 1e-9
            taken[slot] = now
            now += 0.13 * part
    starts = [taken[s] for s in sorted(taken)]
    assert all(b - a >= 0.5 - 1e-9 for a, b in zip(starts, starts[1:]))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from siftstone.sources.scratch import shared_dir

    unset = SimpleNamespace(get=lambda key, default: default)
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master=master)))
