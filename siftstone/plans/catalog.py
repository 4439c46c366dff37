"""Named queries over the reference operators, with their DuckDB SQL.

The driver's tables stand in for records: a document is a ticket, and arithmetic on
doc_id gives it two annotators, so that both engines see the same labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pii, text
from ..functions.contract import exact_match, let, normalize_order_id, triage_json, valid_order_id, valid_request, valid_summary
from ..functions.heuristics import with_keyword_triage
from ..operators import agreement, batching, cost, dataset, funnel, metrics, near_dup, router, student, teacher, training
from ..schemas import ENUMS, FIELDS, INTENTS, LABEL, PRODUCT_AREAS, STRUCTURED, TRIAGE, enum_dimension
from ..sources import calls
from ..sources.scratch import Scratch
from ..streaming import routing
from . import report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that must give the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- stand-ins -------------------------------------------------------------

_FACTORS = {"intent": 7, "urgency": 5, "sentiment": 4, "product_area": 3}


def _value(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _order(number: Column) -> Column:
    return F.when(number % 3 != 0, F.concat(F.lit("BL-"), F.lpad((number % 1000000).cast("string"), 6, "0")))


def _triage(number: Column, shift: dict[str, Column]) -> Column:
    fields = [_value(v, number * _FACTORS[f] + shift.get(f, F.lit(0))).alias(f) for f, v in ENUMS.items()]
    summary = F.concat(F.lit("Customer writes about number "), number.cast("string"), F.lit("."))
    return F.struct(*fields, _order(number).alias("order_id"), summary.alias("summary")).cast(TRIAGE)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tickets with two labels each.

    The second annotator differs in intent where 11 divides doc_id and in urgency
    where 4 does; the first is invalid where 13 divides it, the second where 17 does.
    """
    d = F.col("doc_id")
    other = {"intent": (d % 11 == 0).cast("int"), "urgency": (d % 4 == 0).cast("int")}

    def label(model: str, triage: Column, valid: Column) -> Column:
        return F.struct(
            F.lit(model).alias("model"),
            F.when(valid, triage).alias("triage"),
            F.when(~valid, "invalid").alias("error"),
            (valid & (d % 5 == 0)).alias("repaired"),
        ).cast(LABEL)

    labels = F.array(label("a", _triage(d, {}), d % 13 != 0), label("b", _triage(d, other), d % 17 != 0))
    return table(spark, sf_dir, "documents").select(
        d.alias("pos"), d.cast("string").alias("id"), "text", "source", "lang", labels.alias("labels")
    )


def _sql_value(field: str, shift: str = "0") -> str:
    values = ", ".join(f"'{v}'" for v in ENUMS[field])
    return f"([{values}])[CAST((doc_id * {_FACTORS[field]} + {shift}) % {len(ENUMS[field])} AS INTEGER) + 1]"


_SQL_ORDER = "CASE WHEN doc_id % 3 <> 0 THEN 'BL-' || lpad(CAST(doc_id % 1000000 AS VARCHAR), 6, '0') END"
_SQL_SHIFT = {"intent": "CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END", "urgency": "CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END"}

#: The same stand-ins in SQL: a_ and b_ columns of both annotators.
_SQL_TICKETS = (
    "t AS (SELECT doc_id, text, source, lang, doc_id % 13 <> 0 AS a_ok, doc_id % 17 <> 0 AS b_ok, "
    + ", ".join(f"{_sql_value(f)} AS a_{f}, {_sql_value(f, _SQL_SHIFT.get(f, '0'))} AS b_{f}" for f in ENUMS)
    + f", {_SQL_ORDER} AS a_order_id, {_SQL_ORDER} AS b_order_id FROM documents)"
)


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets with the first annotator's triage, valid or not."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("id"), "text", "source", _triage(F.col("doc_id"), {}).alias("triage")
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a gold quality and a student's guess and confidence."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        d.alias("pos"),
        F.col("quality").cast("string").alias("gold"),
        F.when(d % 19 == 0, None).when(d % 7 == 0, (1 - F.col("quality")).cast("string")).otherwise(F.col("quality").cast("string")).alias("predicted"),
        ((d * 37 % 101) / 100.0).alias("confidence"),
        ((d % 7 != 0) & (d % 19 != 0)).alias("correct"),
    )


_SQL_JUDGED = (
    "j AS (SELECT doc_id AS pos, CAST(quality AS VARCHAR) AS gold, CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 7 = 0 "
    "THEN CAST(1 - quality AS VARCHAR) ELSE CAST(quality AS VARCHAR) END AS predicted, (doc_id * 37 % 101) / 100.0::DOUBLE AS confidence, "
    "doc_id % 7 <> 0 AND doc_id % 19 <> 0 AS correct FROM labels)"
)


def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold, teacher and student answers with confidences, from arithmetic on doc_id."""
    d = F.col("doc_id")
    gold = _triage(d, {})
    student_answer = _triage(d, {"intent": (d % 5 == 0).cast("int")})
    teacher_answer = _triage(d, {"urgency": (d % 9 == 0).cast("int")})
    return table(spark, sf_dir, "documents").select(
        d.alias("pos"),
        gold.alias("label"),
        F.when(d % 23 != 0, student_answer).alias("student"),
        F.when(d % 29 != 0, teacher_answer).alias("teacher"),
        (d % 31 != 0).alias("json_valid"),
        ((d * 37 % 101) / 100.0).alias("confidence"),
    )


_SQL_ROUTED = (
    "r AS (SELECT doc_id, (doc_id * 37 % 101) / 100.0::DOUBLE AS confidence, doc_id % 31 <> 0 AS json_valid, doc_id % 23 <> 0 AS has_student, "
    "doc_id % 29 <> 0 AS has_teacher, doc_id % 23 <> 0 AND doc_id % 5 <> 0 AS student_right, doc_id % 29 <> 0 AND doc_id % 9 <> 0 AS teacher_right, "
    "doc_id % 5 <> 0 AS student_intent, doc_id % 9 <> 0 AS teacher_urgency FROM documents)"
)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a ledger of calls."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stage"),
        F.when(e % 10 == 0, "retryable_error").when(e % 33 == 0, "error").otherwise("ok").alias("status"),
        F.when(e % 10 != 0, F.concat(F.lit("m"), (e % 3).cast("string"), F.lit(":free"))).alias("served_model"),
        F.lit("p:free").alias("provider"),
        (F.col("value") / 100).alias("latency_s"),
        (e % 500).cast("int").alias("input_tokens"),
        (e % 90).cast("int").alias("output_tokens"),
        (e % 4 + 1).cast("int").alias("items"),
        e.alias("pos"),
    )


_SQL_LEDGER = (
    "l AS (SELECT event_type AS stage, CASE WHEN event_id % 10 = 0 THEN 'retryable_error' WHEN event_id % 33 = 0 THEN 'error' ELSE 'ok' END AS status, "
    "CASE WHEN event_id % 10 <> 0 THEN 'm' || (event_id % 3) || ':free' END AS served_model, event_id % 500 AS input_tokens, event_id % 90 AS output_tokens, "
    "event_id % 4 + 1 AS items, value FROM events)"
)

# --- gates and funnel ------------------------------------------------------

_SQL_LENGTH = "CASE WHEN length(coalesce(text, '')) < 20 THEN 'too_short' WHEN length(text) > 1500 THEN 'too_long' END"


@query(f"SELECT doc_id, {_SQL_LENGTH} AS reason FROM documents")
def length_gate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", funnel.length_reason(F.col("text")).alias("reason"))


@query(f"SELECT {_SQL_LENGTH} AS reason, count(*) AS n FROM documents WHERE {_SQL_LENGTH} IS NOT NULL GROUP BY 1")
def length_gate_reasons(spark, sf_dir):
    return length_gate(spark, sf_dir).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH {_SQL_TICKETS} SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN NOT a_ok THEN 'teacher_1_invalid' WHEN NOT b_ok THEN 'teacher_2_invalid' END AS reason FROM t")
def schema_gate(spark, sf_dir):
    return tickets(spark, sf_dir).select("id", funnel.schema_reason(F.col("labels")).alias("reason"))


_SQL_DIFFER = "concat_ws(',', CASE WHEN a_intent <> b_intent THEN 'intent' END, CASE WHEN a_urgency <> b_urgency THEN 'urgency' END)"


@query(f"WITH {_SQL_TICKETS} SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN NOT (a_ok AND b_ok) THEN 'invalid' ELSE {_SQL_DIFFER} END AS differ FROM t")
def agreement_gate(spark, sf_dir):
    return tickets(spark, sf_dir).select("id", F.array_join(agreement.disagreements(F.col("labels")), ",").alias("differ"))


@query(
    f"WITH {_SQL_TICKETS}, d AS (SELECT unnest(string_split({_SQL_DIFFER}, ',')) AS reason FROM t WHERE a_ok AND b_ok) "
    "SELECT reason, count(*) AS n FROM d WHERE reason <> '' GROUP BY reason"
)
def agreement_reasons(spark, sf_dir):
    good = tickets(spark, sf_dir).filter(agreement.first_invalid(F.col("labels")) == 0)
    return good.select(F.explode(agreement.disagreements(F.col("labels"))).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_SQL_TICKETS}, h AS (SELECT *, row_number() OVER (PARTITION BY a_intent ORDER BY sha256('42:' || doc_id), doc_id) AS k FROM t)
        SELECT CAST(doc_id AS VARCHAR) AS id, a_intent AS intent, k <= 80 AS kept FROM h"""
)
def balance_cap(spark, sf_dir):
    rows = examples(spark, sf_dir).select("id", F.col("triage.intent").alias("intent"))
    return funnel.balance_cap(rows, "intent", 80)


@query()
def funnel_steps(spark, sf_dir):
    """The whole funnel as its table of steps; near duplicates make it a loop."""
    return _funnel_table(funnel.run_funnel(spark, tickets(spark, sf_dir)))


def _funnel_table(result: funnel.FunnelResult) -> DataFrame:
    made = result.funnel
    reasons = F.array_join(F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return made.select("ord", "name", "kept", "dropped", "modified", reasons.alias("reasons"))


QUERIES["funnel"] = QUERIES.pop("funnel_steps")


@query()
def funnel_dropped(spark, sf_dir):
    return funnel.run_funnel(spark, tickets(spark, sf_dir)).dropped.select("id", "stage", "reason")


@query()
def funnel_examples(spark, sf_dir):
    return funnel.run_funnel(spark, tickets(spark, sf_dir)).examples.select("id", "text", triage_json(F.col("triage")).alias("answer"))


# --- PII --------------------------------------------------------------------

# RE2 knows word boundaries in ASCII only; these tests run on texts where both agree.
_RE_EMAIL = pii.EMAIL.replace("'", "''")
_RE_CARD = pii.CARD


@query(f"SELECT doc_id, regexp_replace(text, '{_RE_EMAIL}', '[EMAIL]', 'g') AS clean FROM documents")
def pii_email(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", pii.scrub_email(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, regexp_replace(text, '{_RE_CARD}', '[CARD]', 'g') AS clean FROM documents")
def pii_card(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", pii.scrub_card(F.col("text")).alias("clean"))


@query(
    f"""SELECT doc_id, len(regexp_extract_all(text, '{_RE_EMAIL}')) AS email,
               len(regexp_extract_all(regexp_replace(text, '{_RE_EMAIL}', '[EMAIL]', 'g'), '{_RE_CARD}')) AS card FROM documents"""
)
def pii_counts(spark, sf_dir):
    found = table(spark, sf_dir, "documents").withColumn("c", pii.counts(F.col("text")))
    n = lambda kind: F.coalesce(F.try_element_at("c", F.lit(kind)), F.lit(0)).alias(kind)
    return found.select("doc_id", n("email"), n("card"))


# RE2 looks neither back nor ahead: a mark follows each character that a number may follow. A match
# takes the mark before it and the character after it, so that the next match still has its own mark.
_RE_WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}"
_RE_GAP = r"(?:[\t-\r\x{85}\p{Z}.]\x01|-)?"
_RE_PHONE = (
    rf"\x01((?:\+\x01\p{{Nd}}{{1,3}}{_RE_GAP})?(?:\(\x01\p{{Nd}}{{2,4}}\)\x01{_RE_GAP})?"
    rf"\p{{Nd}}{{2,4}}(?:{_RE_GAP}\p{{Nd}}{{2,4}}){{2,4}})($|[^{_RE_WORD}-])"
)


def _sql_phone(source: str) -> str:
    """(doc_id, clean, phone) of rows (doc_id, text) without the character 1."""
    return rf"""WITH marked AS (SELECT doc_id, chr(1) || regexp_replace(text, '([^{_RE_WORD}-])', '\1' || chr(1), 'g') AS t FROM ({source})),
        cut AS (SELECT doc_id, string_split_regex(t, '{_RE_PHONE}') AS b, regexp_extract_all(t, '{_RE_PHONE}') AS m,
                       regexp_extract_all(t, '{_RE_PHONE}', 1) AS number, regexp_extract_all(t, '{_RE_PHONE}', 2) AS behind FROM marked),
        judged AS (SELECT *, [length(regexp_replace(x, '\P{{Nd}}', '', 'g')) >= {pii.PHONE_DIGITS} FOR x IN number] AS ok FROM cut)
        SELECT doc_id, replace(array_to_string([b[i] || CASE WHEN i > len(m) THEN '' WHEN ok[i] THEN '[PHONE]' || behind[i] ELSE m[i] END
                   FOR i IN range(1, len(b) + 1)], ''), chr(1), '') AS clean, len(list_filter(ok, lambda x: x)) AS phone FROM judged"""


def _sql_scrub(source: str) -> str:
    """(doc_id, clean, email, card, phone) of rows (doc_id, text): all kinds in order."""
    return f"""WITH mail AS (SELECT doc_id, len(regexp_extract_all(text, '{_RE_EMAIL}')) AS email, regexp_replace(text, '{_RE_EMAIL}', '[EMAIL]', 'g') AS text FROM ({source})),
        cards AS (SELECT doc_id, email, len(regexp_extract_all(text, '{_RE_CARD}')) AS card, regexp_replace(text, '{_RE_CARD}', '[CARD]', 'g') AS text FROM mail)
        SELECT doc_id, clean, email, card, phone FROM ({_sql_phone('SELECT doc_id, text FROM cards')}) JOIN cards USING (doc_id)"""


@query(f"SELECT doc_id, clean FROM ({_sql_phone('SELECT doc_id, text FROM documents')})")
def pii_phone(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", pii.scrub_phone(F.col("text")).alias("clean"))


@query(
    f"""SELECT doc_id, clean, concat_ws(',', CASE WHEN email > 0 THEN 'email=' || email END, CASE WHEN card > 0 THEN 'card=' || card END,
               CASE WHEN phone > 0 THEN 'phone=' || phone END) AS found FROM ({_sql_scrub('SELECT doc_id, text FROM documents')})"""
)
def pii_scrub(spark, sf_dir):
    """All kinds in order, with what was replaced."""
    made = pii.with_scrubbed(table(spark, sf_dir, "documents"), "text", "clean", "counts")
    found = F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return made.select("doc_id", "clean", found.alias("found"))


# --- near duplicates ---------------------------------------------------------

_SQL_NORMAL = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '\d', '0', 'g'), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT doc_id, {_SQL_NORMAL} AS norm FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.near_normal(F.col("text")).alias("norm"))


@query(
    f"""WITH n AS (SELECT doc_id, {_SQL_NORMAL} AS s FROM documents)
        SELECT doc_id, count(DISTINCT s[i : i + 4]) AS n FROM n, unnest(range(1, greatest(length(s) - 4, 1) + 1)) AS u(i) GROUP BY doc_id"""
)
def shingle_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.size(text.char_shingles(text.near_normal(F.col("text")), 5)).cast("long").alias("n"))


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "text")


@query(
    f"""WITH n AS (SELECT doc_id, {_SQL_NORMAL} AS s FROM documents WHERE {_SQL_LENGTH} IS NULL),
        m AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY s) AS rep FROM n),
        g AS (SELECT DISTINCT doc_id, s[i : i + 4] AS w FROM m, unnest(range(1, greatest(length(s) - 4, 1) + 1)) AS u(i) WHERE doc_id = rep),
        k AS (SELECT doc_id, count(*) AS k FROM g GROUP BY doc_id),
        c AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM g AS a JOIN g AS b ON a.w = b.w AND a.doc_id < b.doc_id GROUP BY ALL)
        SELECT i, j, c / CAST(x.k + y.k - c AS DOUBLE) AS similarity FROM c JOIN k AS x ON i = x.doc_id JOIN k AS y ON j = y.doc_id
        WHERE c / CAST(x.k + y.k - c AS DOUBLE) >= 0.7
        UNION ALL SELECT rep, doc_id, 1.0::DOUBLE FROM m WHERE doc_id <> rep"""
)
def neardup_pairs(spark, sf_dir):
    """Pairs behind the length gate, as its SQL has them; ``neardup_all_pairs`` has those of all texts.

    Texts that are equal once normalised are a class: pairs are between the first of each, and
    each further text of a class is paired with the first.
    """
    gated = _texts(spark, sf_dir).filter(funnel.length_reason(F.col("text")).isNull())
    return _class_pairs(spark, gated)


def _class_pairs(spark, texts):
    scratch = Scratch(spark, "neardup-pairs", "zstd")
    norms = scratch.save(near_dup.normalised(near_dup.spread(texts)), "norms")
    members = scratch.save(near_dup.with_classes(norms), "members")
    reps = scratch.save(near_dup.representatives(norms, members), "reps")
    scratch.drop("norms")
    return near_dup.with_copies(near_dup.exact_pairs(reps), members)


@query()
def neardup_all_pairs(spark, sf_dir):
    return _class_pairs(spark, _texts(spark, sf_dir))


def _sql_greedy(source: str) -> str:
    """Common tables for ``WITH RECURSIVE``, of which ``twins`` has (pos, of, similarity), one text after the other."""
    return f"""normal AS (SELECT doc_id, {_SQL_NORMAL} AS s FROM {source}),
        grams AS (SELECT DISTINCT doc_id, s[i : i + 4] AS w FROM normal, unnest(range(1, greatest(length(s) - 4, 1) + 1)) AS u(i)),
        sized AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS k FROM grams),
        met AS (SELECT a.doc_id AS i, b.doc_id AS j, a.k + b.k AS k, count(*) AS c FROM sized AS a JOIN sized AS b ON a.w = b.w AND a.doc_id < b.doc_id
                AND least(a.k, b.k) >= 0.69 * greatest(a.k, b.k) GROUP BY ALL),
        near AS (SELECT i, j, c / CAST(k - c AS DOUBLE) AS similarity FROM met WHERE c / CAST(k - c AS DOUBLE) >= 0.7),
        later AS (SELECT j, list(i) AS earlier, row_number() OVER (ORDER BY j) AS nth FROM near GROUP BY j),
        falls AS (SELECT 0::BIGINT AS nth, []::BIGINT[] AS gone UNION ALL
                  SELECT later.nth, CASE WHEN len(list_filter(earlier, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, j) ELSE gone END
                  FROM falls JOIN later ON later.nth = falls.nth + 1),
        gone AS (SELECT unnest(gone) AS pos FROM falls WHERE nth = (SELECT max(nth) FROM falls)),
        twins AS (SELECT j AS pos, (list(i ORDER BY similarity DESC, i))[1] AS "of", max(similarity) AS similarity FROM near
                  WHERE j IN (SELECT pos FROM gone) AND i NOT IN (SELECT pos FROM gone) GROUP BY j)"""


@query(f"WITH RECURSIVE {_sql_greedy('documents')} SELECT * FROM twins")
def neardup_greedy(spark, sf_dir):
    return near_dup.near_duplicates(spark, _texts(spark, sf_dir))


@query()
def neardup_lsh(spark, sf_dir):
    return near_dup.near_duplicates(spark, _texts(spark, sf_dir), mode="lsh")


# --- the funnel without chance ------------------------------------------------

#: ``lost`` has (doc_id, stage, keys, reason) of each dropped row, ``found`` what was scrubbed.
_SQL_FUNNEL = f"""{_SQL_TICKETS},
    gated AS (SELECT doc_id, text, a_intent, {_SQL_LENGTH} AS short, CASE WHEN NOT a_ok THEN 'teacher_1_invalid' WHEN NOT b_ok THEN 'teacher_2_invalid' END AS broken,
                     {_SQL_DIFFER} AS differ FROM t),
    alive AS (SELECT doc_id, text, a_intent FROM gated WHERE short IS NULL AND broken IS NULL AND differ = ''),
    {_sql_greedy('alive')},
    single AS (SELECT * FROM alive WHERE doc_id NOT IN (SELECT pos FROM twins)),
    found AS ({_sql_scrub('SELECT doc_id, text FROM single')}),
    ranked AS (SELECT doc_id, a_intent, row_number() OVER (PARTITION BY a_intent ORDER BY sha256('42:' || doc_id), CAST(doc_id AS VARCHAR)) AS k FROM single),
    lost AS (SELECT doc_id, 'length' AS stage, [short] AS keys, short || ' (' || length(text) || ' chars)' AS reason FROM gated WHERE short IS NOT NULL
        UNION ALL SELECT doc_id, 'schema_valid', [broken], broken || ': invalid' FROM gated WHERE short IS NULL AND broken IS NOT NULL
        UNION ALL SELECT doc_id, 'teacher_agreement', string_split(differ, ','), 'teachers disagree: ' || replace(differ, ',', ', ') FROM gated
                  WHERE short IS NULL AND broken IS NULL AND differ <> ''
        UNION ALL SELECT pos, 'dedup', ['near_duplicate'], 'near_duplicate of ' || "of" || ' (jaccard ' || round_even(similarity, 4) || ')' FROM twins
        UNION ALL SELECT doc_id, 'balance', ['cap_' || a_intent], 'cap_' || a_intent FROM ranked WHERE k > {funnel.CAP})"""


def _exact_funnel(spark, sf_dir):
    return funnel.run_funnel(spark, tickets(spark, sf_dir), funnel.FunnelConfig(dedup_mode="exact"))


@query(
    f"""WITH RECURSIVE {_SQL_FUNNEL},
        counted AS (SELECT stage AS name, key, count(*) AS n FROM (SELECT stage, unnest(keys) AS key FROM lost) GROUP BY ALL
            UNION ALL SELECT 'pii_scrub', kind, n::BIGINT FROM (SELECT sum(email) AS email, sum(card) AS card, sum(phone) AS phone FROM found) UNPIVOT (n FOR kind IN (email, card, phone))
            WHERE n > 0),
        told AS (SELECT name, string_agg(key || '=' || n, ';' ORDER BY key) AS reasons FROM counted GROUP BY name),
        gone_by AS (SELECT stage AS name, count(*) AS dropped FROM lost GROUP BY 1),
        steps AS (SELECT * FROM (VALUES (0, 'input'), (1, 'length'), (2, 'schema_valid'), (3, 'teacher_agreement'), (4, 'dedup'), (5, 'pii_scrub'), (6, 'balance')) AS v(ord, name))
        SELECT ord, name, CAST((SELECT count(*) FROM documents) - sum(coalesce(dropped, 0)) OVER (ORDER BY ord) AS BIGINT) AS kept, coalesce(dropped, 0) AS dropped,
               CASE WHEN name = 'pii_scrub' THEN (SELECT count(*) FROM found WHERE email + card + phone > 0) ELSE 0 END AS modified, coalesce(reasons, '') AS reasons
        FROM steps LEFT JOIN gone_by USING (name) LEFT JOIN told USING (name)"""
)
def funnel_exact(spark, sf_dir):
    """The funnel whose near-duplicate gate misses nothing, as its table of steps."""
    return _funnel_table(_exact_funnel(spark, sf_dir))


@query(f"WITH RECURSIVE {_SQL_FUNNEL} SELECT CAST(doc_id AS VARCHAR) AS id, stage, reason FROM lost")
def funnel_exact_dropped(spark, sf_dir):
    return _exact_funnel(spark, sf_dir).dropped.select("id", "stage", "reason")


# --- agreement ---------------------------------------------------------------


@query(
    f"""WITH {_SQL_TICKETS}, x AS (SELECT 1 AS teacher, a_ok AS ok, doc_id FROM t UNION ALL SELECT 2, b_ok, doc_id FROM t)
        SELECT teacher, count(*) AS tickets, count(*) FILTER (ok) AS valid, count(*) FILTER (ok AND doc_id % 5 = 0) AS repaired, count(*) FILTER (NOT ok) AS invalid
        FROM x GROUP BY teacher"""
)
def teacher_validity(spark, sf_dir):
    return agreement.teacher_validity(tickets(spark, sf_dir)).drop("models")


@query(
    f"WITH {_SQL_TICKETS}, v AS (SELECT * FROM t WHERE a_ok AND b_ok) "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS n, avg(CAST(a_{f} IS NOT DISTINCT FROM b_{f} AS INTEGER)) AS agreement FROM v" for f in STRUCTURED
    )
)
def field_agreement(spark, sf_dir):
    return agreement.agreement_table(tickets(spark, sf_dir)).select("field", "n", "agreement")


@query(
    f"WITH {_SQL_TICKETS}, v AS (SELECT * FROM t WHERE a_ok AND b_ok), n AS (SELECT count(*) AS n FROM v) "
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS field, ((SELECT count(*) FROM v WHERE a_{f} IS NOT DISTINCT FROM b_{f}) / n::DOUBLE - e) / (1 - e) AS kappa
            FROM n, (SELECT sum(x.c * y.c) / (SELECT n::DOUBLE * n FROM n) AS e
                     FROM (SELECT coalesce(a_{f}, 'None') AS k, count(*) AS c FROM v GROUP BY 1) AS x
                     JOIN (SELECT coalesce(b_{f}, 'None') AS k, count(*) AS c FROM v GROUP BY 1) AS y USING (k))"""
        for f in STRUCTURED
    )
)
def cohen_kappa(spark, sf_dir):
    return agreement.agreement_table(tickets(spark, sf_dir)).select("field", "kappa")


@query(
    f"""WITH {_SQL_TICKETS} SELECT count(*) AS both_valid, avg(CAST(a_intent = b_intent AND a_urgency = b_urgency AS INTEGER)) AS all_fields
        FROM t WHERE a_ok AND b_ok"""
)
def all_fields_agreement(spark, sf_dir):
    return agreement.all_fields_agreement(tickets(spark, sf_dir))


# --- dataset -----------------------------------------------------------------

_SQL_SPLIT = f"""{_SQL_TICKETS}, k AS (SELECT doc_id, a_intent, count(*) OVER (PARTITION BY a_intent) AS n,
    row_number() OVER (PARTITION BY a_intent ORDER BY sha256('42:' || doc_id), CAST(doc_id AS VARCHAR)) AS k FROM t),
    s AS (SELECT doc_id, a_intent, CASE WHEN k <= CASE WHEN n >= 2 THEN greatest(CAST(round_even(n * 0.12, 0) AS BIGINT), 1)
    ELSE CAST(round_even(n * 0.12, 0) AS BIGINT) END THEN 'val' ELSE 'train' END AS split FROM k)"""


@query(f"WITH {_SQL_SPLIT} SELECT CAST(doc_id AS VARCHAR) AS id, split FROM s")
def stratified_split(spark, sf_dir):
    return dataset.stratified_split(examples(spark, sf_dir), F.col("triage.intent"), 0.12).select("id", "split")


@query(f"WITH {_SQL_SPLIT} SELECT a_intent AS intent, split, count(*) AS n FROM s GROUP BY ALL")
def stratified_split_sizes(spark, sf_dir):
    split = dataset.stratified_split(examples(spark, sf_dir), F.col("triage.intent"), 0.12)
    return split.groupBy(F.col("triage.intent").alias("intent"), "split").agg(F.count("*").alias("n"))


_SQL_DIST = (
    f"WITH {_SQL_TICKETS} "
    + " UNION ALL ".join(f"SELECT '{f}' AS field, a_{f} AS label, count(*) AS count FROM t GROUP BY a_{f}" for f in ENUMS)
    + " UNION ALL SELECT 'order_id', 'present', count(*) FILTER (a_order_id IS NOT NULL) FROM t"
    + " UNION ALL SELECT 'order_id', 'null', count(*) FILTER (a_order_id IS NULL) FROM t"
)


@query(_SQL_DIST)
def label_distribution(spark, sf_dir):
    return dataset.label_distribution(examples(spark, sf_dir)).drop("first")


@query(
    f"""SELECT field, label, count, count / CAST(sum(count) OVER (PARTITION BY field) AS DOUBLE) AS share,
        100.0::DOUBLE * count / max(count) OVER (PARTITION BY field) AS width FROM ({_SQL_DIST})"""
)
def share_of_total(spark, sf_dir):
    return dataset.share_of_field(dataset.label_distribution(examples(spark, sf_dir)).drop("first"))


@query(
    """SELECT count(*) AS total, min(length(text)) AS min_chars, CAST(round_even(quantile_cont(length(text), 0.5), 0) AS BIGINT) AS p50_chars,
       CAST(round_even(quantile_cont(length(text), 0.95), 0) AS BIGINT) AS p95_chars, max(length(text)) AS max_chars,
       CAST(round_even(quantile_cont(len(regexp_extract_all(text, '\\S+')), 0.5), 0) AS BIGINT) AS p50_words FROM documents"""
)
def dataset_stats(spark, sf_dir):
    return dataset.text_stats(table(spark, sf_dir, "documents"))


@query(
    """SELECT key, value, count(*) AS count FROM (SELECT 'lang' AS key, lang AS value FROM documents UNION ALL
       SELECT 'even', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END FROM documents) WHERE value IS NOT NULL GROUP BY ALL"""
)
def seed_summary(spark, sf_dir):
    even = (F.col("doc_id") % 2 == 0).cast("string")
    seeds = F.create_map(F.lit("id"), F.col("doc_id").cast("string"), F.lit("lang"), F.col("lang"), F.lit("even"), even)
    return dataset.seed_summary(table(spark, sf_dir, "documents").select(seeds.alias("seed")))


@query(
    """SELECT conv_id, unnest(range(1, n + 1)) AS at, unnest(roles) AS role, unnest(texts) AS content FROM (
       SELECT conv_id, count(*) AS n, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)"""
)
def chat_records(spark, sf_dir):
    made = dataset.conversation_records(table(spark, sf_dir, "conversations"))
    each = made.select("conv_id", F.posexplode("messages").alias("i", "m"))
    return each.select("conv_id", (F.col("i") + 1).cast("long").alias("at"), "m.role", "m.content")


@query(
    f"WITH {_SQL_TICKETS} SELECT CAST(doc_id AS VARCHAR) AS id, text, a_intent AS intent, a_order_id AS order_id, 'synthetic' AS source FROM t"
)
def chat_round_trip(spark, sf_dir):
    """Examples as chat records and back."""
    back = dataset.from_chat_records(dataset.chat_records(examples(spark, sf_dir)))
    return back.select("id", "text", F.col("triage.intent").alias("intent"), F.col("triage.order_id").alias("order_id"), "source")


# --- metrics -----------------------------------------------------------------


@query(f"WITH {_SQL_JUDGED} SELECT avg(CAST(gold IS NOT DISTINCT FROM predicted AS INTEGER)) AS accuracy FROM j")
def accuracy(spark, sf_dir):
    return judged(spark, sf_dir).agg(metrics.accuracy(F.col("gold"), F.col("predicted")).alias("accuracy"))


_SQL_F1 = f"""WITH {_SQL_JUDGED}, k AS (SELECT gold, coalesce(predicted, 'None') AS predicted FROM j)
    SELECT label, 2.0::DOUBLE * (SELECT count(*) FROM k WHERE gold = label AND predicted = label)
    / ((SELECT count(*) FROM k WHERE gold = label) + (SELECT count(*) FROM k WHERE predicted = label)) AS f1
    FROM (SELECT DISTINCT gold AS label FROM k)"""


@query(_SQL_F1)
def per_class_f1(spark, sf_dir):
    return metrics.per_class_f1(judged(spark, sf_dir), "gold", "predicted")


@query(f"SELECT avg(f1) AS macro_f1 FROM ({_SQL_F1})")
def macro_f1(spark, sf_dir):
    return metrics.macro_f1(judged(spark, sf_dir), "gold", "predicted")


@query(
    f"""WITH {_SQL_TICKETS}, v AS (SELECT a_intent AS g, CASE WHEN b_ok THEN b_intent ELSE '__invalid__' END AS p FROM t),
        d AS (SELECT unnest([{", ".join(f"'{v}'" for v in INTENTS)}]) AS label)
        SELECT avg(coalesce(2.0::DOUBLE * tp / nullif(ng + np, 0), 0)) AS macro_f1 FROM (SELECT label,
        (SELECT count(*) FROM v WHERE g = label AND p = label) AS tp, (SELECT count(*) FROM v WHERE g = label) AS ng,
        (SELECT count(*) FROM v WHERE p = label) AS np FROM d)"""
)
def macro_f1_enum(spark, sf_dir):
    """Macro F1 over the fixed enum, invalid answers never a hit."""
    rows = tickets(spark, sf_dir)
    truth = _triage(F.col("pos"), {})["intent"]
    answer = F.coalesce(F.col("labels")[1]["triage"]["intent"], F.lit("__invalid__"))
    labels = enum_dimension(spark).filter("field = 'intent'").select(F.col("value").alias("label"))
    return metrics.macro_f1(rows.select(truth.alias("g"), answer.alias("p")), "g", "p", labels)


@query(
    f"""WITH {_SQL_TICKETS}, v AS (SELECT doc_id, a_intent AS gold, CASE WHEN b_ok THEN b_intent ELSE '__invalid__' END AS predicted FROM t)
        SELECT gold, predicted, count(*) AS count FROM v WHERE gold <> predicted GROUP BY ALL ORDER BY count DESC, min(doc_id) LIMIT 8"""
)
def confusions_topk(spark, sf_dir):
    rows = tickets(spark, sf_dir).select("pos", _triage(F.col("pos"), {})["intent"].alias("g"), F.col("labels")[1]["triage"]["intent"].alias("p"))
    return metrics.confusions(rows, "g", "p")


@query("SELECT quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events")
def latency_percentiles(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    p50, p95 = metrics.percentiles(events, F.col("value"), [50, 95])
    return events.agg(F.lit(p50).alias("p50"), F.lit(p95).alias("p95"))


@query(
    f"""WITH {_SQL_TICKETS} SELECT avg(CAST(doc_id % 31 <> 0 AS INTEGER)) AS json_valid, avg(CAST(b_ok AS INTEGER)) AS schema_valid,
        avg(CAST(b_ok AND a_intent = b_intent AND a_urgency = b_urgency AS INTEGER)) AS exact FROM t"""
)
def validity_rates(spark, sf_dir):
    answer, truth = F.col("labels")[1]["triage"], _triage(F.col("pos"), {})
    return tickets(spark, sf_dir).agg(
        metrics.share(F.col("pos") % 31 != 0).alias("json_valid"),
        metrics.share(answer.isNotNull()).alias("schema_valid"),
        metrics.share(exact_match(answer, truth)).alias("exact"),
    )


@query("SELECT source, count(*) AS count FROM documents GROUP BY source")
def counted_by_source(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("pos", F.col("doc_id"))
    return metrics.counted_by(rows, "source").drop("first")


@query(f"WITH {_SQL_LEDGER} SELECT served_model FROM l WHERE status = 'ok' GROUP BY 1 ORDER BY count(*) DESC, min(items), served_model LIMIT 1")
def served_model_mode(spark, sf_dir):
    ok = ledger(spark, sf_dir).filter("status = 'ok'")
    return metrics.counted_by(ok, "served_model").limit(1).select("served_model")


@query(
    r"""WITH RECURSIVE w AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM benchmark),
        p AS (SELECT x.item_id, x.t AS a, y.t AS b FROM w x JOIN w y ON y.item_id = x.item_id + 1),
        s AS (SELECT item_id, a, b, 0::BIGINT AS k, list_transform(range(len(b) + 1), lambda i: 0::BIGINT) AS row FROM p
              UNION ALL SELECT item_id, a, b, k + 1, [0::BIGINT] || list_transform(range(1, len(b) + 1), lambda i: list_max(list_transform(
                  range(1, i + 1), lambda j: CASE WHEN b[j] = a[k + 1] THEN row[j] + 1 ELSE row[j + 1] END))) FROM s WHERE k < len(a))
        SELECT item_id, CASE WHEN row[-1] = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * row[-1] / (len(a) + len(b)) END AS rouge_l FROM s WHERE k = len(a)"""
)
def rouge_l_self(spark, sf_dir):
    """ROUGE-L of each benchmark text against the one after it."""
    rows = table(spark, sf_dir, "benchmark")
    after = rows.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return rows.join(after, "item_id").select("item_id", text.rouge_l(F.col("text"), F.col("other")).alias("rouge_l"))


# --- router ------------------------------------------------------------------


@query(
    f"""WITH {_SQL_ROUTED} SELECT doc_id AS pos, CASE WHEN json_valid AND has_student AND confidence >= 0.5 THEN 'student' ELSE 'teacher' END AS route FROM r"""
)
def route_decisions(spark, sf_dir):
    rows = routed_rows(spark, sf_dir)
    return rows.select("pos", router.decide(F.col("json_valid"), F.col("student"), F.col("confidence"), 0.5)["route"].alias("route"))


def _sql_simulation(threshold: str, source: str) -> str:
    s = f"(json_valid AND has_student AND confidence >= {threshold})"
    return f"""SELECT {threshold} AS threshold, count(*) AS items, avg(CAST({s} AS INTEGER)) AS offload_rate,
        avg(CAST(CASE WHEN {s} THEN student_right ELSE teacher_right END AS INTEGER)) AS exact_match,
        avg(CASE WHEN {s} THEN CAST(student_right AS INTEGER) END) AS exact_match_offloaded,
        avg(CAST(CASE WHEN {s} THEN student_intent ELSE has_teacher END AS INTEGER)) AS acc_intent,
        avg(CAST(CASE WHEN {s} THEN TRUE ELSE has_teacher AND teacher_urgency END AS INTEGER)) AS acc_urgency FROM {source}"""


@query(f"WITH {_SQL_ROUTED} {_sql_simulation('0.5::DOUBLE', 'r')}")
def router_simulation(spark, sf_dir):
    made = router.simulate(routed_rows(spark, sf_dir), 0.5)
    return made.select("threshold", "items", "offload_rate", "exact_match", "exact_match_offloaded", "acc_intent", "acc_urgency")


@query(f"WITH {_SQL_ROUTED}, c AS (SELECT unnest(range(21)) / 20.0::DOUBLE AS threshold) {_sql_simulation('threshold', 'r, c')} GROUP BY threshold")
def tradeoff_curve(spark, sf_dir):
    made = router.tradeoff_curve(routed_rows(spark, sf_dir))
    return made.select("threshold", "items", "offload_rate", "exact_match", "exact_match_offloaded", "acc_intent", "acc_urgency")


@query(
    f"""WITH {_SQL_ROUTED} SELECT count(*) AS items, avg(CAST(json_valid AND has_student AND confidence >= 0.5 AS INTEGER)) AS offload_rate,
        avg(CAST(json_valid AND has_student AND confidence >= 0.5 AND student_right AS INTEGER)) AS exact_match FROM r"""
)
def router_without_teacher(spark, sf_dir):
    made = router.simulate(router.without_teacher(routed_rows(spark, sf_dir)), 0.5)
    return made.select("items", "offload_rate", "exact_match")


@query(
    f"""WITH {_SQL_JUDGED}, s AS (SELECT confidence, avg(CAST(correct AS INTEGER)) OVER w AS m, count(*) OVER w AS n FROM j
        WINDOW w AS (ORDER BY confidence, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT coalesce(min(confidence) FILTER (confidence > 0 AND n >= 5 AND m >= 0.85), 1.01::DOUBLE) AS threshold FROM s"""
)
def calibrate_threshold(spark, sf_dir):
    return router.calibrate(judged(spark, sf_dir), 0.85)


@query(
    f"""WITH {_SQL_ROUTED} SELECT doc_id AS pos, CASE WHEN has_teacher AND NOT has_student THEN 'all' WHEN NOT has_teacher THEN ''
        ELSE concat_ws(',', CASE WHEN NOT student_intent THEN 'intent' END, CASE WHEN NOT teacher_urgency THEN 'urgency' END) END AS differs FROM r"""
)
def compare_answers(spark, sf_dir):
    made = router.compare_answers(routed_rows(spark, sf_dir))
    told = F.when(F.col("teacher").isNotNull() & F.col("student").isNull(), "all").otherwise(F.array_join("differs", ","))
    return made.select("pos", told.alias("differs"))


# --- training examples ---------------------------------------------------------


def _training_examples(spark, sf_dir):
    import public_tokenizers  # where this machine has its vocabulary files

    records = training.answered_conversations(table(spark, sf_dir, "conversations"))
    return training.training_examples(records, public_tokenizers.path("byte_bpe_50k.json"), key="conv_id")


@query()
def training_examples(spark, sf_dir):
    """Every conversation up to its last answer, in token ids with the prompt masked."""
    made = _training_examples(spark, sf_dir)
    digest = lambda c: F.md5(F.array_join(F.col(c).cast("array<string>"), ",").cast("binary"))
    ids, labels = digest("input_ids").alias("ids_md5"), digest("labels").alias("labels_md5")
    return made.select("conv_id", F.size("input_ids").alias("n_tokens"), "n_masked", "truncated", ids, labels)


@query()
def training_batches(spark, sf_dir):
    """What the padded batches hold, by bucket of length."""
    made = training.training_batches(_training_examples(spark, sf_dir), key="conv_id")
    tokens = F.aggregate(F.flatten("attention_mask"), F.lit(0).cast("long"), lambda a, x: a + x)
    sums = (F.sum(F.size("keys")).alias("examples"), F.max("width").alias("longest"), F.sum(tokens).alias("tokens"))
    return made.groupBy("bucket").agg(*sums)


# --- cost and calls ------------------------------------------------------------


@query("SELECT p_partkey, (500 * p_retailprice + 200 * p_retailprice * 5) / 1e6 * 1000 AS usd FROM part")
def cost_api(spark, sf_dir):
    p = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select("p_partkey", cost.api_per_1k(F.lit(500), F.lit(200), p, p * 5).alias("usd"))


@query("SELECT p_partkey, 1.8::DOUBLE * 1000 / 3600 / greatest(p_size, 1) * p_retailprice AS usd FROM part")
def cost_self_hosted(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", cost.self_hosted_per_1k(F.lit(1.8), F.col("p_retailprice"), F.col("p_size")).alias("usd"))


@query("SELECT p_partkey, 0.7::DOUBLE + (1 - p_size / 50.0::DOUBLE) * p_retailprice AS usd FROM part")
def cost_routed(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", cost.routed_per_1k(F.lit(0.7), F.col("p_retailprice"), F.col("p_size") / 50.0).alias("usd"))


@query(
    f"""WITH {_SQL_LEDGER}, u AS (SELECT sum(input_tokens) / CAST(sum(items) AS DOUBLE) AS i, sum(output_tokens) / CAST(sum(items) AS DOUBLE) AS o, max(value / 100) AS s FROM l)
        SELECT 'teacher: ' || p_brand AS name, round_even((any_value(i) * max(p_retailprice) + any_value(o) * max(p_retailprice) * 5) / 1e6::DOUBLE * 1000, 4) AS usd_per_1k, TRUE AS measured
        FROM part, u GROUP BY p_brand
        UNION ALL SELECT 'student: CPU', round_even(s * 1000 / 3600 / 1 * {cost.CostConfig.cpu_hourly}::DOUBLE, 4), TRUE FROM u
        UNION ALL SELECT 'student: GPU, assumed', round_even(1000 / {cost.CostConfig.gpu_items_per_second}::DOUBLE / 3600 * {cost.CostConfig.gpu_hourly}::DOUBLE, 4), FALSE"""
)
def cost_table(spark, sf_dir):
    """Brands as models at their highest price, with the tokens and the longest wait of the ledger."""
    calls_made = ledger(spark, sf_dir)
    used = cost.token_usage(calls_made).first()
    top = F.max("p_retailprice")
    prices = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(top.alias("input_per_million"), (top * 5).alias("output_per_million"))
    return cost.cost_table(spark, prices, *used, calls_made.agg(F.max("latency_s")).first()[0])


@query(f"WITH {_SQL_LEDGER} SELECT stage, status, coalesce(served_model, '-') AS served_model, count(*) AS count FROM l GROUP BY ALL")
def ledger_rollup(spark, sf_dir):
    return calls.ledger_rollup(ledger(spark, sf_dir))


@query(
    f"""WITH {_SQL_LEDGER} SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'retryable_error') AS retried,
        count(*) FILTER (status = 'error') AS failed, TRUE AS all_free FROM l"""
)
def ledger_view(spark, sf_dir):
    return calls.ledger_view(ledger(spark, sf_dir))


@query(
    f"""WITH {_SQL_LEDGER} SELECT sum(input_tokens) / CAST(greatest(sum(items), 1) AS DOUBLE) AS input_per_item,
        sum(output_tokens) / CAST(greatest(sum(items), 1) AS DOUBLE) AS output_per_item FROM l"""
)
def token_usage(spark, sf_dir):
    return cost.token_usage(ledger(spark, sf_dir))


@query(f"WITH {_SQL_LEDGER} SELECT CAST(sum(items) AS BIGINT) AS items FROM l")
def latency_items(spark, sf_dir):
    """Calls spread over their items."""
    return cost.latency_per_item(ledger(spark, sf_dir)).agg(F.count("*").alias("items"))


@query("SELECT doc_id, doc_id % 3 <> 0 AS hit FROM documents")
def cache_split(spark, sf_dir):
    """Requests that a cache of two thirds of them has, and those it has not."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = calls.cache_key(F.lit("p"), F.lit("s"), F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("text")), F.lit("{}"), F.lit(""))
    requests = rows.select("doc_id", key.alias("key"))
    hits, misses = calls.split_cached(requests, requests.filter("doc_id % 3 <> 0").select("key", F.lit("a").alias("answer")))
    return hits.select("doc_id", F.lit(True).alias("hit")).unionAll(misses.select("doc_id", F.lit(False).alias("hit")))


# --- contract ------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE 'BL-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS order_id,
       TRUE AS valid FROM orders"""
)
def order_id_normalize(spark, sf_dir):
    o = F.col("o_orderkey")
    digits = F.lpad((o % 1000000).cast("string"), 6, "0")
    raw = F.when(o % 4 == 0, F.concat(F.lit("  #BL-"), digits)).when(o % 4 == 1, F.concat(F.lit("bl "), digits)).when(o % 4 == 2, digits).otherwise("N/A")
    made = normalize_order_id(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", made.alias("order_id"), valid_order_id(made).alias("valid"))


@query(
    """SELECT doc_id, length(text) BETWEEN 8 AND 240 AND len(regexp_extract_all(text, '\\S+')) <= 30 AS summary_ok, length(text) BETWEEN 1 AND 8000 AS request_ok
       FROM documents"""
)
def text_rules(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", valid_summary(F.col("text")).alias("summary_ok"), valid_request(F.col("text")).alias("request_ok"))


@query(
    f"""WITH {_SQL_TICKETS} SELECT doc_id AS pos, '{{"intent": "' || a_intent || '", "urgency": "' || a_urgency || '", "sentiment": "' || a_sentiment
        || '", "product_area": "' || a_product_area || '", "order_id": ' || coalesce('"' || a_order_id || '"', 'null')
        || ', "summary": "Customer writes about number ' || doc_id || '."}}' AS answer FROM t"""
)
def answer_json(spark, sf_dir):
    return examples(spark, sf_dir).select("pos", triage_json(F.col("triage")).alias("answer"))


@query(
    """SELECT doc_id AS pos, doc_id % 6 <> 0 AS json_valid, doc_id % 6 NOT IN (0, 1, 2) AS valid FROM documents"""
)
def parse_answers(spark, sf_dir):
    """Answers fenced, wrapped in prose, broken, of the wrong shape or with a wrong class."""
    from ..functions.contract import parse_triage

    d, answer = F.col("pos"), triage_json(F.col("triage"))
    raw = (
        F.when(d % 6 == 0, F.substring(answer, F.lit(1), F.lit(40)))
        .when(d % 6 == 1, F.lit("[1, 2]"))
        .when(d % 6 == 2, F.replace(answer, F.lit('"urgency": "'), F.lit('"urgency": "very ')))
        .when(d % 6 == 3, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .when(d % 6 == 4, F.concat(F.lit("Here it is: "), answer, F.lit(" Done.")))
        .otherwise(answer)
    )
    made = examples(spark, sf_dir).select("pos", parse_triage(raw).alias("p"))
    return made.select("pos", "p.json_valid", F.col("p.triage").isNotNull().alias("valid"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS id, doc_id % 10 NOT IN (3, 7) AS valid, CASE WHEN doc_id % 10 = 7 THEN 'missing from the answer'
       WHEN doc_id % 10 = 3 THEN 'intent: not an allowed value' END AS error FROM documents"""
)
def parse_batch(spark, sf_dir):
    """Batch answers with repeated, unknown, invalid and missing items, the id first, within or last."""
    rows = batching.with_batches(examples(spark, sf_dir), 12)
    d, named = F.col("pos"), F.concat(F.lit('"id": "'), F.col("id"), F.lit('"'))

    def with_id(whole):
        return (
            F.when(d % 3 == 0, F.concat(F.lit("{"), named, F.lit(", "), F.substring(whole, F.lit(2), F.length(whole))))
            .when(d % 3 == 1, F.replace(whole, F.lit('"sentiment"'), F.concat(named, F.lit(', "sentiment"'))))
            .otherwise(F.concat(F.substring(whole, F.lit(1), F.length(whole) - 1), F.lit(", "), named, F.lit("}")))
        )

    def answered(body):
        bad = F.replace(body, F.lit('"intent": "'), F.lit('"intent": "no '))
        return F.when(d % 10 == 7, F.array()).when(d % 10 == 3, F.array(bad)).when(d % 10 == 5, F.array(bad, body)).otherwise(F.array(body, bad))

    items = let(let(triage_json(F.col("triage")), with_id), answered)
    stray = F.array(F.lit('{"id": "stray"}'))
    each = rows.select("batch", F.explode(F.concat(items, stray)).alias("item"))
    answers = each.groupBy("batch").agg(F.concat(F.lit('{"items": ['), F.array_join(F.collect_list("item"), ", "), F.lit("]}")).alias("text"))
    # the order within an answer is that of the items of one row, which stay together
    got = teacher.parse_batches(answers, rows.select("batch", "id"))
    return got.select("id", F.col("triage").isNotNull().alias("valid"), "error")


def _sql_hits(words: tuple[str, ...]) -> str:
    return "(" + " + ".join("CAST(contains(l, '{}') AS INTEGER)".format(w.replace("'", "''")) for w in words) + ")"


def _sql_first(words: dict[str, tuple[str, ...]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_sql_hits(w)} > 0 THEN '{k}'" for k, w in words.items()) + f" ELSE '{default}' END"


def _sql_keyword(source: str, high: int = 1) -> str:
    from ..functions import heuristics as h

    low = ", ".join(f"'{i}'" for i in h.LOW_URGENCY_INTENTS)
    won = "CASE " + " ".join(f"WHEN {_sql_hits(w)} > 0 THEN {_sql_hits(w)}" for w in h.INTENT_WORDS.values()) + " ELSE 0 END"
    digits = r"(?:#\s*)?(?:^|[^0-9A-Za-z_])(?:[Bb][Ll][\s-]?)?(\d{6})(?:[^0-9A-Za-z_]|$)"
    order = f"CASE WHEN regexp_matches(l, 'order|#|(^|[^0-9a-z_])bl[\\s-]?\\d{{6}}') THEN 'BL-' || nullif(regexp_extract(l, '{digits}', 1), '') END"
    return f"""WITH l AS (SELECT id, ' ' || lower(text) || ' ' AS l FROM ({source})), k AS (SELECT id, {order} AS order_id, {_sql_first(h.INTENT_WORDS, 'other')} AS intent,
        {_sql_first(h.PRODUCT_WORDS, 'none')} AS product_area, {_sql_hits(h.NEGATIVE_WORDS)} AS neg, {_sql_hits(h.POSITIVE_WORDS)} AS pos_,
        {_sql_hits(h.HIGH_URGENCY_WORDS)} AS high, {won} AS won FROM l)
        SELECT id, intent, product_area, order_id, 'Customer has a ' || replace(intent, '_', ' ') || ' request'
        || CASE WHEN product_area = 'none' THEN '' ELSE ' about their ' || replace(product_area, '_', ' ') END
        || coalesce(' (order ' || order_id || ')', '') || '.' AS summary, CASE WHEN neg > pos_ THEN 'negative' WHEN pos_ > neg THEN 'positive' ELSE 'neutral' END AS sentiment,
        CASE WHEN high >= {high} THEN 'high' WHEN intent IN ({low}) THEN 'low' ELSE 'medium' END AS urgency,
        round(least(1.0::DOUBLE, 0.35::DOUBLE + 0.2::DOUBLE * won + CASE WHEN product_area <> 'none' THEN 0.1::DOUBLE ELSE 0 END), 3) AS confidence FROM k"""


@query(
    _sql_keyword(
        """SELECT doc_id AS id, text || CASE doc_id % 5 WHEN 0 THEN ' where is my order #BL-123456, the package is late!!' WHEN 1 THEN ' please refund the camera today'
           WHEN 2 THEN ' I love the new bulb' WHEN 3 THEN ' cannot log in to the app, password lost again' ELSE '' END AS text FROM documents"""
    )
)
def keyword_triage_docs(spark, sf_dir):
    d = F.col("doc_id")
    tail = (
        F.when(d % 5 == 0, " where is my order #BL-123456, the package is late!!")
        .when(d % 5 == 1, " please refund the camera today")
        .when(d % 5 == 2, " I love the new bulb")
        .when(d % 5 == 3, " cannot log in to the app, password lost again")
        .otherwise("")
    )
    rows = table(spark, sf_dir, "documents").select(d.alias("id"), F.concat("text", tail).alias("text"))
    made = with_keyword_triage(rows, F.col("text"))
    return made.select("id", "k.intent", "k.product_area", "k.order_id", "k.summary", "k.sentiment", "k.urgency", "k.confidence")


QUERIES["keyword_triage"] = QUERIES.pop("keyword_triage_docs")
ORACLE_SQL["keyword_triage"] = ORACLE_SQL.pop("keyword_triage_docs")


# --- joins, batches, samples -----------------------------------------------------


@query("SELECT o_orderkey, coalesce(c_name, 'not labeled') AS label FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def label_default_join(spark, sf_dir):
    """A left join with a default for what has no match."""
    named = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, sf_dir, "orders").join(named, "o_custkey", "left").select("o_orderkey", F.coalesce("c_name", F.lit("not labeled")).alias("label"))


@query(
    """WITH q AS (SELECT CAST(doc_id AS VARCHAR) AS id, quality, toxic FROM labels)
       SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN a.id IS NULL THEN '?' ELSE 'first' END AS first, CASE WHEN a.id IS NULL THEN 'not labeled' END AS first_error,
              coalesce(a.quality = 1, FALSE) AS first_repaired, CASE WHEN b.id IS NULL THEN '?' ELSE 'second' END AS second, CASE WHEN b.id IS NULL THEN 'not labeled' END AS second_error
       FROM documents LEFT JOIN q AS a ON a.id = CAST(doc_id AS VARCHAR) LEFT JOIN (SELECT * FROM q WHERE toxic = 1) AS b ON b.id = CAST(doc_id AS VARCHAR)"""
)
def ticket_labels(spark, sf_dir):
    """Documents with the labels of two teachers, of whom the second knows toxic ones only."""
    rated = table(spark, sf_dir, "labels")

    def label(model: str) -> Column:
        repaired = (F.col("quality") == 1).alias("repaired")
        return F.struct(F.lit(model).alias("model"), _triage(F.col("doc_id"), {}).alias("triage"), F.lit(None).cast("string").alias("error"), repaired).cast(LABEL)

    made = [
        rows.select(F.col("doc_id").cast("string").alias("id"), label(model).alias(f"label_{i}"))
        for i, (model, rows) in enumerate((("first", rated), ("second", rated.filter("toxic = 1"))))
    ]
    each = teacher.join_labels(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id")), made)
    a, b = F.col("labels")[0], F.col("labels")[1]
    return each.select(
        "id", a["model"].alias("first"), a["error"].alias("first_error"), a["repaired"].alias("first_repaired"), b["model"].alias("second"), b["error"].alias("second_error")
    )


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'repaired' ELSE c_name END AS answer FROM customer")
def upsert_repairs(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("answer"))
    return teacher.upsert(old, old.filter("id % 7 = 0").withColumn("answer", F.lit("repaired")))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS pos FROM documents UNION ALL SELECT 'x' || item_id, item_id + (SELECT max(doc_id) + 1 FROM documents) FROM benchmark")
def append_union(spark, sf_dir):
    from ..sources.tables import append_records

    old = table(spark, sf_dir, "documents").select("doc_id").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("pos"))
    new = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("x"), "item_id").alias("id"), F.col("item_id").alias("pos"))
    return append_records(old, new)


@query("SELECT doc_id, doc_id // 12 AS batch FROM documents")
def batch_ids(spark, sf_dir):
    return batching.with_batches(table(spark, sf_dir, "documents"), 12, "doc_id").select("doc_id", "batch")


@query("SELECT doc_id FROM documents WHERE doc_id % greatest(1, (SELECT count(*) FROM documents) // 12) = 0 ORDER BY doc_id LIMIT 12")
def systematic_sample(spark, sf_dir):
    return batching.systematic_sample(table(spark, sf_dir, "documents").select("doc_id"), 12, "doc_id")


def _sql_uniform(axis: str) -> str:
    return f"(('0x' || substr(sha256('42:{axis}:' || id), 1, 12))::BIGINT / {float(1 << 48)}::DOUBLE)"


def _sql_pick(axis: str, values) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[floor({_sql_uniform(axis)} * {len(values)})::INT + 1]"


_SQL_SEEDS = f"""WITH i AS (SELECT 's' || lpad(n::VARCHAR, 5, '0') AS id, ([{', '.join(repr(t) for t in INTENTS)}])[n % {len(INTENTS)} + 1] AS topic FROM range((SELECT count(*) FROM documents)) r(n)),
    d AS (SELECT *, CASE {' '.join(f"WHEN topic = '{t}' THEN {_sql_pick('product', p)}" for t, p in batching.TOPIC_PRODUCTS.items())}
        ELSE {_sql_pick('product', [p for p in PRODUCT_AREAS if p != 'none'])} END AS product, {_sql_pick('tone', batching.TONES)} AS drawn FROM i)
    SELECT row_number() OVER (ORDER BY sha256('42:' || id)) - 1 AS pos, id, topic, product,
        CASE WHEN topic = 'feedback' AND drawn = 'neutral' THEN {_sql_pick('tone-again', ('happy', 'frustrated'))} ELSE drawn END AS tone,
        {_sql_pick('length', [v for v, n in batching.LENGTHS for _ in range(n)])} AS length, {_sql_pick('style', batching.STYLES)} AS style,
        {_sql_uniform('order')} < CASE WHEN topic IN ({', '.join(repr(t) for t in batching.ORDER_TOPICS)}) THEN {batching.ORDER_SHARE} ELSE {batching.OTHER_ORDER_SHARE} END AS order_number,
        {_sql_uniform('contact')} < {batching.CONTACT_SHARE} AS contact_details FROM d"""


@query(_SQL_SEEDS)
def seed_matrix(spark, sf_dir):
    """As many seeds as there are documents."""
    return batching.seed_matrix(spark, table(spark, sf_dir, "documents").count())


# fields hold no character that JSON escapes
_SQL_RAW = "'{' || " + " || ', ' || ".join(f"""'"{f}": ' || coalesce('"' || {f} || '"', 'null')""" for f in FIELDS) + " || '}'"


@query(f"SELECT id, {_SQL_RAW} AS raw, confidence FROM ({_sql_keyword('SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents')})")
def keyword_student(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("id"), "text")
    return student.keyword_student(rows).select("id", "raw", "confidence")


@query(
    f"""WITH {_SQL_TICKETS} SELECT id, a_intent AS intent, k.intent AS predicted, a_order_id AS order_id, k.order_id AS predicted_order_id, confidence
        FROM t JOIN ({_sql_keyword('SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents')}) AS k ON id = CAST(doc_id AS VARCHAR)"""
)
def gold_predictions(spark, sf_dir):
    """Gold labels beside the predictions of the keyword student, one to one by id."""
    gold = examples(spark, sf_dir).select("pos", "id", "text", F.col("triage").alias("label"))
    own = student.keyword_student(gold.select("pos", "id", "text"))
    made = metrics.matched(gold.drop("text"), own.drop("pos"))
    predicted = [F.col("p_triage.intent").alias("predicted"), F.col("p_triage.order_id").alias("predicted_order_id"), F.col("p_confidence").alias("confidence")]
    return made.select("id", F.col("label.intent").alias("intent"), F.col("label.order_id").alias("order_id"), *predicted)


def _sql_token(field: str) -> str:
    return f"""(length(regexp_extract(raw, '(?s)^(.*?"{field}"\\s*:\\s*"?)', 1)) // 4) % 97 / 100.0::DOUBLE"""


@query(
    f"""WITH a AS (SELECT id, {_SQL_RAW} AS raw FROM ({_sql_keyword('SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents')}))
        SELECT id, {', '.join(f'{_sql_token(f)} AS {f}' for f in STRUCTURED)}, least({', '.join(_sql_token(f) for f in STRUCTURED)}) AS confidence FROM a"""
)
def answer_confidences(spark, sf_dir):
    """Confidences of the keyword student's answers as if generated in tokens of four characters, the probability of each by its place."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("id"), "text")
    raw = student.keyword_student(rows).select("id", "raw")
    at = F.sequence(F.lit(0), F.ceil(F.length("raw") / 4).cast("int") - 1)
    by_field = student.field_confidences(F.col("raw"), F.transform(at, lambda i: (i + 1) * 4), F.transform(at, lambda i: i % 97 / 100.0))
    made = raw.select("id", by_field.alias("c"))
    return made.select("id", *[F.try_element_at("c", F.lit(f)).alias(f) for f in STRUCTURED], student.answer_confidence(F.col("c")).alias("confidence"))


_SQL_SEEN = f"SELECT CAST(doc_id AS VARCHAR) AS id, clean AS text FROM ({_sql_scrub('SELECT doc_id, text FROM documents')})"
#: As in ``hash_remainder``: the hash as one number, four hex digits at a time.
_SQL_SPOILT = f"list_reduce([('0x' || sha256(text)[i * 4 + 1 : i * 4 + 4])::BIGINT FOR i IN range(16)], lambda a, q: (a * 65536 + q) % {teacher.INVALID_EVERY}) = 0"


@query(
    f"""WITH seen AS ({_SQL_SEEN}), plain AS (SELECT id, {_SQL_RAW} AS raw FROM ({_sql_keyword('FROM seen')})),
        strict AS (SELECT id, {_SQL_RAW} AS raw FROM ({_sql_keyword('FROM seen', high=2)}))
        SELECT id, plain.raw AS first, strict.raw AS second, {_SQL_SPOILT} AS repaired FROM seen JOIN plain USING (id) JOIN strict USING (id)"""
)
def label_tickets(spark, sf_dir):
    """Two offline teachers with a repair pass over scrubbed documents."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("id"), "text")
    made = teacher.label_tickets(rows, ["offline-a", "offline-b"])
    label = lambda i: triage_json(F.col("labels")[i]["triage"])
    return made.select("id", label(0).alias("first"), label(1).alias("second"), F.col("labels")[0]["repaired"].alias("repaired"))


_SQL_REQUESTS = "SELECT CAST(item_id AS VARCHAR) AS id, text FROM benchmark"


@query(
    f"""SELECT id, CASE WHEN s.confidence >= 0.6 THEN s.raw ELSE t.raw END AS answer, CASE WHEN s.confidence >= 0.6 THEN 'student' ELSE 'teacher' END AS source,
        printf('confidence %.2f ', s.confidence) || CASE WHEN s.confidence >= 0.6 THEN 'at or above' ELSE 'below' END || ' 0.60' AS reason
        FROM (SELECT id, {_SQL_RAW} AS raw, confidence FROM ({_sql_keyword(_SQL_REQUESTS)})) AS s
        JOIN (SELECT id, {_SQL_RAW} AS raw FROM ({_sql_keyword(_SQL_REQUESTS, high=2)})) AS t USING (id)"""
)
def online_router(spark, sf_dir):
    """The online router on a batch of benchmark texts."""
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")
    return routing.answer_batch(rows, 0.6, "offline-b").select("id", triage_json(F.col("triage")).alias("answer"), "source", "reason")


# --- reports ---------------------------------------------------------------------


@query(
    f"""WITH r AS (SELECT lang, {_SQL_LENGTH} AS reason FROM documents),
        g AS (SELECT lang AS name, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'too_long') AS l, count(*) FILTER (reason = 'too_short') AS s FROM r GROUP BY lang)
        SELECT name, round_even(100.0::DOUBLE * kept / max(kept + l + s) OVER (), 2) AS width, round_even(100.0::DOUBLE * (l + s) / max(kept + l + s) OVER (), 2) AS dropped_width,
               concat_ws(', ', CASE WHEN l > 0 THEN 'too long ' || l END, CASE WHEN s > 0 THEN 'too short ' || s END) AS details FROM g"""
)
def funnel_bars(spark, sf_dir):
    """The length gate of each language as a bar."""
    gated = table(spark, sf_dir, "documents").select(F.col("lang").alias("name"), funnel.length_reason(F.col("text")).alias("reason"))
    n = {r: F.count_if(F.col("reason") == r) for r in ("too_long", "too_short")}
    every = F.create_map(*[x for r, c in n.items() for x in (F.lit(r), c)])
    steps = gated.groupBy("name").agg(
        F.count_if(F.col("reason").isNull()).alias("kept"), F.count("reason").alias("dropped"), F.map_filter(every, lambda _, c: c > 0).alias("reasons")
    )
    return report.funnel_bars(steps).select("name", "width", "dropped_width", "details")


@query(
    """SELECT 'max_chars' AS metric, max(CASE WHEN lang = 'de' THEN n_chars END)::DOUBLE AS de, max(CASE WHEN lang = 'en' THEN n_chars END)::DOUBLE AS en FROM documents
       UNION ALL SELECT 'rows', count(*) FILTER (lang = 'de')::DOUBLE, count(*) FILTER (lang = 'en')::DOUBLE FROM documents"""
)
def metric_pivot(spark, sf_dir):
    wide = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("system")).agg(F.max("n_chars").alias("max_chars"), F.count("*").alias("rows"))
    return report.metric_table(wide, ["de", "en"])


@query(
    f"""WITH {_SQL_ROUTED}, c AS (SELECT unnest(range(21)) / 20.0::DOUBLE AS threshold), t AS ({_sql_simulation('threshold', 'r, c')} GROUP BY threshold)
        SELECT string_agg(CASE WHEN threshold = 0 THEN 'M' ELSE 'L' END || CAST(round_even(36 + threshold * 488, 1) AS VARCHAR) || ','
        || CAST(round_even(36 + (1 - offload_rate) * 168, 1) AS VARCHAR), ' ' ORDER BY threshold) AS path FROM t"""
)
def curve_path(spark, sf_dir):
    return report.curve_path(router.tradeoff_curve(routed_rows(spark, sf_dir)), "offload_rate")


@query(
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", event_type, count(*) AS n
       FROM events GROUP BY ALL"""
)
def event_windows(spark, sf_dir):
    """Extension: events by hour and type, as the streaming slice computes them."""
    made = routing.windowed(table(spark, sf_dir, "events"), F.window("ts", "1 hour"))
    return made.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n")
