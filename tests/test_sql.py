"""Queries against their SQL in DuckDB, and the SQL of phone numbers against a plain program."""

import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siftstone.functions import pii
from siftstone.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "part", "events", "benchmark")
TRICKY = [
    "call 555-123-4567 or 555 123 4568, 020 7946 0958.",
    "+1 (415) 555-0134(02)",
    "123456 123456789 12-34-56 x12345678901 -123456789 123456789- (020)7946 0958",
    "é123456789 1234567890 1234567890\n987654321",
    "12345678901234567890123 12345678901234567890",
    "mail sam12@example.com, card 4111 1111 1111 1111, phone +44 20 7946 0958",
    "",
    "   ",
]


def _rows(rows):
    return sorted(tuple(f"{x:.10g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


def _both(spark, folder, name, tables):
    made = catalog.QUERIES[name](spark, str(folder))
    columns = sorted(made.columns)
    db = duckdb.connect()
    for t in tables:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    wanted = db.sql(catalog.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    return _rows(made.select(*[f"`{c}`" for c in columns]).collect()), _rows(wanted.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())


@pytest.mark.parametrize(
    "name",
    ["pii_scrub", "label_tickets", "funnel_bars", "seed_matrix", "cost_table", "ticket_labels", "gold_predictions", "answer_confidences", "funnel_exact", "funnel_exact_dropped"],
)
def test_query_equals_its_sql(spark, name):
    made, wanted = _both(spark, SF, name, TABLES)
    assert made == wanted and made


@pytest.mark.parametrize("name", ["pii_phone", "pii_scrub"])
def test_scrubbing_of_tricky_numbers(spark, tmp_path, name):
    pq.write_table(pa.table({"doc_id": list(range(len(TRICKY))), "text": TRICKY}), tmp_path / "documents.parquet")
    made, wanted = _both(spark, tmp_path, name, ["documents"])
    # DuckDB's word boundaries, which the card pattern needs, are those of ASCII
    same = [i for i, t in enumerate(TRICKY) if name == "pii_phone" or t.isascii()]
    at = sorted(catalog.QUERIES[name](spark, str(tmp_path)).columns).index("doc_id")
    assert [r for r in made if int(r[at]) in same] == [r for r in wanted if int(r[at]) in same]

    def phones(text):
        return re.sub(pii.PHONE, lambda m: "[PHONE]" if sum(c.isdigit() for c in m[0]) >= pii.PHONE_DIGITS else m[0], text)

    def scrubbed(text):
        return phones(re.sub(pii.CARD, "[CARD]", re.sub(pii.EMAIL, "[EMAIL]", text)))

    expected = phones if name == "pii_phone" else scrubbed
    got = {r.doc_id: r.clean for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()}
    assert got == {i: expected(t) for i, t in enumerate(TRICKY)}


def test_greedy_twins_of_a_chain_and_copies(spark, tmp_path):
    base = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)} " for i in range(60)]
    texts = ["".join(base), "".join(base[4:]), "".join(base[8:]), "".join(base), "".join(base[30:] + ["other "] * 3), "", "", "unlike all of them", "".join(base[4:])]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), tmp_path / "documents.parquet")
    made, wanted = _both(spark, tmp_path, "neardup_greedy", ["documents"])
    assert made == wanted and made
