"""The driver's queries over the training-text operators, and their SQL.

Every query reads its whole table and returns the digest columns of its contract;
the operators themselves have wider interfaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .decontaminate import contamination_digest, find_contamination
from .exact_dedup import exact_dedup
from .jaccard_join import Rule, jaccard_components
from .language_id import identify_language, learn_dictionaries, remainder
from .mixing import mix_documents
from .prefix_trie import ORACLE_SQL as _TRIE_SQL
from .prefix_trie import conversation_trie
from .quality import learn_quality, score_quality
from .secret_scan import scan_secrets
from .source_audit import ORACLE_SQL as _AUDIT_SQL
from .source_audit import audit_sources
from .super_minhash import near_duplicates
from .token_count import count_tokens
from .token_files import read_token_files, write_token_files
from .tool_calls import link_tool_calls, reply_tools, turns_as_calls


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the box keeps a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).drop("links")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination_digest(find_contamination(spark, docs, benchmark, offsets=False))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(spark, read_table(spark, sf_dir, "documents"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links user and system turns, as calls, with the assistant turns that answer them."""
    calls, results = turns_as_calls(read_table(spark, sf_dir, "conversations"))
    linked = link_tool_calls(spark, calls, results, reply_tools(spark))
    errors = F.array_join("errors", ",").alias("errors")
    return linked.select("conv_id", "call_id", "turn", "level", "result_turn", "status", errors, "json")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, read_table(spark, sf_dir, "documents"), Rule(width=3, num=90, den=100))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_quality(docs, learn_quality(docs, labels, remainder(3) != 1))
    held = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify_language(docs, learn_dictionaries(docs, remainder(4) != 2))
    held = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", "rejected")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(spark, read_table(spark, sf_dir, "documents"), tokenizer_path())
    return read_token_files(spark, manifest)


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark, read_table(spark, sf_dir, "conversations"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(spark, read_table(spark, sf_dir, "documents"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_table(spark, sf_dir, "documents"), Rule(width=2, num=80, den=100))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_tool_calls": op4_tool_calls,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality": op6_quality,
    "op7_language_id": op7_language_id,
    "op8_token_files": op8_token_files,
    "op9_token_count": op9_token_count,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_audit": op12_source_audit,
    "op13_minhash_dedup": op13_minhash_dedup,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def _components_sql(width: int, num: int, kept: str = "") -> str:
    """Components of documents whose sets of shingles of ``width`` words have num/100 in common."""
    return f"""
        WITH RECURSIVE d AS (
          SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                                     '[^\\x20\\x09-\\x0D]+'), []) AS w
          FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, array_to_string(w[i : i + least({width}, len(w)) - 1], ' ') AS words
          FROM d, unnest(range(1, greatest(len(w) - {width}, 0) + 2)) AS u(i)
          WHERE len(w) > 0
        ), n AS (
          SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), met AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
          FROM s AS a JOIN s AS b ON a.words = b.words AND a.doc_id <> b.doc_id GROUP BY ALL
        ), link AS (
          SELECT a, b FROM met JOIN n AS na ON a = na.doc_id JOIN n AS nb ON b = nb.doc_id
          WHERE 100 * c >= {num} * (na.n + nb.n - c)
        ), reach AS (
          SELECT doc_id, doc_id AS r FROM documents
          UNION
          SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id{kept}
        FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
    """


ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": f"""
        WITH b AS (
          SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                             '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
          FROM benchmark
        ), win AS (
          SELECT DISTINCT item_id, least(10, len(w)) AS n,
                 array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
          FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i)
          WHERE len(w) > 0
        ), d AS (
          SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                                     '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), []) AS w
          FROM documents
        ), spots AS (
          SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
          FROM d, (SELECT DISTINCT n FROM win) AS lens, unnest(range(1, len(w) - n + 2)) AS u(i)
        ), found AS (
          SELECT s.doc_id, s.i, s.n, win.item_id FROM spots AS s JOIN win USING (n, words)
        ), hit AS (
          SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM found, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
        ), ids AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
    "op4_tool_calls": """
        WITH RECURSIVE c AS (
          SELECT DISTINCT conv_id, turn, role, text, coalesce(length(text), 0) AS chars, conv_id % 15 AS way FROM conversations
        ), k AS (
          SELECT * FROM c WHERE role IN ('user', 'system')
        ), f AS (
          SELECT conv_id, turn - 1 AS call_turn, min(text) AS text FROM c WHERE role = 'assistant' GROUP BY ALL
        ), reach AS (
          SELECT DISTINCT conv_id, turn AS t, turn AS u FROM k WHERE way % 3 = 0 OR way = 2
          UNION
          SELECT r.conv_id, r.t, k.turn FROM reach AS r JOIN k ON k.conv_id = r.conv_id AND k.turn = r.u + 2
        ), ahead AS (
          SELECT conv_id, t, CAST((max(u) - t) // 2 AS INTEGER) AS n FROM reach GROUP BY conv_id, t
        ), e AS (
          SELECT k.*, f.conv_id IS NOT NULL AS answered, f.text AS result,
                 CASE WHEN way % 3 = 0 THEN n
                      WHEN way = 2 AND (n > 0 OR EXISTS (FROM k AS p WHERE p.conv_id = k.conv_id AND p.turn = k.turn - 2)) THEN NULL
                      ELSE 0 END AS level,
                 chars % 5 = 0 AS quoted, chars % 7 <> 0 AS has_meta, chars % 11 = 0 AS has_note, chars % 13 = 0 AS cut,
                 CASE WHEN k.text IS NULL THEN 0 ELSE len(string_split(k.text, ' ')) END AS words
          FROM k LEFT JOIN ahead ON k.conv_id = ahead.conv_id AND k.turn = ahead.t
          LEFT JOIN f ON k.conv_id = f.conv_id AND k.turn = f.call_turn
        ), m AS (
          SELECT *, coalesce(CAST(to_json(role) AS VARCHAR), 'null') AS r FROM e
        )
        SELECT conv_id, 'c' || turn AS call_id, turn, level, CASE WHEN answered THEN turn + 1 END AS result_turn,
               CASE WHEN answered THEN 'linked' ELSE 'pending' END AS status,
               CASE WHEN role <> 'user' THEN 'unknown-tool' ELSE concat_ws(',', CASE WHEN has_note THEN 'extra:note' END,
                    CASE WHEN has_meta AND cut THEN 'json:meta' END, CASE WHEN NOT has_meta THEN 'missing:meta' END,
                    CASE WHEN text IS NULL THEN 'type:text' END, CASE WHEN quoted THEN 'type:turn' END) END AS errors,
               '{"arguments":{'
               || CASE WHEN NOT has_meta THEN ''
                       WHEN cut THEN '"meta":' || CAST(to_json('{ "words": ' || words || ', "by": {"role":' || r || ', "chars" : ' || chars || ' } ') AS VARCHAR) || ','
                       ELSE '"meta":{"by":{"chars":' || chars || ',"role":' || r || '},"words":' || words || '},' END
               || CASE WHEN has_note THEN '"note":null,' ELSE '' END
               || '"text":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"turn":' || CASE WHEN quoted THEN '"' || turn || '"' ELSE '' || turn END
               || '},"id":"c' || turn || '","name":"' || CASE WHEN role = 'user' THEN 'reply' ELSE 'instruct' END || '","result":'
               || coalesce(CAST(to_json(result) AS VARCHAR), 'null')
               || CASE WHEN answered THEN ',"status":"linked"}' ELSE ',"status":"pending"}' END AS json
        FROM m
    """,
    "op5_jaccard_join": _components_sql(3, 90),
    "op10_exact_dedup": """
        WITH n AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS norm
          FROM documents
        ), g AS (
          SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size, sha256(norm) AS text_sha256
          FROM n GROUP BY norm
        )
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, g.text_sha256
        FROM n JOIN g ON n.norm = g.norm
    """,
    "op11_prefix_trie": _TRIE_SQL,
    "op12_source_audit": _AUDIT_SQL,
    "op13_minhash_dedup": _components_sql(2, 80, ", coalesce(d.doc_id = min(r), true) AS kept"),
}
