"""One query per operator over its whole table, with DuckDB SQL where SQL can state the result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.llm import chat_format, hard_negatives, lexical_search, line_dedup, mixing, ngram_join, quality_rules, secret_scan, sentencepiece_bpe, suffix_dedup, token_files, toxicity, vector_dedup
from lodestead.llm.text import words
from lodestead.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str, *columns) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _rule_sql(rule: quality_rules.Rule) -> str:
    per = "1" if rule.per == "one" else rule.per
    tests = []
    if rule.low is not None:
        tests.append(f"100.0 * {rule.measure} < {round(rule.low * 100, 6)} * {per}")
    if rule.high is not None:
        tests.append(f"100.0 * {rule.measure} > {round(rule.high * 100, 6)} * {per}")
    return f"((({') OR ('.join(tests)})) AND n_words >= {rule.at_least})"


def _escaped_sql(column: str) -> str:
    """Length of a text as the chat template writes it: one more for each control string or escape character."""
    marks = "|".join(re.escape(x) for x in (chat_format.ESCAPE, *chat_format.CONTROL)).replace("'", "''")
    return f"(length({column}) + len(regexp_extract_all({column}, '{marks}')))"


_MARKS = len(chat_format.TURN + chat_format.TEXT + chat_format.END)


@_query(f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum({_MARKS} + {_escaped_sql("role")} + {_escaped_sql("text")}) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
""")
def op2_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_format.read_back(chat_format.format_turns(rows.unionByName(probe)))


QUALITY_CTES = f"""
    d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
    windows AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS win
                FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
    starts AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
    covered AS (SELECT r, CAST(sum(least(8, coalesce(later - i, 8))) AS BIGINT) AS n_repeat_words
                FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS later FROM starts) GROUP BY r),
    l AS (SELECT r, count(*) AS n_lines, count(DISTINCT line) AS n_different
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
    m AS (SELECT d.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                 CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations,
                 CAST(len(list_filter(ws, lambda x: x IN ({_quoted(quality_rules.STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
                 CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
                 CAST(coalesce(n_lines - n_different, 0) AS BIGINT) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words
          FROM d JOIN w ON d.r = w.r LEFT JOIN l ON d.r = l.r LEFT JOIN covered c ON d.r = c.r),
    judged AS (SELECT *, {" OR ".join(_rule_sql(x) for x in quality_rules.RULES if x.base)} AS base_failed,
                      NOT ({" OR ".join(_rule_sql(x) for x in quality_rules.RULES)}) AS kept FROM m)
"""


@_query(f"""
    WITH {QUALITY_CTES}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
""")
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query()
def op9_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return sentencepiece_bpe.token_digests(
        _table(spark, sf, "documents", "doc_id", "text"), _tokenizer("piece_bpe_32k.model"), "doc_id"
    )


@_query()
def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"
    )


@_query()
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "source", "text")
    slim = docs.select("doc_id", "source", F.size(words("text")).alias("n"), F.xxhash64("text").alias("h"))
    mixed = mixing.mix(slim, F.col("n"), ["doc_id", "h"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query()
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    labels = _table(spark, sf, "labels", "doc_id", F.col("toxic").alias("label"))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~toxicity.held_out("doc_id"))
    # The sample is bounded before texts are read; the join keeps one text for each of its ids or more.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(toxicity.MAX_DOCS)
    weights, bias = toxicity.train(docs.join(sample, "doc_id"))
    return toxicity.score(docs, weights, bias).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").cast("long").alias("n_offending"),
    )


LINE_CTES = f"""
    line_docs AS (SELECT row_number() OVER () AS r, * FROM {{documents}}),
    lines AS (SELECT r, source, generate_subscripts(string_split(text, chr(10)), 1) AS i,
                     unnest(string_split(text, chr(10))) AS line FROM line_docs WHERE text IS NOT NULL),
    bad AS (SELECT trim(line) AS line FROM lines WHERE length(trim(line)) >= {line_dedup.MIN_CHARS}
            GROUP BY 1 HAVING count(DISTINCT coalesce('=' || source, '?')) >= {line_dedup.MIN_SITES}),
    kept_lines AS (SELECT r, count(*) AS n_lines, CAST(count(*) FILTER (bad.line IS NOT NULL) AS BIGINT) AS n_removed,
                          coalesce(string_agg(lines.line, chr(10) ORDER BY i) FILTER (bad.line IS NULL), '') AS kept
                   FROM lines LEFT JOIN bad ON trim(lines.line) = bad.line GROUP BY r)
"""


@_query(f"""
    WITH {LINE_CTES.format(documents="documents")}
    SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed,
           sha256(kept) AS kept_sha256
    FROM line_docs LEFT JOIN kept_lines USING (r)
""")
def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "source", "text")
    return line_dedup.remove_boilerplate(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@_query(f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {vector_dedup.THRESHOLD}),
    c AS (SELECT vec_id AS id, vec_id AS least FROM embeddings
          UNION SELECT l.b, c.least FROM c JOIN l ON c.id = l.a WHERE c.least < l.b),
    m AS (SELECT id, min(least) AS component_id FROM c GROUP BY id)
    SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings e JOIN m ON m.id = e.vec_id
""")
def op8_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf, "embeddings", "vec_id", "embedding", "label"))


@_query()
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf, "documents", "doc_id", "text"))


@_query()
def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query()
def op13_token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    return token_files.token_table(docs, scratch_path(spark, "token-files"), _tokenizer("word_bpe_49k.json"))


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}')"


@_query(f"""
    WITH d AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS ts FROM documents) WHERE len(ts) > 0),
    s AS (SELECT count(*) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
    p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
          FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
    i AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS qtf
          FROM (SELECT q, item_id, unnest({_TERMS_SQL}) AS term
                FROM (SELECT row_number() OVER () AS q, * FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY q, term),
    scored AS (SELECT q, any_value(i.item_id) AS item_id, r, any_value(doc_id) AS doc_id,
                      CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * ({100 - 25} + (25 * len(ts) * nd) // l)))) AS BIGINT) AS score
               FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), s GROUP BY q, r)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= {lexical_search.TOP}
""")
def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf, "documents", "doc_id", "text"), _table(spark, sf, "benchmark", "item_id", "text"))


@_query(f"""
    WITH v AS (SELECT DISTINCT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.id AS a, a.label AS a_label, b.id AS b, b.label AS b_label, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
          FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
    p AS (SELECT a, b AS positive_id, score AS positive_score FROM s WHERE a_label = b_label
          QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {hard_negatives.POSITIVES})
    SELECT a AS anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY a, positive_id ORDER BY score DESC, b) AS INTEGER) AS rank,
           b AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (a) WHERE a_label <> b_label
      AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score
    QUALIFY rank <= {hard_negatives.NEGATIVES}
""")
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
