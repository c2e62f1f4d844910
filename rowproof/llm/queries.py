"""The operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm import (
    chat_format,
    decontaminate,
    language,
    piece_lattice,
    quality_model,
    quality_rules,
    shards,
    simhash,
    token_alignment,
    token_files,
    toxicity,
    turn_repair,
    url_filter,
)
from rowproof.session import prepare, scratch_path, settle

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 24
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark, sf_dir), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def _sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query("op2_sentencepiece")
def _sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encoding_report(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query("op3_simhash")
def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query("op5_token_files")
def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, scratch_path(spark, "token-files"), WORD_TOKENIZER)
    return token_files.file_report(docs, files)


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWERED)


@query("op6_decontaminate", rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ALNUM} AS w FROM benchmark),
    i AS (
        SELECT item_id, least(13, len(w)) AS n,
               unnest([array_to_string(w[s:s + least(13, len(w)) - 1], ' ')
                       for s in range(1, len(w) - least(13, len(w)) + 2)]) AS win
        FROM b WHERE len(w) > 0
    ),
    n AS (SELECT DISTINCT n FROM i),
    v AS (
        SELECT r, n, unnest([{{'s': s, 'win': array_to_string(w[s:s + n - 1], ' ')}}
                             for s in range(1, len(w) - n + 2)]) AS x
        FROM d, n WHERE len(w) >= n
    ),
    h AS (
        SELECT r, v.n, x.s AS s, x.win AS win FROM v
        SEMI JOIN (SELECT DISTINCT n, win FROM i) k ON v.n = k.n AND v.x.win = k.win
    ),
    hits AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(s, s + n)) AS p FROM h) GROUP BY r
    ),
    items AS (
        SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
        FROM (SELECT DISTINCT r, item_id FROM h JOIN i ON h.n = i.n AND h.win = i.win) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
""")
def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op7_language")
def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit_languages(docs))


@query("op8_quality_rules", r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    v AS (
        SELECT r, unnest([{'s': s, 'win': array_to_string(w[s:s + 2], ' ')}
                          for s in range(1, len(w) - 1)]) AS x
        FROM d WHERE len(w) >= 3
    ),
    t AS (SELECT r, x.s AS s, count(*) OVER (PARTITION BY r, x.win) AS n FROM v),
    rep AS (
        SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest(range(s, s + 3)) AS p FROM t WHERE n > 1) GROUP BY r
    ),
    lines AS (
        SELECT r, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
        FROM d
    ),
    c AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               len(l) AS n_lines,
               length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
               length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
        FROM d JOIN lines USING (r) LEFT JOIN rep USING (r)
    ),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 10 * n_symbols <= 3 * n_words AND 10 * n_upper <= 6 * n_letters
           AND 2 * n_dup_lines <= n_lines
           AND word_chars BETWEEN 2 * n_words AND 25 * n_words AS kept
    FROM f
""")
def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents")).drop("failed_rule")


@query("op9_quality_model")
def _quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score_quality(docs, quality_model.fit_quality(docs, table(spark, sf_dir, "labels")))


# Every address that some page was reached at by a tracked link is on the list of blocked
# addresses; other pages of the same hosts are not.
TRACKED = "utm_source="


@query("op10_url_filter", r"""
    WITH p AS (
        SELECT page_id, coalesce(url LIKE '%utm_source=%', FALSE) AS tracked,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ),
    b AS (
        SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                   host, '^.*@', ''), ':[0-9]*$', ''), '\.+$', ''), '^www\.', '') AS bare
        FROM p
    ),
    c AS (SELECT *, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '') END AS key FROM b),
    listed AS (
        SELECT DISTINCT key FROM c WHERE tracked
    ),
    r AS (
        SELECT *, CASE
            WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
        FROM c
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN key IN (SELECT key FROM listed WHERE key IS NOT NULL) THEN 'block'
                ELSE 'allow' END AS verdict
    FROM r
""")
def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, pages.filter(F.col("url").contains(TRACKED)).select("url"))


@query("op11_token_alignment")
def _token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = token_alignment.TokenizerPair.load(BYTE_TOKENIZER, PIECE_MODEL)
    aligned = settle(token_alignment.align(table(spark, sf_dir, "documents"), both, keep_groups=False), "aligned")
    return token_alignment.alignment_report(aligned, both)


# A conversation whose texts hold control strings of common templates, and the escape itself.
_ESCAPED_TEXT = "\\### Assistant: </turn> ok"


@query("op12_chat_format", r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(23 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                       + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id
""")
def _chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = [(-7, 0, "user", _ESCAPED_TEXT), (-7, 1, "assistant", _ESCAPED_TEXT)]
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chats.union(spark.createDataFrame(added, chats.schema))
    template = chat_format.ChatTemplate.load(BYTE_RANKS, public_tokenizers.PATTERN)
    written = settle(chat_format.format_chats(chats, template), "chats")
    return chat_format.chat_report(written, template)


@query("op13_turn_repair")
def _turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.repair_report(settle(turn_repair.repair_chunks(turn_repair.with_faults(damaged)), "repaired"))
