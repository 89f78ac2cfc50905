"""Registered queries of these operators and the SQL they must agree with.

Each query applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoloom.llm import (
    byte_bpe,
    decontaminate,
    hidden_markov,
    merkle,
    mixing,
    oracles,
    quality,
    secret_scan,
    sharding,
    simhash,
    spelling,
    token_files,
    url_filter,
    warc_zip,
)
from chronoloom.llm.common import scratch

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.warc_table(_table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_table(_table(spark, sf_dir, "pages"), RULES)


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score_table(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_table(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), _pattern())


def op7_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_table(_table(spark, sf_dir, "documents"))


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(_table(spark, sf_dir, "documents"))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_table(_table(spark, sf_dir, "documents"), scratch(spark, "ledger"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_table(_table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_table(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality_rules,
        op2_decontamination,
        op3_warc_zip,
        op4_url_filter,
        op5_hidden_markov,
        op6_byte_bpe,
        op7_huffman_tokens,
        op8_simhash,
        op9_extendible_shards,
        op10_secret_ledger,
        op11_merkle_manifest,
        op12_source_mix,
        op13_spelling_variants,
    ]
    return {query.__name__: query for query in found}


def quality_sql() -> str:
    """Counts, sketches, thresholds and verdicts of the quality rules."""
    word = r"[^\x20\x09-\x0D]+"
    rules = ", ".join(f"('{m}', {low}, {high}, {least})" for m, (low, high, least) in quality.RULES.items())
    shift = f"greatest(length(bin(value)) - {quality.SKETCH_BITS}, 0)"
    bare = lambda c: f"length(regexp_replace({c}, '[\\x20\\x09-\\x0D]', '', 'g'))"

    def bounds(keys: str) -> str:
        group = f"{keys}, " if keys else ""
        over = f"PARTITION BY {group}measure"
        return f"""(SELECT {group}measure, any_value(total) AS n,
            min(bucket) FILTER (100 * upto >= high * total) + {quality.WIDTH} * greatest(
              min(bucket) FILTER (100 * upto >= high * total) - min(bucket) FILTER (100 * upto >= low * total), any_value(least))
            AS bound
          FROM (SELECT *, sum(n) OVER ({over}) AS total,
              sum(n) OVER ({over} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto
            FROM (SELECT {group}measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL)
            JOIN (VALUES {rules}) l(measure, low, high, least) USING (measure))
          GROUP BY ALL)"""

    def held(name: str, by: str) -> str:
        return f"(({name}.n * {name}.bound + {quality.HELD} * {by}) // ({name}.n + {quality.HELD}))"

    return rf"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
      split AS (SELECT *, regexp_extract_all(text, '{word}') AS w,
          list_filter(string_split(text, chr(10)), lambda x: {bare('x')} > 0) AS l FROM texts),
      windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split)),
      covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
        FROM windows, (VALUES (0), (1), (2)) v(k) WHERE times > 1 GROUP BY r),
      counted AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, {bare('text')} AS word_chars,
          len(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
          len(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
          CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
          CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM split LEFT JOIN covered USING (r)),
      failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
      measures AS (SELECT r, lang, source, base_failed, unnest([
          {{'measure': 'symbol_share', 'value': coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0)}},
          {{'measure': 'capital_share', 'value': coalesce(n_capitals * 1000 // nullif(word_chars, 0), 0)}},
          {{'measure': 'dup_line_share', 'value': coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0)}},
          {{'measure': 'repeat_share', 'value': coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0)}},
          {{'measure': 'mean_length', 'value': coalesce(word_chars * 1000 // nullif(n_words, 0), 0)}}], recursive := true)
        FROM failed),
      sketch AS (SELECT lang, source, measure, (value >> {shift}) << {shift} AS bucket, count(*) AS n
        FROM measures WHERE NOT base_failed GROUP BY ALL),
      own AS {bounds('lang, source')}, langs AS {bounds('lang')}, every AS {bounds('')},
      over AS (SELECT r, bool_or(value > {held('own', held('langs', 'every.bound'))}) AS rejected FROM measures m
        JOIN own ON own.lang IS NOT DISTINCT FROM m.lang AND own.source IS NOT DISTINCT FROM m.source
          AND own.measure = m.measure
        LEFT JOIN langs ON langs.lang IS NOT DISTINCT FROM m.lang AND langs.measure = m.measure
        LEFT JOIN every ON every.measure = m.measure GROUP BY r)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT coalesce(rejected, false) AS kept FROM failed LEFT JOIN over USING (r)"""


def shard_sql() -> str:
    """Shards as the shallowest hash prefixes that fit, which is what splitting only oversized buckets comes to."""
    return f"""WITH hashed AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
          CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
      nodes AS (SELECT d, h >> (60 - d) AS p, sum(n_bytes) AS shard_bytes
        FROM hashed, generate_series(0, 40) g(d) GROUP BY ALL HAVING sum(n_bytes) <= {sharding.SHARD_BYTES}),
      best AS (SELECT doc_id, h, n_bytes, min(d) AS depth FROM hashed JOIN nodes ON h >> CAST(60 - d AS BIGINT) = p GROUP BY ALL)
      SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), CAST(depth AS INTEGER), '0') END AS shard,
        CAST(depth AS INTEGER) AS depth, n_bytes, CAST(shard_bytes AS BIGINT) AS shard_bytes
      FROM best JOIN nodes ON d = depth AND p = h >> (60 - depth)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_sql(),
        "op9_extendible_shards": shard_sql(),
        "op11_merkle_manifest": oracles.merkle_sql(),
        "op12_source_mix": oracles.mix_sql(),
        "op13_spelling_variants": oracles.spelling_sql(),
    }
