"""One query per operator over the whole of its table, and the same in SQL where SQL can say it."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgercast.llm import (
    decontaminate, embedding_dedup, lm_score, mixing, periodic, quality, sharding, simhash, spelling, substring_dedup, token_files, token_prefix, url_filter,
    words as words_module,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"), 8)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """The pages as fetched over the days of 2024. The table has no dates, so the id gives one."""
    day = F.date_add(F.to_date(F.lit("2024-01-01")), F.pmod(F.col("page_id") * 37, F.lit(360)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries drawn from the pages' own hosts and addresses, so that lists grow with the web.

    Hosts with a telling name are blocked from the first day. Of the others a part is blocked on one
    day and freed on a later one, and some addresses are let through for good.
    """
    address = pages.select(url_filter.host(F.col("url")).alias("host"), url_filter.path(F.col("url")).alias("path"))
    address = address.where("host <> ''")
    hosts = address.select("host").distinct().withColumn("h", F.md5("host"))
    number = lambda column, at: F.conv(F.substring(column, at, 4), 16, 10).cast("int")
    start = F.to_date(F.lit("2024-01-01"))
    key, added = F.concat(F.lit("h:"), "host"), F.date_add(start, number("h", 1) % 240)
    telling = F.col("host").rlike("spam|pills|casino")
    bad = hosts.where(telling).select(key.alias("key"), F.lit("block").alias("verdict"), F.lit("add").alias("action"), start.alias("listed_on"))
    some = hosts.where(~telling & (number("h", 5) % 3 == 0))
    on = some.select(key.alias("key"), F.lit("block").alias("verdict"), F.lit("add").alias("action"), added.alias("listed_on"))
    off = some.select(
        key.alias("key"), F.lit("block").alias("verdict"), F.lit("remove").alias("action"),
        F.date_add(added, number("h", 9) % 90 + 1).alias("listed_on"),
    )
    pages_let = address.select(F.concat(F.lit("u:"), "host", "path").alias("key")).distinct().withColumn("h", F.md5("key"))
    allowed = pages_let.where(number("h", 1) % 16 == 0).select(
        "key", F.lit("allow").alias("verdict"), F.lit("add").alias("action"), F.date_add(start, number("h", 5) % 360).alias("listed_on")
    )
    return bad.union(on).union(off).union(allowed)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_captures(captures(pages), list_entries(pages))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_token_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_prefix.prefix_table(table(spark, sf_dir, "documents"), vocabulary_path())
    return token_prefix.over_limit(counted).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), vocabulary_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.apply_policy(quality.quality_ledger(table(spark, sf_dir, "documents")))
    base_kept = quality.BASE_POLICY.keeps(F.col("failures"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base_kept).alias("base_failed"), "kept", "failures",
    )


def with_cycles(docs: DataFrame) -> DataFrame:
    """The documents, those that a hash of their id picks with a cycle of their own words from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def turned(words: Column) -> Column:
        count = F.size(words).cast("long")
        start = g % count
        period = 1 + F.floor((count - start) / (3 + g % 8))
        at = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.get(words, at(i))), " ")

    words = F.regexp_extract_all("text", F.lit(words_module.WORD), F.lit(0))
    picked = (h % 10 == 0) & F.coalesce(F.col("text").rlike(words_module.WORD), F.lit(False))
    return docs.select("doc_id", F.when(picked, decontaminate.bound(words, turned)).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """The greatest run and digests of all runs and of the collapsed text."""
    ledger = periodic.run_ledger(with_cycles(docs))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(order)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    found = ledger.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.least")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-1000 * F.col("best.least") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(table(spark, sf_dir, "documents"))


def misspelt(doc_id: object, word: str) -> str:
    """The word without one letter, in one of 199 places that a hash picks."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % 199 else word[: h % len(word)] + word[h % len(word) + 1 :]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), misspelt)


def op13_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_mix_sources": op2_mix_sources,
    "op3_jump_shards": op3_jump_shards,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_token_prefix": op8_token_prefix,
    "op9_huffman_tokens": op9_huffman_tokens,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_groups": op13_embedding_groups,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_mix_sources": f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', CAST(len({_WORDS}) AS VARCHAR))) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM sources),
weighted AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap,
         CAST(3 * source_size AS DOUBLE) / CAST((rank - 1) % 3 + 1 AS DOUBLE) AS dry_at FROM ranked),
tried AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY dry_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY dry_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS try FROM weighted),
level AS (SELECT coalesce(max(try), 0.0) AS level FROM tried WHERE try <= dry_at),
plan AS (SELECT *, least(CAST(cap AS DOUBLE), weight * level) AS target FROM tried, level),
placed AS (
  SELECT d.doc_id, d.key, d.size, p.source_size, p.rank, p.weight, p.target,
         sum(d.size) OVER (PARTITION BY p.rank ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING) AS position
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
copies AS (
  SELECT placed.*, epoch, CAST(epoch * source_size + position AS DOUBLE) / CAST(weight AS DOUBLE) AS finish
  FROM placed, (VALUES (0), (1), (2)) e(epoch)),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) AS served FROM copies WHERE size > 0),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM served WHERE served <= (SELECT sum(size) FROM docs) GROUP BY doc_id)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN taken t ON p.doc_id = t.doc_id
""",
    "op6_url_filter": """
WITH a AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 360 AS INTEGER) AS fetched_on,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 2) AS path FROM pages),
hosts AS (SELECT DISTINCT host, md5(host) AS h FROM a WHERE host <> ''),
addresses AS (SELECT DISTINCT 'u:' || host || path AS key, md5('u:' || host || path) AS h FROM a WHERE host <> ''),
numbers AS (
  SELECT host, CAST('0x' || h[1:4] AS INTEGER) % 240 AS added, CAST('0x' || h[5:8] AS INTEGER) % 3 = 0 AS chosen,
         CAST('0x' || h[9:12] AS INTEGER) % 90 + 1 AS held, regexp_matches(host, 'spam|pills|casino') AS telling FROM hosts),
spans AS (
  SELECT 'h:' || host AS key, 'block' AS verdict, DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to FROM numbers WHERE telling
  UNION ALL SELECT 'h:' || host, 'block', DATE '2024-01-01' + added, DATE '2024-01-01' + added + held FROM numbers WHERE NOT telling AND chosen
  UNION ALL SELECT key, 'allow', DATE '2024-01-01' + CAST('0x' || h[5:8] AS INTEGER) % 360, DATE '9999-12-31' FROM addresses WHERE CAST('0x' || h[1:4] AS INTEGER) % 16 = 0),
keyed AS (
  SELECT page_id, fetched_on, 1 AS whole, len(string_split(host, '.')) AS names, 'u:' || host || path AS key FROM a WHERE host <> ''
  UNION ALL
  SELECT page_id, fetched_on, 0, len(parts) - i + 1, 'h:' || array_to_string(parts[i:], '.')
  FROM (SELECT page_id, fetched_on, string_split(host, '.') AS parts, unnest(range(1, greatest(2, CAST(len(string_split(host, '.')) AS BIGINT)))) AS i FROM a WHERE host <> '')),
best AS (
  SELECT k.page_id, s.verdict, k.key, s.valid_from,
         row_number() OVER (PARTITION BY k.page_id ORDER BY whole DESC, names DESC, k.key DESC, s.verdict = 'block' DESC, s.verdict DESC, s.valid_from DESC) AS r
  FROM keyed k JOIN spans s ON k.key = s.key AND k.fetched_on >= s.valid_from AND k.fetched_on < s.valid_to)
SELECT a.page_id, a.url, CAST(a.fetched_on AS DATE) AS fetched_on, coalesce(b.verdict, 'allow') AS verdict, b.key, CAST(b.valid_from AS DATE) AS valid_from
FROM a LEFT JOIN (SELECT * FROM best WHERE r = 1) b ON a.page_id = b.page_id
""",
    "op10_quality_rules": f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, CAST(len(words) AS BIGINT) - 6)) AS i FROM w)),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dups AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         CAST((length(text) - length(replace(text, '!!', ''))) // 2 AS BIGINT) AS n_shouts
  FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
bits AS (
  SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > n_words AS BIGINT) + 8 * CAST(10 * n_dup_lines > 4 * n_lines AS BIGINT)
    + 16 * CAST(word_chars < 2 * n_words AS BIGINT) + 32 * CAST(word_chars > 20 * n_words AS BIGINT)
    + 64 * CAST(10 * n_shouts > 3 * n_words AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures % 4 <> 0 AS base_failed, failures = 0 AS kept, failures FROM bits
""",
}
