"""One registered query per operator, over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, html, importance, jaccard, licenses, quality, runs, sharding, suffix, tokenfile, warc, whitening
from .shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _registered(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = query
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@_registered()
def op1_shard_lpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


_WORDS = r"list_filter(regexp_split_to_array({t}, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"
_CODE_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_registered(
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format(t="t")} AS ws FROM d),
windows AS (
  SELECT r, i, array_to_string(ws[i + 1 : i + 5], ' ') AS g
  FROM (SELECT r, ws, unnest(range(len(ws) - 4)) AS i FROM w)),
many AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT i + j) AS n FROM many, range(5) AS s(j) GROUP BY r),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')),
line_counts AS (
  SELECT r, sum(k) AS n, sum(k - 1) AS dups, sum(k * len(l)) AS chars, sum((k - 1) * len(l)) AS dup_chars
  FROM (SELECT r, l, count(*) AS k FROM lines GROUP BY r, l) GROUP BY r),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(line_counts.dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(line_counts.n, 0) AS BIGINT) AS n_lines,
         CAST(len(t) - len(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(len(t) - len(regexp_replace(t, '[A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
         CAST(coalesce(line_counts.chars, 0) AS BIGINT) AS line_chars, CAST(coalesce(line_counts.dup_chars, 0) AS BIGINT) AS dup_line_chars
  FROM w LEFT JOIN repeats USING (r) LEFT JOIN line_counts USING (r)),
bits AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 8 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_upper > n_letters THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * dup_line_chars > 30 * line_chars THEN 64 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_letters, line_chars, dup_line_chars, fail_bits,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 111 = 0 AS kept, 4 AS policy
FROM bits
"""
)
def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents")))


def _licence_sql() -> str:
    rows = ",\n".join(f"({i}, '{t.label}', {t.words!r}, {t.key_words!r}, {t.key_at}, {t.base})" for i, t in enumerate(licenses.TEMPLATES))
    return f"""
WITH templates(n, label, words, key_words, key_at, base) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, {_CODE_WORDS.format(t="text")} AS ws FROM d),
firsts AS (SELECT r, ws, unnest(range(len(ws))) AS i FROM w),
places AS (
  SELECT r, label, base, key_at, words, ws, i FROM firsts JOIN templates ON ws[i + 1] = key_words[1]
  WHERE ws[i + 1 : i + len(key_words)] = key_words),
shares AS (
  SELECT r, label, base, i, CAST(len(list_filter(range(len(words)), lambda j: i - key_at + j >= 0 AND coalesce(ws[i - key_at + j + 1] = words[j + 1], false))) AS DOUBLE) / len(words) AS share
  FROM places),
by_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
         array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM shares GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN by_doc USING (r)
"""


@_registered(_licence_sql())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_registered()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bpe.vocabulary(spark, tokenizer_path("byte_bpe_50k.tiktoken"))
    return bpe.encode(_table(spark, sf_dir, "documents"), lines, pattern(), ("n_tokens", "ids_sha256", "decoded_sha256"))


@_registered(
    """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS k FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS starts FROM again),
numbered AS (SELECT doc_id, i, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM spans
  UNION ALL SELECT doc_id, max(e), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (coalesce(b, len(h) // 2) - a) AS BIGINT)), '' ORDER BY a) AS k
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
)
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(_table(spark, sf_dir, "documents"))


@_registered(
    f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS.format(t="t")} AS ws FROM d),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 5], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE common.n * 10 >= 8 * (x.n + y.n - common.n)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, least(a, min(b)) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(class_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN least USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
)
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents")).drop("row")


@_registered()
def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    images = tokenfile.write(_table(spark, sf_dir, "documents"), vocabulary, tokenfile.fresh_path(spark))
    return tokenfile.read_documents(images)


@_registered()
def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


@_registered()
def op9_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    return importance.sample(_table(spark, sf_dir, "documents"), labels, share=importance.label_share(labels))


@_registered(
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, {_CODE_WORDS.format(t="t")} AS ws FROM d),
items AS (SELECT item_id, {_CODE_WORDS.format(t="coalesce(text, '')")} AS ws FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i + 1 : i + 10], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 9, 1))) AS i FROM items WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM phrases),
windows AS (SELECT r, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS g FROM (SELECT r, n, ws, unnest(range(len(ws) - n + 1)) AS i FROM w, lengths)),
hits AS (SELECT r, item_id, i, windows.n FROM windows JOIN phrases ON windows.n = phrases.n AND windows.g = phrases.g),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "utf-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_registered()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.detect(_table(spark, sf_dir, "documents"), change=runs.period_change, keep=())


@_registered(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS n, sha1(h) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x, n) AS m FROM s)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)]), '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM f
"""
)
def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.fresh_path(spark)
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_registered()
def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))
