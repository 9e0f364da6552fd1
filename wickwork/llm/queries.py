"""The operators as queries over the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork.llm import (
    decontaminate,
    hard_negatives,
    html_extract,
    licenses,
    near_dup,
    packing,
    periodic_runs,
    quality,
    secrets,
    sharding,
    substring_dedup,
    token_counts,
    url_rules,
)
from wickwork.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# CRC-32 by its byte table, which is made from the polynomial; shards by the exact order.
_SHARD_SQL = """
WITH tab AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(b))
),
d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (
  SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i : i + 1] AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, tab
),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST((2 * before + size) * 16 // (2 * total) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


@query("op1_sharding", _SHARD_SQL)
def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(docs, 16, key="doc_id", size="size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op2_token_counts")
def token_count_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.context_limits(token_counts.length_histogram(lengths))


@query("op3_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"), "page_id", "url")


_QUALITY_SQL = """
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, lang, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS pos, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, ws[pos], ws[pos + 1], ws[pos + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS q FROM g WHERE n > 1) GROUP BY doc_id),
c AS (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)
),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1000 * n_symbols // greatest(n_words, 1) AS symbol_rate, 1000 * n_capitals // greatest(word_chars, 1) AS capital_rate,
    1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_rate, 1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate
  FROM c
),
u AS (UNPIVOT (SELECT lang, source, symbol_rate, capital_rate, dup_line_rate, repeat_rate FROM m WHERE NOT base_failed)
  ON symbol_rate, capital_rate, dup_line_rate, repeat_rate INTO NAME measure VALUE v),
b AS (SELECT lang, source, measure, greatest(length(bin(v)) - 5, 0) AS s, v FROM u),
f AS (SELECT lang, source, measure, (v >> s) << s AS low FROM b),
lv AS (
  SELECT 1 AS level, lang, source, measure, low FROM f
  UNION ALL SELECT 2, lang, '', measure, low FROM f
  UNION ALL SELECT 3, '', '', measure, low FROM f
),
k AS (
  SELECT *, count(*) OVER (PARTITION BY level, lang, source, measure) AS docs,
    count(*) OVER (PARTITION BY level, lang, source, measure ORDER BY low) AS up_to FROM lv
),
q AS (
  SELECT level, lang, source, measure, any_value(docs) AS docs, min(low) FILTER (4 * up_to >= docs) AS q1,
    min(low) FILTER (4 * up_to >= 3 * docs) AS q3 FROM k GROUP BY ALL
),
t AS (
  SELECT level, lang, source, any_value(docs) AS docs,
    max(4 * q3 - 3 * q1 + 100) FILTER (measure = 'symbol_rate') AS symbol_limit,
    max(4 * q3 - 3 * q1 + 100) FILTER (measure = 'capital_rate') AS capital_limit,
    max(4 * q3 - 3 * q1 + 500) FILTER (measure = 'dup_line_rate') AS dup_limit,
    max(4 * q3 - 3 * q1 + 350) FILTER (measure = 'repeat_rate') AS repeat_limit
  FROM q GROUP BY ALL
),
x AS (
  SELECT m.*, coalesce(t1.docs, 0) >= 50 AS own, coalesce(t2.docs, 0) >= 50 AS broad,
    CASE WHEN own THEN t1 WHEN broad THEN t2 ELSE t3 END AS l
  FROM m LEFT JOIN t AS t1 ON t1.level = 1 AND t1.lang = m.lang AND t1.source = m.source
  LEFT JOIN t AS t2 ON t2.level = 2 AND t2.lang = m.lang LEFT JOIN t AS t3 ON t3.level = 3
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND symbol_rate <= l.symbol_limit AND capital_rate <= l.capital_limit AND dup_line_rate <= l.dup_limit
    AND repeat_rate <= l.repeat_limit AS kept
FROM x
"""


@query("op4_quality_rules", _QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(quality.measure(read_table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.col("phrases.label")))
    every = F.array_sort(F.array_union(F.col("phrases.label"), F.col("spans.label")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.first").cast("long").alias("first_word"),
        F.array_max("phrases.first").cast("long").alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"),
        F.concat_ws(",", every).alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.covered"), F.lit(0.0))).alias("score"),
        "spans",
    )


_ITEM_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), il AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM i WHERE len(ws) > 0),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[p : p + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM il)
), ks AS (SELECT DISTINCT k FROM il),
dw AS (
  SELECT doc_id, k, p, array_to_string(ws[p : p + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, ks WHERE len(ws) >= k)
), hit AS (SELECT doc_id, dw.k, p, item_id FROM dw JOIN iw USING (k, w)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op6_decontamination", _ITEM_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.n_hit(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query("op7_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


# All pairs that share a shingle, and what is reachable over links.
_NEAR_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda p: ws[p] || ' ' || ws[p + 1]) END) AS shingle FROM d
),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
),
l AS (
  SELECT a, b FROM p JOIN c AS x ON x.doc_id = a JOIN c AS y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d LEFT JOIN c USING (doc_id) JOIN m USING (doc_id)
"""


@query("op8_minhash_near_dedup", _NEAR_SQL)
def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op9_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


# All windows of 35 words.
_REPEAT_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
w AS (
  SELECT k, p, md5(array_to_string(ws[p : p + 34], ' ')) AS h FROM (SELECT k, ws, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35)
),
t AS (SELECT k, p FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
x AS (SELECT k, list(DISTINCT q) AS gone FROM (SELECT k, unnest(range(p, p + 35)) AS q FROM t) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ')
    ELSE coalesce((SELECT string_agg(ws[q], ' ' ORDER BY q) FROM (SELECT unnest(range(1, len(ws) + 1)) AS q) AS i WHERE NOT list_contains(gone, q)), '') END) AS kept_sha256
FROM d LEFT JOIN x USING (k)
"""


@query("op10_substring_dedup", _REPEAT_SQL)
def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# Scores of all anchors with all rows; windows by the positives' scores.
_NEGATIVE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_inner_product(a.x, o.x) AS BIGINT) AS score
  FROM r AS a JOIN r AS o ON a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 80 * positive_score AND 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op11_hard_negatives", _NEGATIVE_SQL)
def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A null or non-finite component stays one, so that the operator leaves its row out.
    endless = lambda v: F.isnan(v) | (F.abs(v) == float("inf"))
    whole = F.transform("embedding", lambda v: F.when(endless(v), v.cast("double")).otherwise(F.floor(256 * v.cast("double")).cast("double")))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), whole.alias("embedding"))
    found = hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
    scores = [F.col(c).cast("long").alias(c) for c in ("positive_score", "negative_score")]
    return found.select("anchor_id", "positive_id", "rank", "negative_id", *scores)


# The rules of the contract, as verdict, host and path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
_RULE_ROWS = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)

_URL_SQL = f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
r(v, h, p) AS (VALUES {_RULE_ROWS}),
k AS (SELECT DISTINCT host, path FROM u),
b AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM k JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN b USING (host, path)
"""


@query("op12_url_filters", _URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS r(verdict, host, path)")
    judged = url_rules.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op13_periodic_runs")
def periodic_run_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs.find_runs(periodic_runs.repeat_tail(docs, seed))
    start, length, period = (F.col("greatest")[c] for c in ("start", "length", "period"))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
