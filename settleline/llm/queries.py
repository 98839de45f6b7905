"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, extract, langid, linededup, packing, pii, quality, ranked, simhash, substring, urlfilter, warc
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of_documents(read_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(read_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def page_captures(pages: DataFrame) -> DataFrame:
    """``page_id, url, fetch_time``: pages have no fetch time of their own, so ids are spread over 90 days of 2024."""
    second = F.pmod(F.col("page_id") * 7919, F.lit(90 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("fetch_time"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Add and remove events of lists that name hosts of ``pages``; a host's hash decides which and when."""
    host = urlfilter.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).where("host <> ''").distinct().withColumn(
        "v", F.conv(F.substring(F.md5("host"), 1, 8), 16, 10).cast("long"))

    def day(n: F.Column) -> F.Column:
        return F.timestamp_seconds(F.lit(1704067200) + n * 86400)

    start = F.pmod(F.floor(F.col("v") / 7), F.lit(30))

    def entry(which: F.Column, name: str, action: str, kind: str, key: F.Column, event: str, at: F.Column) -> F.Column:
        return F.when(which, F.struct(F.lit(name).alias("list_name"), F.lit(action).alias("action"), F.lit(kind).alias("kind"),
                                      key.alias("key"), F.lit(event).alias("event"), at.alias("at")))

    v, name = F.col("v"), F.col("host")
    events = F.array(
        entry(v % 7 == 0, "spam", "block", "host", name, "add", day(start)),
        entry(v % 14 == 0, "spam", "block", "host", name, "remove", day(start + 20)),
        entry(v % 28 == 0, "spam", "block", "host", name, "add", day(start + 30)),
        entry(v % 11 == 0, "adult", "block", "domain", name, "add", day(start + 5)),
        entry(v % 5 == 0, "mixed", "block", "prefix", F.concat(name, F.lit("/en/")), "add", day(start + 10)),
        entry(v % 10 == 0, "curated", "allow", "prefix", F.concat(name, F.lit("/de/")), "add", day(start)),
        entry(v % 20 == 0, "curated", "allow", "prefix", F.concat(name, F.lit("/de/")), "remove", day(start + 45)))
    return hosts.select(F.explode(events).alias("e")).where("e IS NOT NULL").select("e.*")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    out = urlfilter.filter_captures(page_captures(pages), dated_lists(pages))
    text = "yyyy-MM-dd HH:mm:ss"
    return out.select("page_id", "url", F.date_format("fetch_time", text).alias("fetch_time"), "kept", "list_name", "kind", "key",
                      F.date_format("valid_from", text).alias("valid_from"), F.date_format("valid_to", text).alias("valid_to"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.without_repeated_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_removed")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "fetch_time", "place")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read_table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters_with_inertia(read_table(spark, sf_dir, "embeddings"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_substring_dedup, op3_best_fit_packing, op4_url_filter, op5_line_dedup, op6_decontamination,
    op7_quality_rules, op8_simhash, op9_warc, op10_html_extraction, op11_ranked_search, op12_centroids, op13_pii)}

#: The same filter by comparing every capture with every interval.
OP4_SQL = r"""
WITH caps AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 7919) % (90 * 86400)) AS ft,
         regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.|\.$', '', 'g') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
hosts AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 8))::BIGINT AS v FROM caps WHERE host <> ''),
starts AS (SELECT host, v, (v // 7) % 30 AS d FROM hosts),
events AS (
  SELECT 'spam' AS list_name, 'block' AS action, 'host' AS kind, host AS key, 'add' AS event, d AS day FROM starts WHERE v % 7 = 0
  UNION ALL SELECT 'spam', 'block', 'host', host, 'remove', d + 20 FROM starts WHERE v % 14 = 0
  UNION ALL SELECT 'spam', 'block', 'host', host, 'add', d + 30 FROM starts WHERE v % 28 = 0
  UNION ALL SELECT 'adult', 'block', 'domain', host, 'add', d + 5 FROM starts WHERE v % 11 = 0
  UNION ALL SELECT 'mixed', 'block', 'prefix', host || '/en/', 'add', d + 10 FROM starts WHERE v % 5 = 0
  UNION ALL SELECT 'curated', 'allow', 'prefix', host || '/de/', 'add', d FROM starts WHERE v % 10 = 0
  UNION ALL SELECT 'curated', 'allow', 'prefix', host || '/de/', 'remove', d + 45 FROM starts WHERE v % 20 = 0),
spans AS (
  SELECT list_name, action, kind, key, event, TIMESTAMP '2024-01-01 00:00:00' + to_days(day::INTEGER) AS f,
         lead(TIMESTAMP '2024-01-01 00:00:00' + to_days(day::INTEGER)) OVER (PARTITION BY list_name, action, kind, key ORDER BY day) AS t
  FROM events),
met AS (
  SELECT c.page_id, c.url, c.ft, s.*, row_number() OVER (
           PARTITION BY c.page_id, c.url
           ORDER BY CASE kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(key) DESC, action, list_name, key, f) AS n
  FROM caps c JOIN spans s ON s.event = 'add' AND s.f <= c.ft AND (s.t IS NULL OR c.ft < s.t) AND CASE kind
    WHEN 'host' THEN c.host = key
    WHEN 'domain' THEN c.host = key OR ends_with(c.host, '.' || key)
    ELSE c.host || c.path = key OR (ends_with(key, '/') AND starts_with(c.host || c.path, key)) END)
SELECT c.page_id, c.url, strftime(c.ft, '%Y-%m-%d %H:%M:%S') AS fetch_time, coalesce(m.action <> 'block', true) AS kept,
       m.list_name, m.kind, m.key, strftime(m.f, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(m.t, '%Y-%m-%d %H:%M:%S') AS valid_to
FROM caps c LEFT JOIN met m ON m.n = 1 AND m.page_id = c.page_id AND m.url = c.url
"""

#: What the round trip must give, straight from the pages.
OP9_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest,
         regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host,
         regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^#]*)', 1) AS rest
  FROM pages),
firsts AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END AS url_key,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS fetch_time,
       row_number() OVER (ORDER BY url_key, fetch_time, page_id) - 1 AS place
FROM p LEFT JOIN firsts USING (digest)
"""

#: The scores from a row for each (item, document, shared term).
OP11_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
item_terms AS (
  SELECT i, item_id, unnest(list_distinct(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
lengths AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM doc_terms WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc_terms) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term) CROSS JOIN totals),
parts AS (
  SELECT i, item_id, l.doc_id, r, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS part
  FROM item_terms JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths l USING (r) CROSS JOIN totals),
scores AS (SELECT i, item_id, doc_id, r, sum(part)::BIGINT AS score FROM parts GROUP BY i, item_id, doc_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS n, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, n::INTEGER AS rank, doc_id, score FROM ranked WHERE n <= 10
"""

_OP12_ROUND = r"""
near{k} AS (
  SELECT v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT p.v, q.c, sum((p.x - q.x) * (p.x - q.x))::BIGINT AS d FROM parts p JOIN centre{k} q USING (pos) GROUP BY p.v, q.c)
  GROUP BY v)"""

_OP12_MOVE = r"""
moved{k} AS (
  SELECT c, pos, ((s - ((s % n) + n) % n) // n)::BIGINT AS x
  FROM (SELECT c, pos, sum(x) AS s, count(*) AS n FROM parts JOIN near{k} USING (v) GROUP BY c, pos)),
centre{next} AS (SELECT c, pos, coalesce(m.x, o.x) AS x FROM centre{k} o LEFT JOIN moved{k} m USING (c, pos))"""

#: All distances, in three rounds and once more.
OP12_SQL = r"""
WITH kept AS (
  SELECT row_number() OVER () AS v, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS xs
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT v, unnest(xs) AS x, unnest(range(64)) AS pos FROM kept),
seeds AS (
  SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), xs) - 1 AS c
  FROM kept WHERE vec_id IS NOT NULL QUALIFY c < 16),
centre0 AS (SELECT c, pos, x FROM parts JOIN seeds USING (v)),""" + ",".join(
    _OP12_ROUND.format(k=k) + ("," + _OP12_MOVE.format(k=k, next=k + 1) if k < 3 else "") for k in range(4)) + r""",
inertias AS (SELECT c, sum(d)::BIGINT AS own, sum(sum(d)) OVER ()::BIGINT AS total FROM near3 GROUP BY c),
hashes AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS h FROM centre3 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, own AS cluster_inertia, total AS inertia, h AS centroid_sha256
FROM near3 JOIN kept USING (v) JOIN inertias USING (c) JOIN hashes USING (c)
"""

ORACLE_SQL: dict[str, str] = {"op4_url_filter": OP4_SQL, "op9_warc": OP9_SQL, "op11_ranked_search": OP11_SQL, "op12_centroids": OP12_SQL}
