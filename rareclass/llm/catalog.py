"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html, lexical, linedups, mixing, repeats, sharding, simhash, tokens, topk, toxicity, vectorcodes, warc
from .common import table

# The mix of the contract: sources take these weights in turn and share 150 % of all sizes; no source beyond twice.
MIX = {"weights": [3, 1, 2], "share": 1.5, "max_repeat": 2.0}
SHARDS = 24


def op1_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"), **MIX)


def op4_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"), SHARDS)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op8_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_digest(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.codes_digest(table(spark, sf_dir, "embeddings"))


def op13_drop_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedups.line_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_remove_repeats, op2_top_products, op3_mix_sources, op4_shuffle_shards, op5_toxicity, op6_decontaminate, op7_simhash, op8_extract_pages, op9_token_counts, op10_warc_round_trip,
        op11_ranked_search, op12_vector_codes, op13_drop_repeated_lines,
    )
    return {f.__name__: f for f in found}


OP2_SQL = """
WITH e AS (SELECT vec_id, UNNEST(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL),
spoilt AS (SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM e WHERE vec_id NOT IN (SELECT vec_id FROM spoilt)),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id AS vec_id, CAST(SUM(q.c * o.c) AS BIGINT) AS score
  FROM v q JOIN v o ON q.i = o.i AND q.vec_id % 50 = 0 AND o.vec_id <> q.vec_id GROUP BY q.vec_id, o.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""

OP3_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
    2.0::DOUBLE * source_size AS cap FROM by_source),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap <= level * weight THEN cap ELSE max(CASE WHEN cap > level * weight THEN level END) OVER () * weight END AS target
  FROM levels),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS r,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size * 16777216) AS BIGINT) ELSE 0 END AS rate,
    CAST('0x' || substr(md5('42#' || coalesce(s.source, '<null>')), 1, 6) AS BIGINT) AS shift
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, CAST(((shift + rate * (r + 1)) >> 24) - ((shift + rate * r) >> 24) AS BIGINT) AS copies FROM ranked)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM taken
"""


OP10_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, url
FROM f
"""


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT row, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
facts AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM held),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM held) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weighed AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM asked JOIN df USING (term), facts),
scores AS (
  SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // occurrences)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN held USING (row), facts GROUP BY item_id, doc_id, row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""


def _op12_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Six rounds written out: nearest entries (a), then the entries' new components (c)."""
    near = """a{0} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT vec_id, label, v.p, v.x, e, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v JOIN c{0} c ON v.p = c.p) GROUP BY vec_id, label, p)"""
    move = """c{1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{0} c LEFT JOIN (
    SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
      SELECT p, best.e AS e, i, CAST(sum(y) AS DOUBLE) AS s, count(*) AS n
      FROM (SELECT p, best, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{0}) GROUP BY p, best.e, i) GROUP BY p, e) m
  ON c.p = m.p AND c.e = m.e)"""
    steps = [s for r in range(rounds) for s in (near.format(r), move.format(r, r + 1))] + [near.format(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor(4096 * CAST(y AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, CAST(p AS BIGINT) AS p, w[p * len(w) // {parts} + 1:(p + 1) * len(w) // {parts}] AS x FROM kept, range({parts}) r(p)),
c0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM v) WHERE e < {entries}),
{", ".join(steps)},
f AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f, b
"""


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY row, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_top_products": OP2_SQL, "op3_mix_sources": OP3_SQL, "op10_warc_round_trip": OP10_SQL,
        "op11_ranked_search": OP11_SQL, "op12_vector_codes": _op12_sql(), "op13_drop_repeated_lines": OP13_SQL,
    }
