"""The subpackage's queries and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, codes, decontaminate, extraction, lines, neighbours, packing, pii, quality, secrets, simhash, urls, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: The rules that ``pages`` is judged by: (host, path, verdict).
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(repr, URL_RULES)) + " AS t(host, path, verdict)")
    return urls.judge(_table(spark, sf_dir, "pages"), rules)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_html_extraction,
        op3_line_dedup,
        op4_warc,
        op5_nearest_neighbours,
        op6_best_fit_packing,
        op7_simhash_near_dedup,
        op8_secret_scan,
        op9_pii,
        op10_decontamination,
        op11_url_filter,
        op12_filter_audit,
        op13_vector_codes,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = rf"""
WITH bw AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, len(w[s:s + 9]) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM bw WHERE len(w) > 0)
),
dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
placed AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM dw, sizes WHERE len(w) >= n),
hits AS (SELECT DISTINCT a.doc_id, a.s, a.n, b.item_id FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM placed) a JOIN wins b ON a.win = b.win AND a.n = b.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(m.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(m.items, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM dw d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id
"""

OP4_SQL = """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, url, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""

OP11_SQL = rf"""
WITH p AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(h, p, v) AS (VALUES {", ".join(map(repr, URL_RULES))}),
fit AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict FROM (SELECT DISTINCT host, path FROM s), r
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, s.host, s.path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN fit ON s.host = fit.host AND s.path = fit.path
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
flags AS (SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM flags LEFT JOIN l ON flags.doc_id = l.doc_id GROUP BY ALL),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
orders AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
long AS (SELECT *, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, f[o[step]] AS fails, len(list_filter(o[1:step - 1], lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda b: b)) AS failed
  FROM m, orders, (SELECT x AS step FROM k)),
steps AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS name, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost FROM long GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, name))::BIGINT AS shapley FROM steps
"""


def _op13_sql() -> str:
    """The rounds written out: assign every part to its nearest entry, then move the entries."""
    near = lambda r: f"near{r} AS MATERIALIZED (SELECT id, part, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (SELECT v.id, v.part, b.e, list_sum(list_transform(list_zip(v.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v JOIN book{r} b ON v.part = b.part) GROUP BY id, part)"
    book = lambda r: f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
  SELECT part, e, list(x ORDER BY pos) AS c FROM (SELECT part, e, pos, CASE WHEN sum(x) < 0 THEN -((-sum(x) + count(*) - 1) // count(*)) ELSE sum(x) // count(*) END::BIGINT AS x
    FROM (SELECT n.part, n.e, unnest(v.c) AS x, generate_subscripts(v.c, 1) AS pos FROM near{r} n JOIN v ON n.id = v.id AND n.part = v.part) GROUP BY part, e, pos) GROUP BY part, e) m ON b.part = m.part AND b.e = m.e)"""  # noqa: E731
    rounds = ",\n".join(f"{near(r)},\n{book(r)}" for r in range(codes.ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c, row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT id, place, part, c[part * len(c) // 4 + 1:(part + 1) * len(c) // 4] AS c FROM kept, generate_series(0, 3) AS g(part)),
book0 AS MATERIALIZED (SELECT part, place AS e, c FROM v WHERE place < 256),
{rounds},
{near(codes.ROUNDS)},
coded AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{codes.ROUNDS} GROUP BY id),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS digest FROM book{codes.ROUNDS})
SELECT kept.id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256 FROM kept JOIN coded ON kept.id = coded.id, books
"""


def _spans_of(kind: str, order: int, pattern: str, ok: str) -> str:
    """SQL: the matches of one kind that pass, with where they start; ``t`` is (doc_id, t)."""
    return rf"""SELECT doc_id, '{kind}' AS kind, {order} AS ord, (sum(gap + before) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS lo, said FROM (
  SELECT doc_id, i, m[i] AS said, length(g[i]) AS gap, CASE WHEN i > 1 THEN length(m[i - 1]) ELSE 0 END AS before FROM (SELECT doc_id, m, g, unnest(generate_series(1, len(m))) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM t))) QUALIFY {ok}"""


_DIGITS = "regexp_replace(said, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda x, i: CASE WHEN i % 2 = 0 THEN 2 * x::INT - CASE WHEN x::INT > 4 THEN 9 ELSE 0 END ELSE x::INT END)) % 10 = 0"
_PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(said, '.'), lambda x: length(ltrim(x, '0')) > 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15"),
)
#: The base spans; on the given tables the method adds none (planted ones are in the tests).
OP9_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
e AS ({" UNION ALL ".join(_spans_of(kind, k, pattern, ok) for k, (kind, pattern, ok) in enumerate(_PII))}),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in _PII)}, string_agg(kind || ':' || lo || ':' || (lo + length(said)), ',' ORDER BY lo, ord) AS spans FROM e GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, *_ in _PII)}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN a ON t.doc_id = a.doc_id
"""

ORACLE_SQL = {"op4_warc": OP4_SQL, "op9_pii": OP9_SQL, "op10_decontamination": OP10_SQL, "op11_url_filter": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": _op13_sql()}
