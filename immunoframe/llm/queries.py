"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, divergence, fim, gru_lm, licenses, main_text, ngram_join, quality, sharding, toxicity, url_filter, warc
from .common import table

#: (verdict, host, path) of the registered URL query.
URL_RULES = [
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
]
SHARDS = 24


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", SHARDS)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score_documents(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_url_filter, op3_sharding, op4_lm_scoring, op5_decontamination, op6_quality_rules, op7_license_scan,
        op8_ngram_jaccard_join, op9_warc, op10_bpe, op11_main_text, op12_source_divergence, op13_fill_in_middle)}


OP2_SQL = """
WITH part AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
  ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
best AS (
  SELECT page_id, arg_max({'rule': h || p, 'verdict': verdict}, (length(h) + length(p)) * 1000 + length(h)) AS won
  FROM part, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict
FROM part LEFT JOIN best USING (page_id)
"""

OP3_SQL = """
WITH tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
doc AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE octet_length(encode(text)) END AS bytes, regexp_extract_all(hex(encode(text)), '..') AS hx FROM documents),
crc AS (
  SELECT doc_id, bytes + 8 AS size, CASE WHEN text IS NOT NULL THEN
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(hx, lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) END AS text_crc32
  FROM doc, tab),
bids AS (
  SELECT doc_id, s AS shard, ('0x' || substr(md5(doc_id || ':' || s), 1, 13))::BIGINT AS draw FROM documents, range(25) r(s)),
own AS (
  SELECT doc_id, arg_max(shard, (draw, shard)) FILTER (shard < 24) AS shard, arg_max(shard, (draw, shard)) AS grown_shard FROM bids GROUP BY doc_id),
n AS (SELECT greatest(8, ceil(count(*) / 480000.0)::BIGINT) AS buckets FROM documents)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % buckets, doc_id) - 1 AS slot,
  grown_shard::INT AS grown_shard
FROM crc JOIN own USING (doc_id), n
"""

OP5_SQL = r"""
WITH doc AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
it AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
sized AS (SELECT item_id, least(5, len(w)) AS k, w FROM it WHERE len(w) > 0),
item_sh AS (
  SELECT item_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS s FROM sized),
doc_sh AS (
  SELECT doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS s
  FROM doc, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k),
n AS (SELECT item_id, count(*) AS n_item FROM item_sh GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM doc_sh JOIN item_sh USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, round(n_shared / n_item, 6) AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""

OP7_SQL = r"""
WITH tpl(license_id, x) AS (VALUES """ + ", ".join(
    "('{}', '{}')".format(i, t.replace("'", "''")) for i in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[i]) + r"""),
tw AS (SELECT row_number() OVER () AS t, license_id, list_filter(string_split_regex(lower(x), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM tpl),
tg AS (SELECT t, license_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw),
tm AS (SELECT t, license_id, len(g) AS m, ceil(len(g) * 0.8 / 1.2 - 1e-9)::INT AS need, floor(len(g) * 1.2 / 0.8 + 1e-9)::INT AS reach, unnest(g) AS gram FROM tg),
dw AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
dg AS (SELECT r, doc_id, unnest(range(0, len(w) - 1)) AS "at", unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM dw WHERE len(w) > 1),
hit AS (SELECT r, doc_id, t, license_id, m, reach, need, "at", gram, lag("at") OVER (PARTITION BY r, t, gram ORDER BY "at") AS before FROM dg JOIN tm USING (gram)),
able AS (SELECT r, t FROM hit GROUP BY r, t HAVING count(DISTINCT gram) >= any_value(need)),
own AS (SELECT hit.* FROM hit SEMI JOIN able USING (r, t)),
span AS (
  SELECT a.r, a.doc_id, a.t, a.license_id, a.m, a."at" AS s, b."at" AS e, sum(CASE WHEN b.before IS NULL OR b.before < a."at" THEN 1 ELSE 0 END) OVER w AS c, count(*) OVER w AS k
  FROM own a JOIN own b ON a.r = b.r AND a.t = b.t AND b."at" >= a."at" AND b."at" < a."at" + a.reach WINDOW w AS (PARTITION BY a.r, a.t, a."at" ORDER BY b."at")),
good AS (SELECT *, round(2.0 * c / (e - s + 1 - k + c + m), 6)::DOUBLE AS dice FROM span),
best AS (
  SELECT r, doc_id, s, e - s + 2 AS n, license_id, dice FROM good WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY r, s ORDER BY dice DESC, e DESC, license_id) = 1)
SELECT doc_id, license_id, s::INT AS start, n::INT AS n_words, dice FROM best a
WHERE NOT EXISTS (
  SELECT 1 FROM best b WHERE a.r = b.r AND a.s < b.s + b.n AND b.s < a.s + a.n
  AND (b.dice > a.dice OR b.dice = a.dice AND (b.n > a.n OR b.n = a.n AND b.s < a.s)))
"""

#: Base 32 of the hex digest: five bits at a time.
OP9_SQL = """
WITH page AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hx FROM pages),
last AS (SELECT hx, max(page_id) AS response_id FROM page GROUP BY hx),
bits AS (
  SELECT hx, array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(('0x' || substr(hx, i::BIGINT, 1))::INT), 4)), '') AS b FROM last),
b32 AS (
  SELECT hx, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_reduce(list_transform(range(0, 5), lambda j: substr(b, (1 + 5 * i + j)::BIGINT, 1)::INT), lambda x, y: 2 * x + y), 1)), '') AS payload_digest FROM bits)
SELECT page_id, n AS payload_bytes, payload_digest,
  CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response_id THEN response_id END AS refers_to
FROM page JOIN last USING (hx) JOIN b32 USING (hx)
"""


#: For pages that name their article and hold only headings, paragraphs, line breaks and bold text in it, as those given do.
OP11_SQL = r"""
WITH own AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS h FROM pages),
plain AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<(/?p|br|/?h1)>', ' ', 'g') AS h FROM own),
said AS (SELECT page_id, url, replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS h FROM plain),
done AS (SELECT page_id, url, trim(regexp_replace(h, '\s+', ' ', 'g')) AS text FROM said)
SELECT page_id, url, text, length(text) AS n_chars FROM done
"""

OP12_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tok AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT DISTINCT lang, source FROM doc),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
tot AS (SELECT lang, source, sum(n) AS t FROM cnt GROUP BY lang, source),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.t, 0) + 5 * v.v) AS p
  FROM grp g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
base AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(w.t) + 5 * any_value(v.v)) AS q
  FROM cnt JOIN (SELECT lang, sum(t) AS t FROM tot GROUP BY lang) w USING (lang) JOIN v USING (lang) GROUP BY lang, term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM cell JOIN base USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP13_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
dealt AS (
  SELECT doc_id, t, u, len(u) AS n, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
    ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
    ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 AS spm FROM doc),
parts AS (
  SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, t, array_to_string(u[1:least(c1, c2)], '') AS p,
    array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM dealt)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": OP2_SQL, "op3_sharding": OP3_SQL, "op5_decontamination": OP5_SQL, "op7_license_scan": OP7_SQL, "op9_warc": OP9_SQL,
        "op11_main_text": OP11_SQL, "op12_source_divergence": OP12_SQL, "op13_fill_in_middle": OP13_SQL,
    }
