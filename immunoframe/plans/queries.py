"""Queries over the driver's tables, and the SQL that must give the same rows.

The tables hold no sequences, so synthetic ones are made from keys: the hex digits of md5 read as
bases. Columns of these views are written once, in expressions that both engines read alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import anchors, barcodes, clones, consensus, filters, groups, runmeta, spatial, vdj

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dna(key: str) -> str:
    """32 bases from a key, for either engine."""
    return f"translate(md5(CAST({key} AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


READS = {
    "read_id": "event_id", "read_ord": "event_id", "user_id": "user_id",
    "true_spbc": f"substr({dna('user_id')}, 1, 16)",
    "obs": f"CASE WHEN event_id % 5 = 0 THEN 'A' || substr({dna('user_id')}, 2, 15) WHEN event_id % 5 = 1 THEN 'AC' || substr({dna('user_id')}, 3, 14) "
           f"WHEN event_id % 5 = 2 THEN 'N' || substr({dna('user_id')}, 2, 15) ELSE substr({dna('user_id')}, 1, 16) END",
    "umi": f"substr({dna('user_id * 7 + event_id % 3')}, 1, 12)", "quality": "md5(CAST(event_id AS STRING))",
    "sequence": f"substr({dna('user_id')} || {dna('event_id')}, 1, CAST(20 + event_id % 45 AS INT))",
}
AIRR = {
    "sequence_id": "'seq' || CAST(event_id AS STRING)", "productive": "(event_id % 5 <> 0)",
    "locus": "CASE event_id % 4 WHEN 0 THEN 'IGH' WHEN 1 THEN 'IGK' WHEN 2 THEN 'TRB' ELSE 'IGH' END",
    "v_call": "CASE WHEN event_id % 4 = 2 THEN 'TRBV' ELSE 'IGHV' END || CAST(user_id % 7 + 1 AS STRING) || '*01'",
    "j_call": "'IGHJ' || CAST(user_id % 3 + 1 AS STRING) || '*01'",
    "c_call": "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'IGHM' WHEN 2 THEN 'IGHG1' WHEN 3 THEN 'IGHA1,IGHA2' WHEN 4 THEN 'TRBC1' ELSE 'IGHG1*02' END",
    "umi": f"CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'TTTTTTTTTTTT' ELSE substr({dna('event_id')}, 1, 12) END",
    "junction": f"CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'TGTNNN' ELSE substr({dna('user_id')}, 1, 24) END",
    "consensus_count": "event_id % 9", "x": "CAST(user_id * 13 % 200 AS INT)", "y": "CAST(event_id % 97 AS INT)",
    "spbcid": "'s_002um_' || lpad(CAST(user_id * 13 % 200 AS STRING), 5, '0') || '_' || lpad(CAST(event_id % 97 AS STRING), 5, '0') || '-1'",
    "clone_id": "CASE WHEN user_id % 23 = 0 THEN NULL ELSE 'c' || CAST(user_id % 40 AS STRING) END", "value": "value", "event_id": "event_id",
}
MAPPING = {
    "square_002um": AIRR["spbcid"],
    "square_016um": "'s_016um_' || lpad(CAST(CAST(floor((user_id * 13 % 200) / 8.0) AS INT) AS STRING), 5, '0') || '_' || lpad(CAST(CAST(floor((event_id % 97) / 8.0) AS INT) AS STRING), 5, '0')",
    "cell_id": "CASE WHEN (user_id * 13 % 200 + event_id % 97) % 7 = 0 THEN 'cellid_000000000' ELSE 'cellid_' || lpad(CAST((user_id * 13 % 200) * 5 + (event_id % 97) % 5 AS STRING), 9, '0') || '-1' END",
    "in_cell": "((user_id * 13 % 200 + event_id % 97) % 3 <> 0)",
}
ORDERS = {
    "run_id": "CAST(o_custkey % 5 AS STRING)", "status": "o_orderstatus", "priority": "o_orderpriority", "price": "o_totalprice", "o_orderkey": "o_orderkey", "o_custkey": "o_custkey",
}


def view(spark: SparkSession, sf_dir: str, columns: dict[str, str], source: str = "events") -> DataFrame:
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def _cte(name: str, columns: dict[str, str], source: str = "events", distinct: bool = False) -> str:
    return f"{name} AS (SELECT {'DISTINCT ' if distinct else ''}{', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source})"


R, A, M = _cte("reads", READS), _cte("airr", AIRR), _cte("mapping", MAPPING, distinct=True)
WHITE = f"white AS (SELECT DISTINCT substr({dna('user_id')}, 1, 16) AS spbc, CAST(user_id % 100 AS INT) AS x, CAST(user_id % 77 AS INT) AS y FROM events WHERE user_id % 3 <> 0)"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, READS)


def airr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, AIRR)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, MAPPING).distinct()


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").where("user_id % 3 <> 0")
    return own.selectExpr(f"substr({dna('user_id')}, 1, 16) AS spbc", "CAST(user_id % 100 AS INT) AS x", "CAST(user_id % 77 AS INT) AS y").distinct()


# --- groups ----------------------------------------------------------------------------------------------

@query("""
WITH d AS (SELECT doc_id, source || '|' || lang AS grp, length(text) AS len FROM documents),
b AS (SELECT grp, (len // 100) * 100 AS bin, count(*) AS k, min(doc_id) AS f FROM d GROUP BY ALL),
p AS (SELECT grp, sum(k)::BIGINT AS n_orig, arg_max(bin, (k, -f)) AS peak FROM b GROUP BY grp),
m AS (SELECT d.*, n_orig, n_orig < 5 OR len BETWEEN greatest(1, round_even(peak + 50 - 0.10 * (peak + 50), 0)) AND round_even(peak + 50 + 0.10 * (peak + 50), 0) AS kept FROM d JOIN p USING (grp)),
k AS (SELECT grp, count(*) AS n_keep FROM m WHERE kept GROUP BY grp)
SELECT doc_id, grp, len, n_orig, kept, coalesce(n_keep, 0) AS n_keep FROM m LEFT JOIN k USING (grp)
""")
def adaptive_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("|", "source", "lang").alias("grp"), F.length("text").cast("long").alias("len"))
    return groups.adaptive_filter(d, "grp", "len", "doc_id", 100, 0.10, 5)


@query(f"""WITH {R}, s AS (SELECT user_id, read_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('1|' || read_id), read_id) AS k FROM reads)
SELECT user_id, read_id FROM s WHERE k <= 3""")
def group_subsample(spark, sf_dir):
    return groups.subsample(reads(spark, sf_dir).select("user_id", "read_id"), "user_id", 3, "read_id", 1)


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_reads(spark, sf_dir):
    return groups.first_of_each(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], "doc_id")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, arg_max(event_type, (n, event_type)) AS event_type, max(n) AS event_type_n FROM c GROUP BY user_id""")
def majority_vote(spark, sf_dir):
    return consensus.majority(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(f"""WITH {R}, a AS (SELECT user_id, substr(obs, 1, 16) AS s FROM reads),
b AS (SELECT user_id, i, substr(s, i::BIGINT, 1) AS base, count(*) AS n FROM a, range(1, 17) r(i) GROUP BY ALL),
m AS (SELECT user_id, i, arg_max(base, (n, -ascii(base))) AS base, max(n) AS same, sum(n) AS depth FROM b GROUP BY ALL),
c AS (SELECT user_id, string_agg(base, '' ORDER BY i) AS consensus, round(1 - sum(same) / sum(depth), 6) AS error FROM m GROUP BY user_id),
k AS (SELECT user_id, count(*) AS conscount FROM a GROUP BY user_id)
SELECT user_id, consensus, conscount, error FROM c JOIN k USING (user_id) WHERE error <= 0.2""")
def consensus_majority(spark, sf_dir):
    return consensus.consensus(reads(spark, sf_dir).select("user_id", F.substring("obs", 1, 16).alias("aligned")), "user_id")


@query(f"WITH {R} SELECT read_id, 'seq' || row_number() OVER (ORDER BY read_ord) AS sequence_id FROM reads")
def sequential_ids(spark, sf_dir):
    return consensus.numbered(reads(spark, sf_dir).select("read_id", "read_ord"), "read_ord").select("read_id", "sequence_id")


@query(f"""WITH {R}, g AS (SELECT user_id, count(*) AS n_reads, min(length(sequence)) AS lo, max(length(sequence)) AS hi, count(DISTINCT umi) AS n_umi FROM reads GROUP BY user_id)
SELECT * FROM g WHERE n_reads >= 5""")
def group_sizes(spark, sf_dir):
    return reads(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("n_reads"), F.min(F.length("sequence").cast("long")).alias("lo"), F.max(F.length("sequence").cast("long")).alias("hi"), F.countDistinct("umi").alias("n_umi")).where("n_reads >= 5")


# --- reads -------------------------------------------------------------------------------------------------

_PHRED = "round(-10 * log10(list_sum(list_transform(string_split(quality, ''), lambda c: pow(10.0, (33 - ascii(c)) / 10.0))) / length(quality)), 6)"


@query(f"WITH {R} SELECT read_id, {_PHRED} AS mean_quality FROM reads")
def mean_phred(spark, sf_dir):
    return reads(spark, sf_dir).select("read_id", F.round(S.mean_phred(F.col("quality")), 6).alias("mean_quality"))


@query(f"WITH {R} SELECT read_id, sequence FROM reads WHERE length(sequence) BETWEEN 30 AND 60 AND {_PHRED} >= 17.5")
def quality_length_filter(spark, sf_dir):
    return filters.quality_length(reads(spark, sf_dir), 17.5, 30, 60).select("read_id", "sequence")


@query("""WITH l AS (SELECT length(text) AS n FROM documents), c AS (SELECT n, sum(n) OVER (ORDER BY n DESC) AS upto, sum(n) OVER () AS total FROM l)
SELECT (SELECT count(*) FROM l) AS n_reads, (SELECT sum(n)::BIGINT FROM l) AS n_bases, (SELECT round(avg(n), 6) FROM l) AS mean_length, (SELECT min(n) FROM l) AS min_length,
  (SELECT max(n) FROM l) AS max_length, (SELECT max(n) FROM c WHERE upto * 2 >= total) AS n50""")
def read_statistics(spark, sf_dir):
    return filters.read_statistics(table(spark, sf_dir, "documents"), "text")


_REPORT = f"""WITH {R}, l AS (SELECT length(sequence) AS n, {_PHRED} AS q FROM reads),
h AS (SELECT (n >> greatest(length(bin(n)) - 7, 0)) << greatest(length(bin(n)) - 7, 0) AS length_class, floor(q)::INT AS quality_class, n >= 30 AND n <= 60 AND q >= 17.5 AS passed, count(*) AS n_reads,
 sum(n)::BIGINT AS n_bases, sum(round_even(q * 1000, 0)::BIGINT)::BIGINT AS quality_milli FROM l GROUP BY ALL)"""


@query(f"{_REPORT} SELECT * FROM h")
def read_report(spark, sf_dir):
    """Read numbers by class of length and quality, in one pass for before and after the filter."""
    return filters.read_report(reads(spark, sf_dir), 17.5, 30, 60)


@query(f"""{_REPORT}, s AS (SELECT 'before' AS stage, * FROM h UNION ALL SELECT 'after', * FROM h WHERE passed),
c AS (SELECT stage, length_class AS c, sum(n_reads) AS k, sum(n_bases) AS b FROM s GROUP BY ALL), d AS (SELECT stage, quality_class AS c, sum(n_reads) AS k FROM s GROUP BY ALL),
w AS (SELECT stage, c, sum(b) OVER (PARTITION BY stage ORDER BY c DESC) * 2 >= sum(b) OVER (PARTITION BY stage) AS far, sum(k) OVER (PARTITION BY stage ORDER BY c) * 2 >= sum(k) OVER (PARTITION BY stage) AS mid FROM c),
x AS (SELECT stage, c, sum(k) OVER (PARTITION BY stage ORDER BY c) * 2 >= sum(k) OVER (PARTITION BY stage) AS mid FROM d)
SELECT stage, sum(n_reads)::BIGINT AS n_reads, sum(n_bases)::BIGINT AS n_bases, round(sum(n_bases) / sum(n_reads), 6)::DOUBLE AS mean_length, round(sum(quality_milli) / 1000.0 / sum(n_reads), 6)::DOUBLE AS mean_quality,
 (SELECT max(c) FROM w WHERE w.stage = s.stage AND far)::BIGINT AS n50, (SELECT min(c) FROM w WHERE w.stage = s.stage AND mid)::BIGINT AS median_length, (SELECT min(c) FROM x WHERE x.stage = s.stage AND mid)::INT AS median_quality FROM s GROUP BY stage""")
def read_report_statistics(spark, sf_dir):
    return filters.report_statistics(filters.read_report(reads(spark, sf_dir), 17.5, 30, 60))


@query(f"WITH {R} SELECT read_id, reverse(translate(sequence, 'ACGT', 'TGCA')) AS rc FROM reads")
def reverse_complement(spark, sf_dir):
    return reads(spark, sf_dir).select("read_id", S.reverse_complement(F.col("sequence")).alias("rc"))


@query(f"""WITH {R}, b AS (SELECT read_id, CASE WHEN read_id % 7 = 0 THEN NULL ELSE substr(sequence, 1, (read_id % 9)::BIGINT) END AS barcode FROM reads)
SELECT read_id, barcode, CASE WHEN length(barcode) >= 4 THEN right(barcode, 4) END AS umi FROM b WHERE barcode IS NULL OR length(barcode) >= 4""")
def umi_trim(spark, sf_dir):
    own = reads(spark, sf_dir).select("read_id", F.when(F.col("read_id") % 7 != 0, F.substr("sequence", F.lit(1), F.col("read_id") % 9)).alias("barcode"))
    return barcodes.trim_umi(own, 4, True)


@query(f"""WITH {R}, h AS (SELECT read_id, umi, user_id, read_id % 4 AS n FROM reads)
SELECT read_id, 'r' || read_id || '|UMI=' || umi || CASE WHEN n > 0 THEN '|N_ORIG=' || n ELSE '' END AS header, umi AS umi_back, CASE WHEN n > 0 THEN n::VARCHAR END AS n_back FROM h""")
def header_round_trip(spark, sf_dir):
    own = reads(spark, sf_dir).select("read_id", S.header_of(F.concat(F.lit("r"), F.col("read_id")), UMI=F.col("umi"), N_ORIG=F.when(F.col("read_id") % 4 > 0, F.col("read_id") % 4)).alias("header"))
    return own.withColumn("_f", S.header_fields(F.col("header"))).select("read_id", "header", F.col("_f")["UMI"].alias("umi_back"), F.try_element_at("_f", F.lit("N_ORIG")).alias("n_back"))


@query(f"""WITH {R} SELECT read_id, 's_002um_' || lpad((user_id % 1000)::VARCHAR, 5, '0') || '_' || lpad((read_id % 1000)::VARCHAR, 5, '0') || '-1' AS spbcid, (user_id % 1000)::INT AS x, (read_id % 1000)::INT AS y,
 's_016um_' || lpad((user_id % 1000 // 8)::VARCHAR, 5, '0') || '_' || lpad((read_id % 1000 // 8)::VARCHAR, 5, '0') AS bin FROM reads""")
def spatial_ids(spark, sf_dir):
    own = reads(spark, sf_dir).select("read_id", S.spatial_id((F.col("user_id") % 1000).cast("int"), (F.col("read_id") % 1000).cast("int")).alias("spbcid"))
    x, y = S.spatial_xy(F.col("spbcid"))
    own = own.select("read_id", "spbcid", x.alias("x"), y.alias("y"))
    return own.withColumn("bin", spatial.bin_16um(F.col("x"), F.col("y")))


@query("""SELECT event_id, trim(regexp_replace(event_type || '/' || props, '[^A-Za-z0-9._-]+', '_', 'g'), '._') AS slug, trim(regexp_replace(lower(event_type || ' ' || user_id), '[^a-z0-9]+', '_', 'g'), '_') AS split_key FROM events""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", S.slug(F.concat("event_type", F.lit("/"), "props")).alias("slug"), S.split_key(F.concat("event_type", F.lit(" "), "user_id")).alias("split_key"))


@query("""WITH s AS (SELECT event_id, event_id * 37 % 20000 AS t, round(100.0 * (event_id % 50) / nullif(event_id % 60, 0), 6) AS pct FROM events)
SELECT event_id, pct, CASE WHEN t >= 3600 THEN (t // 3600) || 'h ' || lpad((t // 60 % 60)::VARCHAR, 2, '0') || 'm ' || lpad((t % 60)::VARCHAR, 2, '0') || 's'
 WHEN t >= 60 THEN (t // 60) || 'm ' || lpad((t % 60)::VARCHAR, 2, '0') || 's' ELSE t || 's' END AS took FROM s""")
def durations(spark, sf_dir):
    own = table(spark, sf_dir, "events")
    return own.select("event_id", F.round(S.percent(F.col("event_id") % 50, F.col("event_id") % 60), 6).alias("pct"), S.duration(F.col("event_id") * 37 % 20000).alias("took"))


@query(f"""WITH {R}, p AS (SELECT read_id, sequence, 'forward' AS pass FROM reads WHERE read_id % 2 = 0 UNION ALL SELECT read_id, reverse(translate(sequence, 'ACGT', 'TGCA')), 'reverse' FROM reads WHERE read_id % 2 = 1)
SELECT pass, count(*) AS n, count(DISTINCT sequence) AS n_distinct FROM p GROUP BY pass""")
def union_passes(spark, sf_dir):
    own = reads(spark, sf_dir).select("read_id", "sequence")
    both = own.where("read_id % 2 = 0").withColumn("pass", F.lit("forward")).unionByName(
        own.where("read_id % 2 = 1").withColumn("sequence", S.reverse_complement(F.col("sequence"))).withColumn("pass", F.lit("reverse")))
    return both.groupBy("pass").agg(F.count("*").alias("n"), F.countDistinct("sequence").alias("n_distinct"))


# --- barcodes ------------------------------------------------------------------------------------------------

@query(f"WITH {R}, {WHITE} SELECT read_id, obs AS spbc, x, y FROM reads JOIN (SELECT spbc, max(x) AS x, max(y) AS y FROM white GROUP BY spbc) ON obs = spbc")
def barcode_exact_pass(spark, sf_dir):
    own = whitelist(spark, sf_dir).groupBy("spbc").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    return barcodes.exact(reads(spark, sf_dir).select("read_id", F.col("obs").alias("spbc")), own).where("status = 'pass'").select("read_id", "spbc", "x", "y")


@query(f"WITH {R}, {WHITE} SELECT read_id, obs AS spbc FROM reads WHERE obs NOT IN (SELECT spbc FROM white)")
def barcode_exact_fail(spark, sf_dir):
    own = whitelist(spark, sf_dir).select("spbc").distinct()
    return barcodes.exact(reads(spark, sf_dir).select("read_id", F.col("obs").alias("spbc")), own).where("status = 'fail'").select("read_id", "spbc")


def _fuzzy(k: int) -> None:
    sql = f"""WITH {R}, {WHITE}, o AS (SELECT DISTINCT obs AS observed FROM reads), w AS (SELECT DISTINCT spbc FROM white),
m AS (SELECT observed, spbc, hamming(observed, spbc) AS d FROM o, w)
SELECT observed, arg_min(spbc, (d, spbc)) AS corrected, min(d)::INT AS distance FROM m WHERE d <= {k} GROUP BY observed"""

    def f(spark, sf_dir):
        return barcodes.closest(reads(spark, sf_dir).select("obs"), whitelist(spark, sf_dir).select("spbc"), 16, k)

    f.__name__ = f"barcode_fuzzy_k{k}"
    query(sql)(f)


for _k in (1, 2, 3):
    _fuzzy(_k)


@query(f"""WITH {R}, {WHITE}, w AS (SELECT spbc, max({{'x': x, 'y': y}}) AS spot FROM white GROUP BY spbc),
s AS (SELECT read_id, CASE WHEN read_id % 6 = 0 THEN substr(obs || umi, 1, 27) WHEN read_id % 6 = 1 THEN obs || umi ELSE obs || umi || 'ACGTA' END AS q FROM reads),
j AS (SELECT s.*, w.spot, length(q) < 28 OR w.spbc IS NULL AS bad FROM s LEFT JOIN w ON substr(q, 1, 16) = w.spbc)
SELECT read_id, CASE WHEN NOT bad THEN substr(q, 1, 28) END AS spbcumi, CASE WHEN NOT bad THEN spot.x END AS x, CASE WHEN NOT bad THEN spot.y END AS y, CASE WHEN NOT bad THEN substr(q, 29) END AS trimmed,
 CASE WHEN bad THEN 'annotation' WHEN length(q) = 28 THEN 'zero length' END AS fail_reason FROM j""")
def visium_decode(spark, sf_dir):
    n = F.col("read_id") % 6
    s = F.concat("obs", "umi")
    own = reads(spark, sf_dir).select("read_id", F.when(n == 0, F.substring(s, 1, 27)).when(n == 1, s).otherwise(F.concat(s, F.lit("ACGTA"))).alias("sequence"))
    return barcodes.visium(own, whitelist(spark, sf_dir)).select("read_id", "spbcumi", "x", "y", "trimmed", "fail_reason")


_HD = f"""idx AS (SELECT raw, spbcid, max(rc) AS rc FROM (SELECT substr({dna('user_id')}, 1, CAST(14 + user_id % 3 AS INT)) AS raw, 'id' || CAST(user_id % 50 AS STRING) AS spbcid, user_id % 4 AS rc FROM events WHERE user_id % 5 <> 0) GROUP BY raw, spbcid)"""


@query(f"""WITH {R}, {_HD}, s AS (SELECT read_id, 'ACGTACGTA' || substr('GGG', 1, (read_id % 4)::BIGINT) || {dna('user_id')} AS q FROM reads),
h AS (SELECT read_id, q, o, n, raw, spbcid, rc FROM s, (VALUES (0), (1), (2)) v(o), (VALUES (14), (15), (16)) l(n) JOIN idx ON raw = substr(q, 10 + o, n)),
g AS (SELECT read_id, count(DISTINCT spbcid) AS k, arg_min({{'raw': raw, 'id': spbcid, 'e': 10 + o + n}}, row(-rc, o, -n, raw)) AS b, any_value(q) AS q FROM h GROUP BY read_id)
SELECT read_id, b.raw AS spbc, b.id AS spbcid, 'ACGTACGTA' || b.id AS umispbcid, substr(q, b.e) AS trimmed FROM g WHERE k = 1""")
def hd_multi_window(spark, sf_dir):
    own = table(spark, sf_dir, "events").where("user_id % 5 <> 0").selectExpr(
        f"substr({dna('user_id')}, 1, CAST(14 + user_id % 3 AS INT)) AS raw_spbc", "concat('id', CAST(user_id % 50 AS STRING)) AS spbc_id", "user_id % 4 AS read_count")
    index = own.groupBy("raw_spbc", "spbc_id").agg(F.max("read_count").alias("read_count")).withColumns({"x": F.lit(0), "y": F.lit(0)})
    s = table(spark, sf_dir, "events").selectExpr("event_id AS read_id", f"concat('ACGTACGTA', substr('GGG', 1, CAST(event_id % 4 AS INT)), {dna('user_id')}) AS sequence")
    return barcodes.hd_index(s, index, 9, (0, 1, 2), (14, 15, 16)).where("spbcid is not null").select("read_id", "spbc", "spbcid", "umispbcid", "trimmed")


@query(f"""WITH {R}, l1 AS (SELECT substr({dna('user_id')}, 1, 15) AS seq, min(user_id)::INT AS ord FROM events WHERE user_id % 2 = 0 GROUP BY 1),
l2 AS (SELECT substr({dna('user_id')}, 16, 14) AS seq, min(user_id)::INT AS ord FROM events WHERE user_id % 3 <> 0 GROUP BY 1),
s AS (SELECT read_id, substr({dna('read_id')}, 1, (9 + read_id % 3)::BIGINT) || {dna('user_id')} AS q FROM reads),
t AS (SELECT read_id, q, o * 4 + r AS rank, o, substr(q, 10 + o, a) AS b1, substr(q, 10 + o + a, b) AS b2, a, b FROM s, (VALUES (0), (1), (2)) v(o), (VALUES (0, 15, 14), (1, 15, 15), (2, 16, 14), (3, 16, 15)) h(r, a, b)),
m AS (SELECT t.*, l1.ord AS x, l2.ord AS y FROM t JOIN l1 ON b1 = l1.seq JOIN l2 ON b2 = l2.seq WHERE length(b1) = a AND length(b2) = b),
g AS (SELECT read_id, arg_min({{'x': x, 'y': y, 'u': substr(q, 1, 9 + o), 's': b1 || b2}}, rank) AS h FROM m GROUP BY read_id)
SELECT read_id, h.u AS umi, h.s AS spbc, h.x AS x, h.y AS y, 's_002um_' || lpad(h.x::VARCHAR, 5, '0') || '_' || lpad(h.y::VARCHAR, 5, '0') || '-1' AS spbc10x FROM g""")
def hd_halves(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    l1 = e.where("user_id % 2 = 0").selectExpr(f"substr({dna('user_id')}, 1, 15) AS seq", "CAST(user_id AS INT) AS ord").groupBy("seq").agg(F.min("ord").alias("ord"))
    l2 = e.where("user_id % 3 <> 0").selectExpr(f"substr({dna('user_id')}, 16, 14) AS seq", "CAST(user_id AS INT) AS ord").groupBy("seq").agg(F.min("ord").alias("ord"))
    s = e.selectExpr("event_id AS read_id", f"concat(substr({dna('event_id')}, 1, CAST(9 + event_id % 3 AS INT)), {dna('user_id')}) AS sequence")
    return barcodes.hd_halves(s, l1, l2).where("status = 'pass'").select("read_id", "umi", "spbc", "x", "y", "spbc10x")


# --- receptor tables ---------------------------------------------------------------------------------------------

@query(f"""WITH {A} SELECT sequence_id, c_call, umi, junction FROM airr WHERE c_call IS NOT NULL AND substr(c_call, 1, 3) = 'IGH'
 AND NOT coalesce(regexp_matches(umi, 'T{{11}}'), false) AND NOT coalesce(regexp_matches(junction, 'N'), false) AND consensus_count > 1""")
def airr_quality(spark, sf_dir):
    return filters.downstream_quality(airr(spark, sf_dir)).select("sequence_id", "c_call", "umi", "junction")


@query(f"WITH {A} SELECT sequence_id, v_call FROM airr WHERE productive AND regexp_matches(v_call, 'IGHV')")
def productive_heavy(spark, sf_dir):
    return filters.productive(airr(spark, sf_dir), True).select("sequence_id", "v_call")


@query(f"WITH {A}, i AS (SELECT nullif(regexp_extract(c_call, 'IGH[A-Z][A-Z0-9]*'), '') AS isotype FROM airr) SELECT isotype, count(*) AS n FROM i WHERE isotype IS NOT NULL GROUP BY isotype")
def isotype_counts(spark, sf_dir):
    return airr(spark, sf_dir).select(S.isotype(F.col("c_call")).alias("isotype")).where("isotype is not null").groupBy("isotype").agg(F.count("*").alias("n"))


@query(f"""WITH {A}, s AS (SELECT count(*) FILTER (productive) AS productive, count(*) FILTER (productive AND locus = 'IGH') AS productive_igh, count(DISTINCT spbcid) AS spots, count(DISTINCT umi) AS molecules FROM airr)
UNPIVOT s ON productive, productive_igh, spots, molecules INTO NAME metric VALUE value""")
def dataset_summary(spark, sf_dir):
    one = airr(spark, sf_dir).agg(
        F.count_if("productive").alias("productive"), F.count_if(F.col("productive") & (F.col("locus") == "IGH")).alias("productive_igh"), F.countDistinct("spbcid").alias("spots"), F.countDistinct("umi").alias("molecules"))
    return one.unpivot([], ["productive", "productive_igh", "spots", "molecules"], "metric", "value")


@query(f"WITH {A} SELECT locus, count(*) AS n_chains, sum(consensus_count)::BIGINT AS n_reads, round(avg(consensus_count), 6) AS mean_reads FROM airr GROUP BY locus")
def chains_per_locus(spark, sf_dir):
    return airr(spark, sf_dir).groupBy("locus").agg(F.count("*").alias("n_chains"), F.sum("consensus_count").alias("n_reads"), F.round(F.avg("consensus_count"), 6).alias("mean_reads"))


_CLONES = f"""c AS (SELECT clone_id, count(*) AS n_molecules, count(DISTINCT spbcid) AS n_spbcs, sum(consensus_count)::BIGINT AS n_reads FROM airr WHERE clone_id IS NOT NULL GROUP BY clone_id),
k AS (SELECT *, row_number() OVER (ORDER BY n_molecules DESC, clone_id) AS clone_rank FROM c)"""


@query(f"WITH {A}, {_CLONES} SELECT * FROM k")
def clone_summary(spark, sf_dir):
    return clones.summary(airr(spark, sf_dir))


@query(f"WITH {A}, {_CLONES} SELECT clone_id, spbcid, x, y, count(*) AS n FROM airr WHERE clone_id IN (SELECT clone_id FROM k WHERE clone_rank <= 2) GROUP BY ALL")
def top_clone_spots(spark, sf_dir):
    return clones.top(airr(spark, sf_dir), 2).groupBy("clone_id", "spbcid", "x", "y").agg(F.count("*").alias("n"))


@query(f"WITH {A}, {_CLONES} SELECT CASE WHEN clone_rank <= 1 THEN '<=1' WHEN clone_rank <= 3 THEN '<=3' WHEN clone_rank <= 10 THEN '<=10' ELSE '>10' END AS bucket, sum(n_molecules)::BIGINT AS n_molecules FROM k GROUP BY 1")
def clonal_proportion(spark, sf_dir):
    return clones.rank_buckets(clones.summary(airr(spark, sf_dir)))


@query(f"WITH {A} SELECT DISTINCT spbcid, x, y FROM airr")
def spatial_background(spark, sf_dir):
    return airr(spark, sf_dir).select("spbcid", "x", "y").distinct()


@query(f"WITH {A} SELECT spbcid, x, y, count(DISTINCT clone_id) AS n_clones FROM airr GROUP BY ALL")
def clone_richness(spark, sf_dir):
    return airr(spark, sf_dir).groupBy("spbcid", "x", "y").agg(F.countDistinct("clone_id").alias("n_clones"))


_MAPPED = f"""{A}, {M}, w AS (SELECT regexp_replace(square_002um, '-1$', '') AS square, square_016um AS bin_16um,
  CASE WHEN in_cell AND cell_id <> 'cellid_000000000' THEN regexp_replace(cell_id, '-1$', '') END AS cell FROM mapping WHERE square_016um <> 's_016um_00003_00003'),
mapped AS (SELECT airr.*, regexp_replace(spbcid, '-1$', '') AS square, bin_16um, cell FROM airr LEFT JOIN w ON regexp_replace(spbcid, '-1$', '') = w.square)"""


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.with_mapping(airr(spark, sf_dir), mapping(spark, sf_dir).where("square_016um <> 's_016um_00003_00003'"))


@query(f"WITH {_MAPPED} SELECT sequence_id, square, bin_16um, cell FROM mapped")
def mapping_join(spark, sf_dir):
    return mapped(spark, sf_dir).select("sequence_id", "square", "bin_16um", "cell")


@query(f"WITH {_MAPPED}, v AS (SELECT DISTINCT regexp_replace(spbcid, '-1$', '') AS square FROM airr WHERE locus = 'IGK') SELECT square, bin_16um, cell FROM w SEMI JOIN v USING (square)")
def mapping_scan(spark, sf_dir):
    return spatial.mapping_for(mapping(spark, sf_dir).where("square_016um <> 's_016um_00003_00003'"), airr(spark, sf_dir).where("locus = 'IGK'"))


@query(f"""WITH {_MAPPED}, s AS (SELECT count(*) AS "rows", count(bin_16um) AS mapped_rows, count(cell) AS cell_rows, count(DISTINCT bin_16um) AS bins, count(DISTINCT cell) AS cells FROM mapped)
UNPIVOT s ON "rows", mapped_rows, cell_rows, bins, cells INTO NAME metric VALUE value""")
def mapping_quality(spark, sf_dir):
    return spatial.mapping_quality(mapped(spark, sf_dir))


_LEVELS = "l AS (SELECT 'square' AS level, square AS place, clone_id FROM mapped UNION ALL SELECT 'bin_16um', bin_16um, clone_id FROM mapped UNION ALL SELECT 'cell', cell, clone_id FROM mapped)"


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each resolution, from one scan."""
    own = mapped(spark, sf_dir).select("clone_id", F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.col(n).alias("place")) for n in ("square", "bin_16um", "cell")])).alias("l"))
    return own.select("l.level", "l.place", "clone_id")


@query(f"WITH {_MAPPED}, {_LEVELS} SELECT level, place, count(DISTINCT clone_id) AS n_clones, count(*) AS n_chains FROM l GROUP BY ALL")
def richness_resolutions(spark, sf_dir):
    return levels(spark, sf_dir).groupBy("level", "place").agg(F.countDistinct("clone_id").alias("n_clones"), F.count("*").alias("n_chains"))


@query(f"""WITH {_MAPPED}, {_LEVELS}, t AS (SELECT clone_id FROM airr WHERE clone_id IS NOT NULL GROUP BY clone_id ORDER BY count(*) DESC, clone_id LIMIT 1)
SELECT level, place, count(*) AS n_chains FROM l SEMI JOIN t USING (clone_id) GROUP BY ALL""")
def top_clone_resolutions(spark, sf_dir):
    largest = clones.top(airr(spark, sf_dir), 1).select("clone_id").distinct()
    return levels(spark, sf_dir).join(largest, "clone_id", "left_semi").groupBy("level", "place").agg(F.count("*").alias("n_chains"))


@query(f"WITH {_MAPPED}, {_LEVELS}, p AS (SELECT DISTINCT level, place FROM l) SELECT level, count(*) AS n FROM p GROUP BY level")
def resolution_counts(spark, sf_dir):
    return levels(spark, sf_dir).select("level", "place").distinct().groupBy("level").agg(F.count("*").alias("n"))


@query(f"""WITH {_MAPPED}, p AS (SELECT cell, round(avg(x * 0.25), 6) AS image_x FROM mapped GROUP BY cell), r AS (SELECT cell, count(DISTINCT clone_id) AS n_clones, count(*) AS n_chains FROM mapped GROUP BY cell)
SELECT r.cell, n_clones, n_chains, image_x FROM r LEFT JOIN p ON r.cell IS NOT DISTINCT FROM p.cell""")
def resolution_coordinates(spark, sf_dir):
    own = mapped(spark, sf_dir)
    places = own.groupBy(F.col("cell").alias("_cell")).agg(F.round(F.avg(F.col("x") * 0.25), 6).alias("image_x"))
    return spatial.with_coordinates(spatial.richness(own, "cell"), places, "cell", "_cell")


_POSITIONS = f"""pos AS (SELECT DISTINCT spbcid AS barcode, y * 3.5 AS pxl_row_in_fullres, x * 2.5 AS pxl_col_in_fullres FROM airr)"""
_CENTRES = "ce AS (SELECT cell, round(avg(pxl_col_in_fullres * 0.5), 6) AS image_x, round(avg(pxl_row_in_fullres * 0.5), 6) AS image_y, count(*) AS n_squares FROM pos JOIN w ON regexp_replace(barcode, '-1$', '') = w.square WHERE cell IS NOT NULL GROUP BY cell)"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airr(spark, sf_dir).select(F.col("spbcid").alias("barcode"), (F.col("y") * 3.5).alias("pxl_row_in_fullres"), (F.col("x") * 2.5).alias("pxl_col_in_fullres")).distinct()


@query(f"WITH {_MAPPED}, {_POSITIONS}, {_CENTRES} SELECT * FROM ce")
def cell_centroids(spark, sf_dir):
    own = mapping(spark, sf_dir).where("square_016um <> 's_016um_00003_00003'")
    return spatial.centroids(positions(spark, sf_dir), spatial.mapping_for(own, airr(spark, sf_dir)), 0.5)


@query(f"""WITH {_MAPPED}, {_POSITIONS}, {_CENTRES}, b AS (SELECT min(image_x) AS min_x, max(image_x) AS max_x, min(image_y) AS min_y, max(image_y) AS max_y FROM ce)
SELECT *, round(greatest(0, min_x - (max_x - min_x) * 0.05), 6) AS crop_min_x, round(least(250, max_x + (max_x - min_x) * 0.05), 6) AS crop_max_x,
 round(greatest(0, min_y - (max_y - min_y) * 0.05), 6) AS crop_min_y, round(least(400, max_y + (max_y - min_y) * 0.05), 6) AS crop_max_y FROM b""")
def spatial_bounds(spark, sf_dir):
    return spatial.bounds(cell_centroids(spark, sf_dir), width=250, height=400)


@query(f"""WITH {_MAPPED}, {_POSITIONS}, {_CENTRES}, b AS (SELECT min(image_x) AS x0, max(image_x) AS x1, min(image_y) AS y0, max(image_y) AS y1 FROM ce),
c AS (SELECT round(greatest(0, x0 - (x1 - x0) * 0.1), 6) AS x0, round(least(200, x1 + (x1 - x0) * 0.1), 6) AS x1, round(greatest(0, y0 - (y1 - y0) * 0.1), 6) AS y0, round(least(150, y1 + (y1 - y0) * 0.1), 6) AS y1 FROM b)
SELECT x0 AS zoom_min_x, round(x0 + 0.4 * (x1 - x0), 6) AS zoom_max_x, round(y1 - 0.4 * (y1 - y0), 6) AS zoom_min_y, y1 AS zoom_max_y FROM c""")
def spatial_zoom(spark, sf_dir):
    return spatial.zoom_box(spatial.bounds(cell_centroids(spark, sf_dir), padding=0.1, width=200, height=150))


@query(f"WITH {A} SELECT umi, count(DISTINCT clone_id) AS n_clones FROM airr WHERE umi IS NOT NULL GROUP BY umi HAVING count(DISTINCT clone_id) > 1")
def clone_conflicts(spark, sf_dir):
    return clones.conflicts(airr(spark, sf_dir).where("umi is not null"), "umi")


@query(f"""WITH {A}, l AS (SELECT sequence_id AS barcode, clone_id FROM airr WHERE event_id % 2 = 0), p AS (SELECT 'sampleA_' || sequence_id AS barcode, locus FROM airr)
SELECT p.barcode, regexp_replace(p.barcode, '^sampleA_', '') AS bare_key, locus, clone_id FROM p LEFT JOIN l ON l.barcode = regexp_replace(p.barcode, '^sampleA_', '')""")
def clone_restore(spark, sf_dir):
    own = airr(spark, sf_dir)
    rows = own.select(F.concat(F.lit("sampleA_"), "sequence_id").alias("barcode"), "locus")
    return clones.restore(rows, own.where("event_id % 2 = 0").select(F.col("sequence_id").alias("barcode"), "clone_id"), "sampleA")


@query(f"WITH {A} SELECT v_call, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS proportion FROM airr GROUP BY v_call")
def gene_usage(spark, sf_dir):
    return clones.proportions(airr(spark, sf_dir), "v_call")


_JUNCTIONS = f"""jn AS (SELECT user_id AS id, 'IGHV' || CAST(user_id // 4 % 3 + 1 AS STRING) AS v, 'IGHJ' || CAST(user_id // 4 % 2 + 1 AS STRING) AS j,
  CASE WHEN user_id % 4 = 0 THEN {dna('user_id')} WHEN user_id % 4 = 1 THEN 'A' || substr({dna('user_id - 1')}, 2) WHEN user_id % 4 = 2 THEN substr({dna('user_id - 2')}, 1, 30) || 'CC' ELSE substr({dna('user_id - 3')}, 1, 28) END AS junction
  FROM (SELECT DISTINCT user_id FROM events))"""


@query(f"""WITH RECURSIVE {_JUNCTIONS}, e AS (SELECT a.id AS a, b.id AS b FROM jn a JOIN jn b ON a.v = b.v AND a.j = b.j AND length(a.junction) = length(b.junction) AND hamming(a.junction, b.junction) <= length(a.junction) // 10),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), c AS (SELECT a, min(b) AS lead FROM r GROUP BY a)
SELECT lead AS smallest, count(*) AS n_members FROM c GROUP BY lead""")
def clone_assign(spark, sf_dir):
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    expr = f"CASE WHEN user_id % 4 = 0 THEN {dna('user_id')} WHEN user_id % 4 = 1 THEN concat('A', substr({dna('user_id - 1')}, 2)) WHEN user_id % 4 = 2 THEN concat(substr({dna('user_id - 2')}, 1, 30), 'CC') ELSE substr({dna('user_id - 3')}, 1, 28) END"
    own = u.selectExpr("user_id AS id", "concat('IGHV', user_id div 4 % 3 + 1, '*01') AS v_call", "concat('IGHJ', user_id div 4 % 2 + 1, '*01') AS j_call", f"{expr} AS junction")
    return clones.assign(own).groupBy("clone_id").agg(F.min("id").alias("smallest"), F.count("*").alias("n_members")).select("smallest", "n_members")


# --- run records ----------------------------------------------------------------------------------------------------

_REC = """rec AS (SELECT o_custkey % 50 AS k, count(*) AS input, count(*) FILTER (o_orderstatus <> 'F') AS matched, count(*) FILTER (o_orderstatus = 'O') AS tagged, count(*) FILTER (o_orderpriority LIKE '1%') + (o_custkey % 50) % 3 * 20 AS cons FROM orders GROUP BY o_custkey % 50)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run whose samples are customers' order counts, with some counts that disagree."""
    o = table(spark, sf_dir, "orders")
    base = o.groupBy((F.col("o_custkey") % 50).alias("k")).agg(
        F.count("*").alias("input"), F.count_if(F.col("o_orderstatus") != "F").alias("matched"), F.count_if(F.col("o_orderstatus") == "O").alias("tagged"),
        F.count_if(F.col("o_orderpriority").startswith("1")).alias("_c")).withColumn("cons", F.col("_c") + F.col("k") % 3 * 20)
    m = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), F.col(v).cast("long"))])
    own = base.select("k", F.explode(F.array(
        F.struct(F.lit("demux").alias("module"), m(assigned_reads="input").alias("counts")), F.struct(F.lit("collapse").alias("module"), m(input_reads="matched", consensus_sequences="cons").alias("counts")),
        F.struct(F.lit("seqtag").alias("module"), m(input_sequences="cons", matched_sequences="tagged").alias("counts")))).alias("r")).select("k", "r.*")
    own = own.where("not (module = 'demux' and k % 7 = 0)")
    return own.select(
        F.lit("run").alias("run_id"), "module", F.concat(F.lit("s"), "k").alias("record_id"), F.lit("sample").alias("scope_type"), F.concat(F.lit("s"), "k").alias("sample"), F.lit(None).cast("string").alias("locus"),
        F.lit("success").alias("status"), F.lit("2024-01-01T00:00:00+00:00").alias("started_at"), F.lit("2024-01-01T00:01:00+00:00").alias("finished_at"), F.lit(60.0).alias("duration_seconds"), "counts",
        F.create_map(F.lit("library"), F.lit("bulk")).alias("parameters"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("files"))


@query(f"""WITH {_REC} SELECT 'run' AS run_id, 'collapse' AS module, 's' || k AS record_id, 'consensus_sequences' AS "key", cons AS "value", 'input_reads' AS previous_key, matched AS previous_value FROM rec WHERE cons > matched
UNION ALL SELECT 'run', 'seqtag', 's' || k, 'matched_sequences', tagged, 'input_sequences', cons FROM rec WHERE tagged > cons""")
def monotone_check(spark, sf_dir):
    return runmeta.rises(records(spark, sf_dir))


@query(f"""WITH {_REC} SELECT 'run' AS run_id, 'demux/s' || k AS "left", 'assigned_reads' AS left_key, input AS left_value, 'collapse/s' || k AS "right", 'input_reads' AS right_key, matched AS right_value FROM rec WHERE k % 7 <> 0 AND input <> matched""")
def count_mismatch(spark, sf_dir):
    return runmeta.mismatches(records(spark, sf_dir))


@query(f"WITH {_REC} SELECT 'run' AS run_id, 's' || k AS sample, 'collapse, seqtag' AS modules FROM rec WHERE k % 7 = 0")
def unexpected_sample(spark, sf_dir):
    return runmeta.unexpected_samples(records(spark, sf_dir))


@query(f"""WITH {_REC} SELECT 'Collapse' AS "Step", 's' || k || ' | Group retention' AS "PathInfo", 0 AS n FROM rec WHERE false
UNION ALL SELECT 'Seqtag', 's' || k, round(tagged * 100.0 / nullif(cons, 0), 6) FROM rec""")
def summary_rows(spark, sf_dir):
    return runmeta.summary_rows(records(spark, sf_dir)).select("Step", "PathInfo", F.round("PercentRetained", 6).alias("n"))


@query(f"WITH {_REC} SELECT 'run' AS run_id, sum(cons)::BIGINT AS value FROM rec")
def scope_preference(spark, sf_dir):
    return runmeta.module_sum(records(spark, sf_dir), "collapse", "consensus_sequences")


@query(f"""WITH {_REC} SELECT 'run' AS run_id, sum(matched)::BIGINT AS input_reads, NULL::BIGINT AS filtered_reads, NULL::BIGINT AS demultiplexed_reads, NULL::BIGINT AS samples, sum(cons)::BIGINT AS consensus_sequences,
 sum(tagged)::BIGINT AS tagged_sequences, NULL::BIGINT AS productive, (SELECT 60.0 * (count(*) * 2 + count(*) FILTER (k % 7 <> 0)) FROM rec)::DOUBLE AS runtime_seconds, count(*) * 2 + count(*) FILTER (k % 7 <> 0) AS n_records FROM rec""")
def run_overview(spark, sf_dir):
    return runmeta.overview(records(spark, sf_dir))


@query("""WITH s AS (SELECT CAST(o_custkey % 5 AS STRING) AS run_id, count(*) AS a, count(*) FILTER (o_orderstatus <> 'F') AS b, count(*) FILTER (o_orderstatus = 'O') AS c FROM orders GROUP BY 1),
t AS (SELECT run_id, 0 AS stage_no, 'all' AS label, a AS value FROM s UNION ALL SELECT run_id, 1, 'all', a FROM s UNION ALL SELECT run_id, 2, 'open or part', b FROM s UNION ALL SELECT run_id, 3, 'open', c FROM s),
d AS (SELECT * FROM t QUALIFY NOT coalesce(lag(label) OVER (PARTITION BY run_id ORDER BY stage_no) = label AND lag(value) OVER (PARTITION BY run_id ORDER BY stage_no) = value, false))
SELECT run_id, stage_no, label, value, round(value * 100.0 / lag(value) OVER w, 6)::DOUBLE AS pct_previous, round(value * 100.0 / first_value(value) OVER w, 6)::DOUBLE AS pct_first, round(value * 100.0 / max(value) OVER (PARTITION BY run_id), 6)::DOUBLE AS bar
FROM d WINDOW w AS (PARTITION BY run_id ORDER BY stage_no)""")
def stage_retention(spark, sf_dir):
    o = view(spark, sf_dir, ORDERS, "orders").groupBy("run_id").agg(F.count("*").alias("a"), F.count_if(F.col("status") != "F").alias("b"), F.count_if(F.col("status") == "O").alias("c"))
    stages = o.select("run_id", F.explode(F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("label"), F.col(c).alias("value")) for i, (n, c) in enumerate([("all", "a"), ("all", "a"), ("open or part", "b"), ("open", "c")])])).alias("s")).select("run_id", "s.*")
    return runmeta.retention(stages)


@query("""SELECT o_orderstatus AS locus, o_orderpriority AS sample, count(*) AS n, grouping(o_orderpriority)::INT AS is_total, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))""")
def locus_rollup(spark, sf_dir):
    o = view(spark, sf_dir, ORDERS, "orders").select(F.col("status").alias("locus"), F.col("priority").alias("sample"), "price")
    return o.groupingSets([["locus"], ["locus", "sample"]], "locus", "sample").agg(F.count("*").alias("n"), F.grouping("sample").cast("int").alias("is_total"), F.round(F.sum("price"), 2).alias("total")).select("locus", "sample", "n", "is_total", "total")


@query("""WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) SELECT o_custkey, n, round(n * 100.0 / sum(n) OVER (), 6)::DOUBLE AS pct FROM s""")
def demux_shares(spark, sf_dir):
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    total = s.agg(F.sum("n")).first()[0] or 0
    return s.select("o_custkey", "n", F.round(S.percent(F.col("n"), F.lit(total)), 6).alias("pct"))


_FULL = """b AS (SELECT CAST(o_custkey % 5 AS STRING) AS run_id, o_custkey % 5 AS r, substr(o_orderpriority, 1, 1) AS s, count(*) AS n, count(*) FILTER (o_orderstatus <> 'F') AS m, count(*) FILTER (o_orderstatus = 'O') AS t
FROM orders GROUP BY ALL)"""


def full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs with sample records of all modules, AIRR records of two loci (some runs have one of the run besides), and run records of some modules (of collapse in every other run, and of one that no rule knows)."""
    o, c = table(spark, sf_dir, "orders"), F.col
    b = o.groupBy((c("o_custkey") % 5).alias("r"), F.substring("o_orderpriority", 1, 1).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(c("o_orderstatus") != "F").alias("m"), F.count_if(c("o_orderstatus") == "O").alias("t"))
    whole = b.groupBy("r").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))

    def of(own: DataFrame, module: str, sample, locus: str | None, **counts: str) -> DataFrame:
        told = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.expr(v).cast("long"))])
        scope = "run" if sample is None else "sample"
        return own.select(c("r").cast("string").alias("run_id"), F.lit(module).alias("module"), F.lit(scope).alias("scope_type"),
                          (F.lit(None).cast("string") if sample is None else c(sample)).alias("sample"), F.lit(locus).cast("string").alias("locus"), told.alias("counts"))

    parts = [
        of(b, "demux", "s", None, assigned_reads="n"), of(whole, "demux", None, None, input_reads="n + 10", matched_reads="n"),
        of(b, "collapse", "s", None, consensus_sequences="m"), of(whole.where("r % 2 = 0"), "collapse", None, None, consensus_sequences="m + 1"),
        of(b, "seqtag", "s", None, input_sequences="m", matched_sequences="t"),
        of(b, "airr", "s", "IG", input_sequences="t", airr_sequences="t - t % 3", productive_sequences="t div 2"),
        of(b.where("s < '3' and r % 2 = 1"), "airr", "s", "tr", input_sequences="t", airr_sequences="t", productive_sequences="t div 3"),
        of(whole.where("r % 3 = 0"), "airr", None, None, input_sequences="n", airr_sequences="m"), of(whole, "polish", None, None, taken="n + m", kept="n", left="m")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""WITH {_FULL}, w AS (SELECT run_id, any_value(r) AS r, sum(m)::BIGINT AS m, sum(t)::BIGINT AS t, coalesce(sum(t) FILTER (s < '3' AND r % 2 = 1), 0)::BIGINT AS t2,
 sum(t - t % 3)::BIGINT AS v, sum(t // 2)::BIGINT AS p, coalesce(sum(t // 3) FILTER (s < '3' AND r % 2 = 1), 0)::BIGINT AS p2 FROM b GROUP BY run_id)
SELECT run_id, 0 AS stage_no, 'Consensus sequences' AS label, m + CASE WHEN r % 2 = 0 THEN 1 ELSE 0 END AS value, NULL AS note FROM w UNION ALL SELECT run_id, 1, 'Seqtag input', m, NULL FROM w WHERE r % 2 = 0
UNION ALL SELECT run_id, 2, 'Seqtag matches', t, NULL FROM w UNION ALL SELECT run_id, 3, 'AIRR input represented', t + t2, 'Available loci: Ig, TCR' FROM w WHERE t2 > 0 UNION ALL SELECT run_id, 4, 'Valid AIRR sequences', v + t2, NULL FROM w
UNION ALL SELECT run_id, 5, 'Productive AIRR sequences', p + p2, NULL FROM w""")
def yield_stages(spark, sf_dir):
    return runmeta.yield_stages(full_records(spark, sf_dir))


@query(f"""WITH {_FULL}, w AS (SELECT run_id, any_value(r) AS r, sum(n) AS n, sum(m) AS m FROM b GROUP BY run_id), e AS (
SELECT run_id, 'demux' AS module, 'sample' AS scope_type, s AS sample, NULL AS locus, w.n AS i, b.n AS o, 'Assigned sample reads' AS label FROM b JOIN w USING (run_id)
UNION ALL SELECT run_id, 'demux', 'run', NULL, NULL, n + 10, n, 'Valid UDI matches' FROM w
UNION ALL SELECT run_id, 'collapse', 'sample', s, NULL, NULL, m, 'Consensus sequences' FROM b UNION ALL SELECT run_id, 'collapse', 'run', NULL, NULL, NULL, m + 1, 'Consensus sequences' FROM w WHERE r % 2 = 0
UNION ALL SELECT run_id, 'seqtag', 'sample', s, NULL, m, t, 'Seqtag matches' FROM b UNION ALL SELECT run_id, 'airr', 'sample', s, 'IG', t, t // 2, 'Productive sequences' FROM b
UNION ALL SELECT run_id, 'airr', 'sample', s, 'tr', t, t // 3, 'Productive sequences' FROM b WHERE s < '3' AND r % 2 = 1
 UNION ALL SELECT run_id, 'airr', 'run', NULL, NULL, n, m, 'Valid AIRR sequences' FROM w WHERE r % 3 = 0 UNION ALL SELECT run_id, 'polish', 'run', NULL, NULL, n + m, m, 'Output' FROM w)
SELECT run_id, module, scope_type, sample, locus, i::BIGINT AS input, o::BIGINT AS output, label, round(o * 100.0 / nullif(i, 0), 6)::DOUBLE AS retained FROM e""")
def module_summary(spark, sf_dir):
    return runmeta.module_summary(full_records(spark, sf_dir))


@query("""SELECT event_id, 'seq' || event_id || '|GROUP=' || user_id || '|N_KEEP=' || (event_id % 9) || '|UMI=' || event_type || CASE WHEN event_id % 3 = 0 THEN '|SPBC=P' || (event_id % 4) ELSE '|SPBC=S' || (event_id % 5) END
 || CASE WHEN event_id % 2 = 0 THEN '|BC1=B' || (event_id % 7) ELSE '' END || '|SPBCID=s' || user_id AS header FROM events""")
def consensus_headers(spark, sf_dir):
    c = F.col
    own = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("seq"), "event_id").alias("sequence_id"), c("user_id").alias("group"), (c("event_id") % 9).alias("n_keep"), c("event_type").alias("umi"),
        F.when(c("event_id") % 3 == 0, F.concat(F.lit("P"), c("event_id") % 4)).alias("primer"), F.concat(F.lit("S"), c("event_id") % 5).alias("spbc"),
        F.when(c("event_id") % 2 == 0, F.concat(F.lit("B"), c("event_id") % 7)).alias("bc1"), F.concat(F.lit("s"), "user_id").alias("spbcid"))
    return consensus.with_header(own, "visiumhd").select("event_id", "header")


def whole_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs with records of all five modules, complete enough for the summary."""
    c = F.col
    o = table(spark, sf_dir, "orders")
    b = o.groupBy((c("o_custkey") % 5).alias("r"), F.concat(F.lit("s"), F.substring("o_orderpriority", 1, 1)).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(c("o_orderstatus") != "F").alias("m"), F.count_if(c("o_orderstatus") == "O").alias("t"))
    whole = b.groupBy("r").agg(F.sum("n").alias("n"))

    def of(own: DataFrame, module: str, record: str, sample: str, locus: str | None, parameters: dict[str, str], **counts: str) -> DataFrame:
        told = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.expr(v).cast("long"))])
        kept = F.map_filter(told, lambda k, v: v.isNotNull())
        known = F.create_map(*[x for k, v in parameters.items() for x in (F.lit(k), F.expr(v).cast("string"))]) if parameters else F.expr("cast(map() as map<string,string>)")
        return own.select(
            c("r").cast("string").alias("run_id"), F.lit(module).alias("module"), F.expr(record).alias("record_id"), F.expr(f"CASE WHEN {sample} IS NULL THEN 'run' ELSE 'sample' END").alias("scope_type"),
            F.expr(f"cast({sample} as string)").alias("sample"), F.lit(locus).cast("string").alias("locus"), F.lit("2024-02-03T04:05:06.789+00:00").alias("finished_at"), kept.alias("counts"), known.alias("parameters"))

    parts = [
        of(whole, "filter", "'run'", "null", None, {"min_quality": "r + 10"}, input_reads="n + 30", filtered_reads="n + 10"),
        of(whole, "demux", "'run'", "null", None, {}, input_reads="n + 10", matched_reads="n"), of(b, "demux", "s", "s", None, {}, assigned_reads="n"),
        of(b, "collapse", "s", "s", None, {"library": "CASE r % 4 WHEN 0 THEN 'bulk' WHEN 1 THEN 'Visium' WHEN 2 THEN 'visiumhd' ELSE 'other' END"}, input_reads="n", annotated_reads="n - n % 7",
           length_filtered_reads="CASE WHEN r % 2 = 0 THEN n - n % 7 END", retained_group_reads="m", consensus_sequences="m - m % 5"),
        of(b, "seqtag", "s", "s", None, {}, input_sequences="m", matched_sequences="t", split_ig_sequences="t - t % 3", split_tr_sequences="t % 3"),
        of(b, "airr", "concat(s, '_ig')", "s", "ig", {}, input_sequences="t - t % 3", airr_sequences="t div 2", productive_sequences="t div 3", productive_heavy_sequences="t div 4"),
        of(b.where("r % 2 = 1"), "airr", "concat(s, '_tr')", "s", "tr", {}, input_sequences="t % 3", airr_sequences="t % 2")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""WITH b AS (SELECT o_custkey % 5 AS r, 's' || substr(o_orderpriority, 1, 1) AS s, count(*) AS n, count(*) FILTER (o_orderstatus <> 'F') AS m, count(*) FILTER (o_orderstatus = 'O') AS t FROM orders GROUP BY ALL),
w AS (SELECT r, sum(n)::BIGINT AS n FROM b GROUP BY r),
e(r, s, mo, lo, rec, i, step, path, a, z, before, after) AS (
 SELECT r, '', 10, 100, 'run', 0, 'Filtering', 'run', n + 30, n + 10, 'Unfiltered reads', 'Filtered reads (minimum quality: ' || (r + 10) || ')' FROM w
 UNION ALL SELECT r, '', 20, 100, 'run', 1, 'Demux', 'run', n + 10, n, 'Filtered reads', 'Reads with a valid UDI assignment' FROM w
 UNION ALL SELECT r, s, 20, 100, s, 50, 'Demux', s, w.n, b.n, 'Reads with a valid UDI assignment', 'Reads assigned to ' || s FROM b JOIN w USING (r)
 UNION ALL SELECT r, s, 30, 100, s, 2, 'Collapse', s || ' | Annotation', n, n - n % 7, 'Reads entering collapse', CASE r % 4 WHEN 0 THEN 'Reads with valid UMI annotation' WHEN 1 THEN 'Reads with valid spatial barcode/UMI annotation'
   WHEN 2 THEN 'Reads with valid Visium HD spatial barcode/UMI annotation' ELSE 'Reads with valid barcode/UMI annotation' END FROM b
 UNION ALL SELECT r, s, 30, 100, s, 3, 'Collapse', s || ' | Length filtering', n - n % 7, n - n % 7, 'Annotated reads', 'Annotated reads passing length filters' FROM b WHERE r % 2 = 0
 UNION ALL SELECT r, s, 30, 100, s, 4, 'Collapse', s || ' | Group retention', n - n % 7, m, 'Length-filtered reads', 'Reads retained for consensus generation' FROM b WHERE r % 2 = 0
 UNION ALL SELECT r, s, 30, 100, s, 5, 'Collapse', s || ' | Consensus', m, m - m % 5, 'Reads retained in receptor groups', 'Consensus sequences generated' FROM b
 UNION ALL SELECT r, s, 40, 100, s, 6, 'Seqtag', s, m, t, 'Consensus sequences', 'Sequences matching provided seqtag anchors' FROM b
 UNION ALL SELECT r, s, 40, 100, s, 70, 'Seqtag', s || ' | Ig', t, t - t % 3, 'Sequences matching provided seqtag anchors', 'Sequences assigned to Ig' FROM b
 UNION ALL SELECT r, s, 40, 100, s, 71, 'Seqtag', s || ' | TCR', t, t % 3, 'Sequences matching provided seqtag anchors', 'Sequences assigned to TCR' FROM b
 UNION ALL SELECT r, s, 50, 0, s || '_ig', 7, 'AIRR', s || ' | Ig', t - t % 3, t // 2, 'Sequences provided to AIRR annotation', 'Sequences with valid V(D)J annotation' FROM b
 UNION ALL SELECT r, s, 50, 0, s || '_ig', 8, 'AIRR', s || ' | Ig', t // 2, t // 3, 'Sequences with valid V(D)J annotation', 'Productive receptor sequences' FROM b
 UNION ALL SELECT r, s, 50, 0, s || '_ig', 9, 'AIRR', s || ' | Ig', t // 3, t // 4, 'Productive immunoglobulin receptor sequences', 'Productive heavy-chain receptor sequences' FROM b
 UNION ALL SELECT r, s, 50, 0, s || '_ig', 60, '>AIRRRate', s || ' | Ig', t - t % 3, t // 3, 'Sequences provided to AIRR annotation', 'Productive receptor sequences' FROM b
 UNION ALL SELECT r, s, 50, 1, s || '_tr', 7, 'AIRR', s || ' | TCR', t % 3, t % 2, 'Sequences provided to AIRR annotation', 'Sequences with valid V(D)J annotation' FROM b WHERE r % 2 = 1
 UNION ALL SELECT r, s, 50, 1, s || '_tr', 60, '>AIRRRate', s || ' | TCR', t % 3, t % 2, 'Sequences provided to AIRR annotation', 'Sequences with valid V(D)J annotation' FROM b WHERE r % 2 = 1)
SELECT r::VARCHAR AS run_id, row_number() OVER (PARTITION BY r ORDER BY s, mo, lo, rec, i, path)::INT AS place, step AS "Step", path AS "PathInfo", '2024-02-03 04:05:06' AS "Date", a::BIGINT AS "InputReads", z::BIGINT AS "OutputReads",
 round(z * 100.0 / nullif(a, 0), 6)::DOUBLE AS "PercentRetained", before AS "InputDescription", after AS "OutputDescription" FROM e""")
def run_summary(spark, sf_dir):
    """The whole summary of each run, in its order."""
    rows = runmeta.summary_rows(whole_records(spark, sf_dir))
    place = F.row_number().over(W.partitionBy("run_id").orderBy("ord"))
    return rows.withColumn("place", place).withColumn("PercentRetained", F.round("PercentRetained", 6)).drop("ord")


_COUNTED = """b AS (SELECT o_custkey % 5 AS r, 's' || substr(o_orderpriority, 1, 1) AS s, count(*) AS n, count(*) FILTER (o_orderstatus <> 'F') AS m, count(*) FILTER (o_orderstatus = 'O') AS t FROM orders GROUP BY ALL),
w AS (SELECT r, sum(n)::BIGINT AS n, count(*) AS k FROM b GROUP BY r)"""


def counted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs of which some have a wrong sum, a wrong number of samples, or counts that a later module does not confirm."""
    c = F.col
    b = table(spark, sf_dir, "orders").groupBy((c("o_custkey") % 5).alias("r"), F.concat(F.lit("s"), F.substring("o_orderpriority", 1, 1)).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(c("o_orderstatus") != "F").alias("m"), F.count_if(c("o_orderstatus") == "O").alias("t"))
    w = b.groupBy("r").agg(F.sum("n").alias("n"), F.count("*").alias("k"))

    def of(own: DataFrame, module: str, record: str, sample: str, locus: str, **counts: str) -> DataFrame:
        scope = {("null", "null"): "run", ("s", "null"): "sample", ("null", "'ig'"): "locus"}.get((sample, locus), "sample_locus")
        return own.select(
            c("r").cast("string").alias("run_id"), F.lit(module).alias("module"), F.expr(record).alias("record_id"), F.lit(scope).alias("scope_type"), F.expr(f"cast({sample} as string)").alias("sample"),
            F.expr(f"cast({locus} as string)").alias("locus"), F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.expr(v).cast("long"))]).alias("counts"))

    parts = [
        of(w, "demux", "'run'", "null", "null", input_reads="n + 10", matched_reads="n", forward_matched_reads="n div 2", reverse_matched_reads="n - n div 2 + if(r = 1, 1, 0)",
           unmatched_reads="10 + if(r = 2, 3, 0)", sample_count="k + if(r = 3, 1, 0)"),
        of(b, "demux", "s", "s", "null", assigned_reads="n + if(r = 4 and s = 's1', 2, 0)"), of(b, "collapse", "s", "s", "null", input_reads="n", consensus_sequences="m"),
        of(b, "seqtag", "s", "s", "null", input_sequences="m + if(r = 0 and s = 's2', 5, 0)", matched_sequences="t", failed_sequences="m - t", split_ig_sequences="t - t % 3", split_tr_sequences="t % 3 + if(s = 's3', 1, 0)"),
        of(b, "airr", "concat(s, '_ig')", "s", "'ig'", input_sequences="t - t % 3 + if(r = 1, 1, 0)"), of(b, "airr", "concat(s, '_tr')", "s", "'tr'", input_sequences="t % 3")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""WITH {_COUNTED} SELECT r::VARCHAR AS run_id, 'demux' AS module, 'run' AS record_id, 'matched_reads' AS whole, n + 1 AS parts_sum, n AS value FROM w WHERE r = 1
UNION ALL SELECT r::VARCHAR, 'demux', 'run', 'input_reads', n + 13, n + 10 FROM w WHERE r = 2 UNION ALL SELECT r::VARCHAR, 'seqtag', s, 'input_sequences', m, m + 5 FROM b WHERE r = 0 AND s = 's2'
UNION ALL SELECT r::VARCHAR, 'seqtag', s, 'matched_sequences', t + 1, t FROM b WHERE s = 's3'""")
def sum_checks(spark, sf_dir):
    return runmeta.wrong_sums(counted_records(spark, sf_dir))


@query(f"""WITH {_COUNTED} SELECT r::VARCHAR AS run_id, k + CASE WHEN r = 3 THEN 1 ELSE 0 END AS sample_count, n AS matched_reads, k AS n_samples, n + CASE WHEN r = 4 THEN 2 ELSE 0 END AS assigned_reads, k AS n_assigned
FROM w WHERE r IN (3, 4)""")
def sample_number_checks(spark, sf_dir):
    return runmeta.sample_totals(counted_records(spark, sf_dir))


@query(f"""WITH {_COUNTED} SELECT r::VARCHAR AS run_id, 'demux/' || s AS "left", 'assigned_reads' AS left_key, n + 2 AS left_value, 'collapse/' || s AS "right", 'input_reads' AS right_key, n AS right_value FROM b WHERE r = 4 AND s = 's1'
UNION ALL SELECT r::VARCHAR, 'collapse/' || s, 'consensus_sequences', m, 'seqtag/' || s, 'input_sequences', m + 5 FROM b WHERE r = 0 AND s = 's2'
UNION ALL SELECT r::VARCHAR, 'seqtag/' || s, 'ig input', t - t % 3, 'airr/' || s || '_ig', 'input_sequences', t - t % 3 + 1 FROM b WHERE r = 1
UNION ALL SELECT r::VARCHAR, 'seqtag/' || s, 'tr input', t % 3 + 1, 'airr/' || s || '_tr', 'input_sequences', t % 3 FROM b WHERE s = 's3'""")
def handover_checks(spark, sf_dir):
    return runmeta.mismatches(counted_records(spark, sf_dir))


#: Keys of recorded files, of which each record has some.
_KEYS = [
    "input_fastq", "filtered_fastq", "filtered_fasta", "nanoplot_report", "log", "input_barcodes", "input_sequences", "sample_fasta", "unmatched_fasta", "forward_matched_fasta", "matched_fasta",
    "visium_spatial_barcodes", "consensus_fasta", "failed_adaptive_filter", "annotated_sequences", "split_ig_fasta", "split_tr_fasta", "failed_fasta", "igblast_database", "airr_tsv",
    "productive_airr_tsv", "productive_heavy_airr_tsv", "igblast_fmt7", "INPUT_extra", "run_QC", "notes"]
_MODULE = "CASE event_id % 6 WHEN 0 THEN 'filter' WHEN 1 THEN 'demux' WHEN 2 THEN 'collapse' WHEN 3 THEN 'seqtag' WHEN 4 THEN 'airr' ELSE 'polish' END"


@query(f"""WITH k AS (SELECT unnest({_KEYS!r}) AS key, unnest(range({len(_KEYS)})) AS i),
f AS (SELECT event_id, {_MODULE} AS module, key FROM events, k WHERE (event_id // 6 + i * 7) % (i % 4 + 2) < 2),
g AS (SELECT *, bool_or(key LIKE 'split!_%!_fasta' ESCAPE '!') OVER (PARTITION BY event_id) AS split, bool_or(key = 'productive_airr_tsv') OVER (PARTITION BY event_id) AS prod FROM f)
SELECT 'r' || event_id % 3 AS run_id, module, event_id::VARCHAR AS record_id, key, '/' || key AS path, CASE
 WHEN module = 'filter' AND key = 'input_fastq' OR module = 'demux' AND key IN ('input_barcodes', 'input_sequences') OR module = 'collapse' AND key IN ('input_sequences', 'visium_spatial_barcodes')
  OR module = 'seqtag' AND key = 'input_sequences' OR module = 'airr' AND key IN ('input_sequences', 'igblast_database') THEN 'inputs'
 WHEN module = 'filter' AND key IN ('filtered_fastq', 'filtered_fasta') OR module = 'demux' AND key = 'sample_fasta' OR module = 'collapse' AND key = 'consensus_fasta'
  OR module = 'seqtag' AND (key LIKE 'split!_%!_fasta' ESCAPE '!' OR key = 'matched_fasta' AND NOT split) OR module = 'airr' AND (key LIKE 'productive!_%' ESCAPE '!' OR key = 'airr_tsv' AND NOT prod) THEN 'outputs'
 WHEN module = 'demux' AND key IN ('forward_matched_fasta', 'matched_fasta') OR module = 'collapse' AND key = 'annotated_sequences' OR module = 'seqtag' AND key = 'matched_fasta' OR module = 'airr' AND key IN ('airr_tsv', 'igblast_fmt7') THEN 'intermediates'
 WHEN module = 'demux' AND key = 'unmatched_fasta' THEN 'diagnostics' WHEN lower(key) LIKE 'input!_%' ESCAPE '!' THEN 'inputs' WHEN regexp_matches(lower(key), 'log|qc|failed|nanoplot') THEN 'diagnostics' ELSE 'other' END AS kind FROM g""")
def file_classes(spark, sf_dir):
    each = table(spark, sf_dir, "events").select("event_id", F.expr(_MODULE).alias("module"), F.posexplode(F.array(*map(F.lit, _KEYS))).alias("i", "key"))
    held = each.where("(event_id div 6 + i * 7) % (i % 4 + 2) < 2").groupBy("event_id", "module").agg(F.map_from_entries(F.collect_list(F.struct("key", F.concat(F.lit("/"), "key").alias("path")))).alias("files"))
    return runmeta.file_kinds(held.select(F.concat(F.lit("r"), F.col("event_id") % 3).alias("run_id"), "module", F.col("event_id").cast("string").alias("record_id"), "files"))


@query("""WITH p(r, module, record_id, key, value) AS (
 SELECT o_orderkey % 3, 'filter', o_orderkey::VARCHAR, 'min_quality', (o_orderkey % 20)::VARCHAR FROM orders UNION ALL SELECT o_orderkey % 3, 'filter', o_orderkey::VARCHAR, 'chunk_size', o_orderstatus FROM orders
 UNION ALL SELECT o_orderkey % 3, 'airr', o_orderkey::VARCHAR, 'locus', CASE WHEN o_orderstatus = 'F' THEN NULL ELSE lower(o_orderstatus) END FROM orders)
SELECT 'r' || r AS run_id, module, record_id, CASE WHEN key = 'chunk_size' THEN 'Internal and fixed settings' ELSE 'Command parameters' END AS section,
 CASE key WHEN 'min_quality' THEN '--min-qual' WHEN 'locus' THEN '--loci' ELSE 'Chunk Size' END AS label, coalesce(value, 'null') AS value FROM p""")
def parameter_flags(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    run = (F.concat(F.lit("r"), F.col("o_orderkey") % 3).alias("run_id"), F.col("o_orderkey").cast("string").alias("record_id"))
    told = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), v)]).alias("parameters")
    own = o.select(*run, F.lit("filter").alias("module"), told(min_quality=(F.col("o_orderkey") % 20).cast("string"), chunk_size=F.col("o_orderstatus"))).unionByName(
        o.select(*run, F.lit("airr").alias("module"), told(locus=F.when(F.col("o_orderstatus") != "F", F.lower("o_orderstatus")))))
    return runmeta.parameter_flags(own)


@query(f"WITH {_FULL}, w AS (SELECT run_id, sum(n) AS a FROM b GROUP BY run_id) SELECT run_id, s AS sample, n AS assigned, round(n * 100.0 / a, 6)::DOUBLE AS pct_matched, round(n * 100.0 / (a + 10), 6)::DOUBLE AS pct_input FROM b JOIN w USING (run_id)")
def demux_samples_share(spark, sf_dir):
    return runmeta.demux_overview(full_records(spark, sf_dir))


@query(f"""WITH {_FULL}, a AS (SELECT run_id, 'ig' AS locus, s AS sample, t AS i, t - t % 3 AS v, t // 2 AS p FROM b UNION ALL SELECT run_id, 'tr', s, t, t, t // 3 FROM b WHERE s < '3' AND r % 2 = 1)
SELECT run_id, locus, sample, sum(i)::BIGINT AS input, sum(v)::BIGINT AS valid, sum(p)::BIGINT AS productive, round(sum(v) * 100.0 / nullif(sum(i), 0), 6)::DOUBLE AS annotation_rate, round(sum(p) * 100.0 / nullif(sum(v), 0), 6)::DOUBLE AS productive_rate,
 greatest(sum(v) - sum(p), 0)::BIGINT AS nonproductive, greatest(sum(i) - sum(v), 0)::BIGINT AS unannotated FROM a GROUP BY GROUPING SETS ((run_id, locus), (run_id, locus, sample))""")
def locus_rates(spark, sf_dir):
    return runmeta.loci(full_records(spark, sf_dir)).drop("heavy", "is_total")


@query(f"WITH {_FULL} SELECT run_id, (sum(m) + CASE WHEN any_value(r) % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS value FROM b GROUP BY run_id")
def run_before_samples(spark, sf_dir):
    return runmeta.module_sum(full_records(spark, sf_dir), "collapse", "consensus_sequences")


# --- sequence search (beyond SQL; tests compare with brute force) ----------------------------------------------------------

ANCHORS = [("A1", "ACGTTGCAAC"), ("A2", "GGATCCTTAG"), ("Ig | 1 | IGHA", "CCAATTGGAC")]


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with an anchor, some with a wrong base, some turned."""
    e = table(spark, sf_dir, "events").selectExpr("event_id", f"{dna('event_id')} AS a", f"{dna('event_id + 500000')} AS b")
    n = F.col("event_id") % 4
    core = F.when(n == 0, "ACGTTGCAAC").when(n == 1, "GGATCCTAAG").when(n == 2, "CCAATTGGAC").otherwise("")
    seq = F.concat(F.substring("a", 1, 12), core, "b")
    return e.select(F.col("event_id").alias("read_id"), F.when(F.col("event_id") % 6 == 5, S.reverse_complement(seq)).otherwise(seq).alias("sequence"))


#: Each anchor and all strings one edit away from it, with their number of edits, and the reads of both strands.
_NEAR = f"""anchors(id, seq, ord) AS (VALUES {', '.join(f"('{n}', '{q}', {i})" for i, (n, q) in enumerate(ANCHORS))}),
places AS (SELECT *, unnest(range(0, length(seq) + 1)) AS i FROM anchors), letters(c) AS (VALUES ('A'), ('C'), ('G'), ('T')),
near AS (SELECT id, ord, 0 AS d, seq AS v FROM anchors UNION SELECT id, ord, 1, substr(seq, 1, i) || substr(seq, i + 2) FROM places WHERE i < length(seq)
 UNION SELECT id, ord, 1, substr(seq, 1, i) || c || substr(seq, i + 1) FROM places, letters UNION SELECT id, ord, 1, substr(seq, 1, i) || c || substr(seq, i + 2) FROM places, letters WHERE i < length(seq)),
made AS (SELECT event_id, substr({dna('event_id')}, 1, 12) || CASE event_id % 4 WHEN 0 THEN 'ACGTTGCAAC' WHEN 1 THEN 'GGATCCTAAG' WHEN 2 THEN 'CCAATTGGAC' ELSE '' END || {dna('event_id + 500000')} AS s FROM events),
own AS (SELECT event_id AS read_id, CASE WHEN event_id % 6 = 5 THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS s FROM made),
strands AS (SELECT read_id, 0 AS turned, s FROM own UNION ALL SELECT read_id, 1, reverse(translate(s, 'ACGT', 'TGCA')) FROM own)"""


@query(f"""WITH {_NEAR}, hit AS (SELECT read_id, min({{'t': turned, 'd': d, 'o': ord, 'id': id}}) AS h FROM strands JOIN near ON contains(substr(s, 1, 30), v) GROUP BY read_id)
SELECT h.id AS anchor_id, CASE h.t WHEN 0 THEN '+' WHEN 1 THEN '-' END AS strand, h.d / 10.0::DOUBLE AS error, count(*) AS n FROM own LEFT JOIN hit USING (read_id) GROUP BY ALL""")
def demux_calls(spark, sf_dir):
    """Anchor, strand and share of edits of planted reads, and of those that match by chance."""
    a = spark.createDataFrame(ANCHORS, "anchor_id string, seq string")
    return anchors.match_anchors(planted(spark, sf_dir), a, 30, 0.1).groupBy("anchor_id", "strand", "error").agg(F.count("*").alias("n"))


@query()
def demux_samples(spark, sf_dir):
    a = spark.createDataFrame(ANCHORS, "anchor_id string, seq string")
    return anchors.cut(anchors.match_anchors(planted(spark, sf_dir), a, 30, 0.1), barcode=True).groupBy("anchor_id", "strand").agg(F.count("*").alias("n"), F.sum(F.length("barcode")).alias("barcode_bases"))


@query(f"""WITH {_NEAR}, hit AS (SELECT read_id, min({{'t': turned, 'd': d, 'o': ord, 'id': id}}) AS h FROM strands JOIN near ON contains(substr(s, greatest(length(s) - 45, 0) + 1), v) GROUP BY read_id),
tag AS (SELECT h.id AS id FROM own LEFT JOIN hit USING (read_id))
SELECT 'ig' AS locus, count(*) AS n FROM tag WHERE contains(id, 'Ig') UNION ALL SELECT 'tr', count(*) FROM tag WHERE contains(id, 'A') UNION ALL SELECT NULL, count(*) FROM tag WHERE id IS NULL OR NOT contains(id, 'Ig') AND NOT contains(id, 'A')""")
def seqtag_split(spark, sf_dir):
    a = spark.createDataFrame(ANCHORS, "anchor_id string, seq string")
    tagged = anchors.match_anchors(planted(spark, sf_dir), a, 45, 0.1, tail=True)
    return anchors.tag_split(tagged, {"ig": "Ig", "tr": "A"}).groupBy("locus").agg(F.count("*").alias("n"))


@query()
def molecule_alignment(spark, sf_dir):
    own = reads(spark, sf_dir).select("read_id", "user_id", F.substr("sequence", F.lit(1), F.length("sequence") - F.col("read_id") % 3).alias("sequence"))
    bounded = groups.subsample(own, "user_id", groups.MAX_READS, "read_id")
    return consensus.consensus(consensus.align_groups(bounded, "user_id"), "user_id", max_error=1.0)


def amino_acids(seq: str) -> str:
    """SQL that translates whole codons of A, C, G, T."""
    digit = lambda k: f"(strpos('TCAG', substr({seq}, 3 * i + {k}, 1)) - 1)"
    return f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda i: substr('{vdj.AMINO_ACIDS}', 1 + 16 * {digit(1)} + 4 * {digit(2)} + {digit(3)}, 1)), '')"


_V = [("IGHV1*01", "ACGTTGCAACGGTTAACCTGGATCTGT"), ("IGHV2*01", "GGATCCTTAGCATGCATTACGGATTGT")]
_J = [("IGHJ1*01", "TGGGGCCAAGGAACC"), ("IGHJ2*01", "TGGGGTCGTGGTACA")]
_INSERT = f"substr({dna('user_id')}, 1, CAST(9 + event_id % 4 AS INT))"
_GERMLINES = "allele string, locus string, segment string, seq string, anchor int"


@query(f"""WITH p AS (SELECT event_id, 'TGT' || {_INSERT} || 'TGG' AS junction FROM events), a AS (SELECT *, {amino_acids('junction')} AS junction_aa FROM p)
SELECT event_id AS read_id, CASE WHEN event_id % 2 = 0 THEN 'IGHV1*01' ELSE 'IGHV2*01' END AS v_call, CASE WHEN event_id % 3 = 0 THEN 'IGHJ1*01' ELSE 'IGHJ2*01' END AS j_call,
  junction, junction_aa, length(junction)::INT AS junction_length, length(junction) % 3 = 0 AND NOT contains(junction_aa, '*') AS productive FROM a""")
def vdj_annotation(spark, sf_dir):
    """Reads of a V, an insert and a J."""
    g = spark.createDataFrame([(n, "IGH", "V", s, len(s) - 3) for n, s in _V] + [(n, "IGH", "J", s, 0) for n, s in _J], _GERMLINES)
    e = table(spark, sf_dir, "events").selectExpr("event_id AS read_id", f"concat(CASE WHEN event_id % 2 = 0 THEN '{_V[0][1]}' ELSE '{_V[1][1]}' END, {_INSERT}, CASE WHEN event_id % 3 = 0 THEN '{_J[0][1]}' ELSE '{_J[1][1]}' END) AS sequence")
    return vdj.to_airr(vdj.annotate(e, g)).select("read_id", "v_call", "j_call", "junction", "junction_aa", "junction_length", "productive")


#: Germlines whose planted insertion and deletion can be aligned in one way only.
LONG = {
    "V": [("TRBV1*01", "ATTACCGCACCCAACTTTGATTGGGTCATAAACAAACATCATGTTTCTGGAGGCGGTTTGTGAGACCGACAAACGCGATAGTGTGCGAGA"),
          ("TRBV2*01", "GGGAGGGACATTAGTATGCCCATTATTGGAAACTGACTGTGTATTTCAAAATGCGGGCTCGCGGACTCTTTCAATCCCCTATGTGCGAGA")],
    "D": [("TRBD1*01", "CAGCCTAATTTTAAGCTG"), ("TRBD2*01", "AAACTAGGATACCAATGAGG")],
    "J": [("TRBJ1*01", "TGGGGCCAAGGGACCTTGGATTACAGAAAGTTA"), ("TRBJ2*01", "TGGGGTCGTGGTACATCCGTTGAACCCCTCACG")],
    "C": [("TRBC1*01", "CCGGATATGGCACAGTCGAGGAAAACGAATCTGCAGTAGT"), ("TRBC2*01", "CATTACTATCTGGGCTTTTCTTGCTGCGTCTGAAGTCCTA")],
}
_ANCHOR = {"V": 81, "J": 0}


def _dealt(segment: str, field: int, key: str) -> str:
    return f"CASE WHEN ({key}) % 2 = 0 THEN '{LONG[segment][0][field]}' ELSE '{LONG[segment][1][field]}' END"


#: Of four reads one has 3 bases of V deleted, one 2 inserted, one a wrong base, each before the junction; one in seven is turned.
_PARTS = {
    "lead": f"substr({dna('event_id')}, 1, CAST(event_id % 9 AS INT))", "v": _dealt("V", 1, "event_id"), "d": _dealt("D", 1, "user_id"), "j": _dealt("J", 1, "event_id + user_id"),
    "c": _dealt("C", 1, "user_id + 1"), "n1": f"substr({dna('event_id + 7')}, 1, CAST(event_id % 5 AS INT))", "n2": f"substr({dna('event_id + 8')}, 1, CAST(event_id % 4 AS INT))",
    "v_call": _dealt("V", 0, "event_id"), "d_call": _dealt("D", 0, "user_id"), "j_call": _dealt("J", 0, "event_id + user_id"), "c_call": _dealt("C", 0, "user_id + 1"),
}
_DAMAGED = ("CASE event_id % 4 WHEN 0 THEN v WHEN 1 THEN substr(v, 1, 40) || substr(v, 44) WHEN 2 THEN substr(v, 1, 50) || 'AC' || substr(v, 51) "
            "ELSE substr(v, 1, 60) || translate(substr(v, 61, 1), 'ACGT', 'CATG') || substr(v, 62) END")


@query(f"""WITH p AS (SELECT event_id, {', '.join(f'{x} AS {n}' for n, x in _PARTS.items())} FROM events),
r AS (SELECT *, {_DAMAGED} AS own, substr(v, 82) || n1 || d || n2 || substr(j, 1, 3) AS junction FROM p), a AS (SELECT *, {amino_acids('junction')} AS junction_aa FROM r)
SELECT event_id AS read_id, 'TRB' AS locus, v_call, d_call, j_call, c_call, event_id % 7 = 0 AS rev_comp, (length(lead) + 1)::INT AS v_sequence_start, (length(lead || own))::INT AS v_sequence_end,
  CASE WHEN lead = '' THEN '' ELSE length(lead) || 'S' END || CASE event_id % 4 WHEN 1 THEN '40M3D47M' WHEN 2 THEN '50M2I40M' ELSE '90M' END
    || length(n1 || d || n2 || j || c) || 'S' AS v_cigar,
  round(CASE event_id % 4 WHEN 1 THEN 87 / 90.0 WHEN 2 THEN 90 / 92.0 WHEN 3 THEN 89 / 90.0 ELSE 1.0 END, 6)::DOUBLE AS v_identity,
  junction, junction_aa, length(junction)::INT AS junction_length, length(junction) % 3 = 0 AND NOT contains(junction_aa, '*') AS productive,
  CASE event_id % 4 WHEN 1 THEN substr(v, 1, 40) || '---' || substr(v, 44) WHEN 3 THEN own ELSE v END AS v_alignment FROM a""")
def vdj_indels(spark, sf_dir):
    """Reads with planted insertions and deletions: the junction moves with them."""
    g = spark.createDataFrame([(n, "TRB", seg, s, _ANCHOR.get(seg)) for seg, some in LONG.items() for n, s in some], _GERMLINES)
    parts = table(spark, sf_dir, "events").selectExpr("event_id", *[f"{x} AS {n}" for n, x in _PARTS.items()])
    whole = parts.selectExpr("event_id AS read_id", f"concat(lead, {_DAMAGED}, n1, d, n2, j, c) AS sequence")
    turned = whole.withColumn("sequence", F.when(F.col("read_id") % 7 == 0, S.reverse_complement(F.col("sequence"))).otherwise(F.col("sequence")))
    return vdj.to_airr(vdj.annotate(turned, g)).select(
        "read_id", "locus", "v_call", "d_call", "j_call", "c_call", "rev_comp", "v_sequence_start", "v_sequence_end", "v_cigar", F.round("v_identity", 6).alias("v_identity"),
        "junction", "junction_aa", "junction_length", "productive", F.substring("sequence_alignment", 1, 90).alias("v_alignment"))
