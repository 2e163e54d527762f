"""Run records as a relation, and the summaries and checks made from it.

records: run_id, module, record_id, scope_type, sample, locus, status, started_at, finished_at (strings),
duration_seconds, counts map<string,bigint>, parameters map<string,string>, files map<string,string>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sequence as S

#: Order of modules and loci.
MODULES = {"basecall": 0, "filter": 10, "demux": 20, "collapse": 30, "seqtag": 40, "airr": 50}
LOCI = {"ig": 0, "tr": 1}
SCOPES = ("run", "sample", "locus", "sample_locus")
STATES = ("success", "failed", "skipped")

RECORDS = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("run_id", "module", "record_id", "scope_type", "sample", "locus", "status", "started_at", "finished_at")),
    T.StructField("duration_seconds", T.DoubleType()), T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())), T.StructField("files", T.MapType(T.StringType(), T.StringType())),
])

#: The counts of each module that may only fall from one to the next.
CHAINS = {
    "filter": ("input_reads", "filtered_reads"),
    "demux": ("input_reads", "matched_reads"),
    "collapse": ("input_reads", "annotated_reads", "length_filtered_reads", "retained_group_reads", "consensus_sequences"),
    "seqtag": ("input_sequences", "matched_sequences"),
    "airr": ("input_sequences", "airr_sequences", "productive_sequences", "productive_heavy_sequences"),
}
#: A module's counts of which the parts must sum to the whole.
SUMS = (
    ("demux", ("forward_matched_reads", "reverse_matched_reads"), "matched_reads"),
    ("demux", ("matched_reads", "unmatched_reads"), "input_reads"),
    ("seqtag", ("matched_sequences", "failed_sequences"), "input_sequences"),
)
#: Counts that one module hands to another (scopes that meet, and whether by sample).
HANDOVERS = (
    ("filter", "filtered_reads", "demux", "input_reads", "run"), ("filter", "filtered_reads", "collapse", "input_reads", "run"),
    ("collapse", "consensus_sequences", "seqtag", "input_sequences", "run"), ("demux", "assigned_reads", "collapse", "input_reads", "sample"),
    ("collapse", "consensus_sequences", "seqtag", "input_sequences", "sample"),
)
#: Texts of the summary's transitions: module, from count, to count, part of the path, input and output description.
TRANSITIONS = (
    ("filter", "Filtering", "input_reads", "filtered_reads", "", "Unfiltered reads", "Filtered reads"),
    ("demux", "Demux", "input_reads", "matched_reads", "", "Filtered reads", "Reads with a valid UDI assignment"),
    ("collapse", "Collapse", "input_reads", "annotated_reads", "Annotation", "Reads entering collapse", "Reads with valid barcode/UMI annotation"),
    ("collapse", "Collapse", "annotated_reads", "length_filtered_reads", "Length filtering", "Annotated reads", "Annotated reads passing length filters"),
    ("collapse", "Collapse", "length_filtered_reads", "retained_group_reads", "Group retention", "Length-filtered reads", "Reads retained for consensus generation"),
    ("collapse", "Collapse", "retained_group_reads", "consensus_sequences", "Consensus", "Reads retained in receptor groups", "Consensus sequences generated"),
    ("seqtag", "Seqtag", "input_sequences", "matched_sequences", "", "Consensus sequences", "Sequences matching provided seqtag anchors"),
    ("airr", "AIRR", "input_sequences", "airr_sequences", "", "Sequences provided to AIRR annotation", "Sequences with valid V(D)J annotation"),
    ("airr", "AIRR", "airr_sequences", "productive_sequences", "", "Sequences with valid V(D)J annotation", "Productive receptor sequences"),
    ("airr", "AIRR", "productive_sequences", "productive_heavy_sequences", "", "Productive immunoglobulin receptor sequences", "Productive heavy-chain receptor sequences"),
)
#: What an annotated read is, by library.
LIBRARY_TEXTS = {
    "visiumhd": "Reads with valid Visium HD spatial barcode/UMI annotation", "visium": "Reads with valid spatial barcode/UMI annotation",
    "bulk": "Reads with valid UMI annotation",
}


def count(name: str) -> Column:
    return F.try_element_at("counts", F.lit(name))


def _rank(column: str, order: dict[str, int]) -> Column:
    out = F.lit(100)
    for k, v in order.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out


def ordered(records: DataFrame) -> DataFrame:
    return records.orderBy(_rank("module", MODULES), "module", F.coalesce("sample", F.lit("")), _rank("locus", LOCI), "locus", "record_id")


# --- validation ---------------------------------------------------------------------------------------

def errors(records: DataFrame, run_id: str | None = None) -> DataFrame:
    """(module, record_id, problem) of records that cannot be used."""
    checks = [
        (~F.col("status").isin(*STATES), "unknown status"), (~F.col("scope_type").isin(*SCOPES), "unknown scope"),
        (F.exists(F.map_values("counts"), lambda v: v < 0), "negative count"),
        (F.to_timestamp("finished_at") < F.to_timestamp("started_at"), "finished before start"),
    ]
    if run_id is not None:
        checks.append((F.col("run_id") != run_id, "other run"))
    found = F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in checks]), lambda x: x.isNotNull())
    single = records.select("module", "record_id", F.explode(found).alias("problem"))
    double = records.groupBy("module", "record_id").agg(F.count("*").alias("n")).where("n > 1").select("module", "record_id", F.lit("duplicate record").alias("problem"))
    return single.unionByName(double)


def rises(records: DataFrame) -> DataFrame:
    """Counts that exceed the one before them in their module's chain: run_id, module, record_id, key, value, previous_key, previous_value."""
    out = None
    for module, keys in CHAINS.items():
        own = records.where(F.col("module") == module)
        if module == "demux":
            own = own.where("scope_type = 'run'")
        steps = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("key"), count(k).alias("value")) for i, k in enumerate(keys)]), lambda s: s["value"].isNotNull())
        pairs = own.select("run_id", "module", "record_id", steps.alias("s")).where("size(s) > 1").select(
            "run_id", "module", "record_id", F.explode(F.zip_with(F.slice("s", 2, 100), F.slice("s", 1, F.size("s") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
        bad = pairs.where("p.a.value > p.b.value").select(
            "run_id", "module", "record_id", F.col("p.a.key").alias("key"), F.col("p.a.value").alias("value"), F.col("p.b.key").alias("previous_key"), F.col("p.b.value").alias("previous_value"))
        out = bad if out is None else out.unionByName(bad)
    return out


def wrong_sums(records: DataFrame) -> DataFrame:
    """Records whose parts do not sum to their whole: run_id, module, record_id, whole, parts_sum, value."""
    out = []
    for module, parts, whole in SUMS:
        total = count(parts[0]) + count(parts[1])
        out.append(records.where(F.col("module") == module).select("run_id", "module", "record_id", F.lit(whole).alias("whole"), total.alias("parts_sum"), count(whole).alias("value")))
    split = F.map_filter("counts", lambda k, v: k.rlike("^split_.+_sequences$"))
    total = F.aggregate(F.map_values(split), F.lit(0).cast("long"), lambda s, x: s + x)
    tags = records.where("module = 'seqtag'").where(F.size(split) > 0)
    out.append(tags.select("run_id", "module", "record_id", F.lit("matched_sequences").alias("whole"), total.alias("parts_sum"), count("matched_sequences").alias("value")))
    joined = out[0]
    for o in out[1:]:
        joined = joined.unionByName(o)
    return joined.where("parts_sum <> value")


def mismatches(records: DataFrame) -> DataFrame:
    """Counts that differ from what the module before handed over."""
    out = None
    for a, ka, b, kb, scope in HANDOVERS:
        side = lambda m, k, n: records.where((F.col("module") == m) & (F.col("scope_type") == scope)).select(
            "run_id", F.coalesce("sample", F.lit("")).alias("sample"), F.col("record_id").alias(f"{n}_record"), count(k).alias(f"{n}_value"))
        met = side(a, ka, "left").join(side(b, kb, "right"), ["run_id", "sample"]).where("left_value <> right_value").select(
            "run_id", F.concat_ws("/", F.lit(a), "left_record").alias("left"), F.lit(ka).alias("left_key"), "left_value",
            F.concat_ws("/", F.lit(b), "right_record").alias("right"), F.lit(kb).alias("right_key"), "right_value")
        out = met if out is None else out.unionByName(met)
    tags = records.where("module = 'seqtag'").select(
        "run_id", F.coalesce("sample", F.lit("")).alias("sample"), "scope_type", F.col("record_id").alias("left_record"),
        F.coalesce(count("split_ig_sequences"), count("matched_sequences")).alias("ig"),
        F.coalesce(count("split_tr_sequences"), count("split_tcr_sequences"), count("matched_sequences")).alias("tr"))
    own = records.where("module = 'airr' and scope_type in ('locus', 'sample_locus') and locus is not null").select(
        "run_id", F.coalesce("sample", F.lit("")).alias("sample"), F.when(F.col("scope_type") == "locus", "run").otherwise("sample").alias("scope_type"),
        F.lower("locus").alias("locus"), F.col("record_id").alias("right_record"), count("input_sequences").alias("right_value"))
    met = tags.join(own, ["run_id", "sample", "scope_type"]).withColumn("left_value", F.when(F.col("locus") == "ig", F.col("ig")).otherwise(F.col("tr"))).where("left_value <> right_value")
    return out.unionByName(met.select(
        "run_id", F.concat_ws("/", F.lit("seqtag"), "left_record").alias("left"), F.concat("locus", F.lit(" input")).alias("left_key"), "left_value",
        F.concat_ws("/", F.lit("airr"), "right_record").alias("right"), F.lit("input_sequences").alias("right_key"), "right_value"))


def unexpected_samples(records: DataFrame) -> DataFrame:
    """Samples of later modules that demultiplexing does not know (none where it recorded no samples): run_id, sample, modules."""
    known = records.where("module = 'demux' and scope_type = 'sample' and sample is not null").select("run_id", "sample").distinct()
    later = records.where(F.col("module").isin("collapse", "seqtag", "airr") & F.col("sample").isNotNull())
    later = later.join(known.select("run_id").distinct(), "run_id", "left_semi")
    return later.join(known, ["run_id", "sample"], "left_anti").groupBy("run_id", "sample").agg(F.array_join(F.array_sort(F.collect_set("module")), ", ").alias("modules"))


def sample_totals(records: DataFrame) -> DataFrame:
    """Demultiplexing runs whose sample number or assigned reads disagree with their samples' records."""
    run = records.where("module = 'demux' and scope_type = 'run'").select("run_id", count("sample_count").alias("sample_count"), count("matched_reads").alias("matched_reads"))
    per = records.where("module = 'demux' and scope_type = 'sample' and sample is not null").groupBy("run_id").agg(
        F.count("*").alias("n_samples"), F.sum(count("assigned_reads")).alias("assigned_reads"), F.count(count("assigned_reads")).alias("n_assigned"))
    both = run.join(per, "run_id", "left").na.fill({"n_samples": 0, "n_assigned": 0, "assigned_reads": 0})
    return both.where((F.col("sample_count") != F.col("n_samples")) | ((F.col("n_assigned") == F.col("n_samples")) & (F.col("assigned_reads") != F.col("matched_reads"))))


# --- summaries ------------------------------------------------------------------------------------------

def summary_rows(records: DataFrame) -> DataFrame:
    """Step, PathInfo, Date, InputReads, OutputReads, PercentRetained and descriptions, with ``ord`` to sort by."""
    runs = records.where("module = 'demux' and scope_type = 'run'").select(F.col("run_id").alias("_run"), count("matched_reads").alias("_matched"))
    own = records.join(runs, F.col("run_id") == F.col("_run"), "left")
    label = F.concat_ws(" | ", "sample", S.locus_label(F.coalesce("locus", "record_id")))
    library = F.lower(F.coalesce(F.try_element_at("parameters", F.lit("library")), F.lit("")))
    quality = F.try_element_at("parameters", F.lit("min_quality"))
    steps = []
    for i, (module, step, a, b, part, before, after) in enumerate(TRANSITIONS):
        text = F.lit(after)
        if a == "input_reads" and module == "filter":
            text = F.concat(text, F.coalesce(F.concat(F.lit(" (minimum quality: "), quality, F.lit(")")), F.lit("")))
        if b == "annotated_reads":
            for k, v in LIBRARY_TEXTS.items():
                text = F.when(library == k, v).otherwise(text)
        path = label if module == "airr" else F.concat_ws(" | ", "sample", F.lit(part)) if part else F.coalesce("sample", "record_id")
        holds = F.col("module") == module
        if module == "demux":
            holds = holds & (F.col("scope_type") == "run")
        steps.append(F.when(holds, F.struct(F.lit(i).alias("i"), F.lit(step).alias("Step"), path.alias("PathInfo"), count(a).alias("InputReads"), count(b).alias("OutputReads"), F.lit(before).alias("InputDescription"), text.alias("OutputDescription"))))
    steps.append(F.when((F.col("module") == "demux") & (F.col("scope_type") == "sample"), F.struct(
        F.lit(50).alias("i"), F.lit("Demux").alias("Step"), F.col("sample").alias("PathInfo"), F.col("_matched").alias("InputReads"), count("assigned_reads").alias("OutputReads"),
        F.lit("Reads with a valid UDI assignment").alias("InputDescription"), F.concat(F.lit("Reads assigned to "), "sample").alias("OutputDescription"))))
    final = F.coalesce(count("productive_sequences"), count("airr_sequences"))
    steps.append(F.when(F.col("module") == "airr", F.struct(
        F.lit(60).alias("i"), F.lit(">AIRRRate").alias("Step"), label.alias("PathInfo"), count("input_sequences").alias("InputReads"), final.alias("OutputReads"),
        F.lit("Sequences provided to AIRR annotation").alias("InputDescription"),
        F.when(count("productive_sequences").isNotNull(), "Productive receptor sequences").otherwise("Sequences with valid V(D)J annotation").alias("OutputDescription"))))
    plain = own.select("*", F.explode(F.filter(F.array(*steps), lambda s: s.isNotNull())).alias("s"))
    keys = F.map_filter("counts", lambda k, v: k.rlike("^split_.+_sequences$"))
    tags = own.where("module = 'seqtag'").select("*", F.explode(keys).alias("k", "v")).withColumn("name", F.regexp_extract("k", "^split_(.+)_sequences$", 1))
    split = F.struct(
        (F.lit(70) + _rank("name", LOCI)).alias("i"), F.lit("Seqtag").alias("Step"), F.concat_ws(" | ", "sample", S.locus_label(F.col("name"))).alias("PathInfo"),
        count("matched_sequences").alias("InputReads"), F.col("v").alias("OutputReads"), F.lit("Sequences matching provided seqtag anchors").alias("InputDescription"),
        F.concat(F.lit("Sequences assigned to "), S.locus_label(F.col("name"))).alias("OutputDescription"))
    both = plain.unionByName(tags.withColumn("s", split).drop("k", "v", "name")).where("s.InputReads is not null and s.OutputReads is not null")
    date = F.replace(F.substring("finished_at", 1, 19), F.lit("T"), F.lit(" "))
    order = F.struct(
        F.coalesce("sample", F.lit("")).alias("sample"), _rank("module", MODULES).alias("module"), _rank("locus", LOCI).alias("locus"), F.col("record_id"), F.col("s.i").alias("i"), F.col("s.PathInfo").alias("p"))
    return both.select(
        "run_id", order.alias("ord"), "s.Step", "s.PathInfo", date.alias("Date"), "s.InputReads", "s.OutputReads",
        S.percent(F.col("s.OutputReads"), F.col("s.InputReads")).alias("PercentRetained"), "s.InputDescription", "s.OutputDescription")


def preferred(records: DataFrame, module: str) -> DataFrame:
    """A module's run-level records, or else its sample-level ones."""
    own = records.where((F.col("module") == module) & F.col("scope_type").isin("run", "sample"))
    best = own.groupBy("run_id").agg(F.min("scope_type").alias("scope_type"))  # 'run' sorts before 'sample'
    return own.join(best, ["run_id", "scope_type"], "left_semi")


def module_sum(records: DataFrame, module: str, key: str) -> DataFrame:
    """run_id and the sum of one count (null where no record has it)."""
    return preferred(records, module).groupBy("run_id").agg(F.sum(count(key)).alias("value"))


def retention(stages: DataFrame) -> DataFrame:
    """stages (run_id, stage_no, label, value) with ratios to the one before and to the first, and the share of the largest.

    Stages without a value, and repeats of label and value, go first.
    """
    own = W.partitionBy("run_id").orderBy("stage_no")
    known = stages.where("value is not null")
    before = known.withColumns({"_l": F.lag("label").over(own), "_v": F.lag("value").over(own)})
    kept = before.where(~(F.coalesce(F.col("_l") == F.col("label"), F.lit(False)) & F.coalesce(F.col("_v") == F.col("value"), F.lit(False)))).drop("_l", "_v")
    whole = W.partitionBy("run_id")
    return kept.withColumns({
        "pct_previous": F.round(S.percent(F.col("value"), F.lag("value").over(own)), 6), "pct_first": F.round(S.percent(F.col("value"), F.first("value").over(own)), 6),
        "bar": F.round(F.col("value") * 100.0 / F.greatest(F.max("value").over(whole), F.lit(1)), 6)})


def read_stages(records: DataFrame) -> DataFrame:
    """The reads' stages of each run: filter, demultiplexing, then collapse."""
    run = records.where("scope_type = 'run'")
    pick = lambda m, pairs: run.where(F.col("module") == m).select("run_id", F.explode(F.array(*[F.struct(F.lit(n).alias("stage_no"), F.lit(t).alias("label"), count(k).alias("value")) for n, t, k in pairs])).alias("s")).select("run_id", "s.*")
    parts = pick("filter", [(0, "Input reads", "input_reads"), (1, "Filtered reads", "filtered_reads")]).unionByName(
        pick("demux", [(2, "Demux input", "input_reads"), (3, "Demultiplexed reads", "matched_reads")]))
    names = [(4, "Collapse input", "input_reads"), (5, "SPBC/UMI annotated", "annotated_reads"), (6, "Fixed-length filtered", "length_filtered_reads"), (7, "AF-retained group reads", "retained_group_reads")]
    sums = preferred(records, "collapse").groupBy("run_id").agg(*[F.sum(count(k)).alias(k) for _, _, k in names], F.min(F.lower(F.try_element_at("parameters", F.lit("library")))).alias("lo"), F.max(F.lower(F.try_element_at("parameters", F.lit("library")))).alias("hi"))
    label = lambda t: F.when((F.lit(t) == "SPBC/UMI annotated") & (F.col("lo") == "bulk") & (F.col("hi") == "bulk"), "UMI annotated").otherwise(t)
    late = sums.select("run_id", F.explode(F.array(*[F.struct(F.lit(n).alias("stage_no"), label(t).alias("label"), F.col(k).alias("value")) for n, t, k in names])).alias("s")).select("run_id", "s.*")
    both = parts.unionByName(late).where("value is not null")
    before = both.withColumn("_v", F.lag("value").over(W.partitionBy("run_id").orderBy("stage_no")))
    return before.where(~(F.col("label").isin("Demux input", "Collapse input") & F.coalesce(F.col("_v") == F.col("value"), F.lit(False)))).drop("_v")


#: Labels of the yield stages in the report.
YIELD_LABELS = ("Consensus sequences", "Seqtag input", "Seqtag matches", "AIRR input represented", "Valid AIRR sequences", "Productive AIRR sequences")
LOCI_NOTE = "Available loci: "


def of_loci(records: DataFrame) -> DataFrame:
    """AIRR records of a locus, its name in lower case; records of a run or sample as a whole are no part of these."""
    return records.where("module = 'airr' and locus <> ''").withColumn("locus", F.lower("locus"))


def yield_stages(records: DataFrame) -> DataFrame:
    """The sequences' stages of each run: consensus, tagging, then AIRR; stages without a count are left out.

    An input stage shows only where it differs from the stage before. Collapse and tagging count by run records where
    there are any, else by samples; AIRR counts the records of its loci, which the note of its input stage names.
    """
    sums = lambda own, **keys: own.groupBy("run_id").agg(*[F.sum(count(k)).alias(name) for name, k in keys.items()])
    airr = of_loci(records)
    parts = [
        sums(preferred(records, "collapse"), v0="consensus_sequences"), sums(preferred(records, "seqtag"), v1="input_sequences", v2="matched_sequences"),
        sums(airr, v3="input_sequences", v4="airr_sequences", v5="productive_sequences")]
    names = airr.groupBy("run_id").agg(F.array_sort(F.collect_set(F.struct(_rank("locus", LOCI).alias("rank"), "locus"))).alias("_loci"))
    note = F.concat(F.lit(LOCI_NOTE), F.array_join(F.transform("_loci", lambda x: S.locus_label(x["locus"])), ", "))
    wide = parts[0].join(parts[1], "run_id", "full").join(parts[2], "run_id", "full").join(names, "run_id", "left")
    each = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(t).alias("label"), F.col(f"v{i}").alias("value"), (note if i == 3 else F.lit(None).cast("string")).alias("note")) for i, t in enumerate(YIELD_LABELS)])
    stages = wide.select("run_id", F.explode(each).alias("s")).select("run_id", "s.*").where("value is not null")
    before = stages.withColumn("_v", F.lag("value").over(W.partitionBy("run_id").orderBy("stage_no")))
    return before.where(~(F.col("stage_no").isin(1, 3) & F.coalesce(F.col("_v") == F.col("value"), F.lit(False)))).drop("_v")


#: Input count, output count and the output's label of each module.
MODULE_OUTPUTS = {
    "filter": ("input_reads", "filtered_reads", "Filtered reads"), "demux": ("input_reads", "matched_reads", "Valid UDI matches"),
    "collapse": ("input_reads", "consensus_sequences", "Consensus sequences"), "seqtag": ("input_sequences", "matched_sequences", "Seqtag matches"),
    "airr": ("input_sequences", "productive_sequences", "Productive sequences"),
}
SAMPLE_OUTPUT, ALL_AIRR_OUTPUT, OTHER_OUTPUT = "Assigned sample reads", "Valid AIRR sequences", "Output"


def module_summary(records: DataFrame) -> DataFrame:
    """run_id, module, scope_type, sample, locus, input, output, label and retained (percent) of each record.

    A sample's reads are held against all matched reads of its run; AIRR without a productive count shows the valid
    sequences. A module that is none of these shows its first and its last count; missing counts are null, and so is a share of 0 or of a null.
    """
    run = records.where("module = 'demux' and scope_type = 'run'").groupBy(F.col("run_id").alias("_run")).agg(F.max(count("matched_reads")).alias("_matched"))
    own = records.join(run, F.col("run_id") == F.col("_run"), "left")
    sample = (F.col("module") == "demux") & (F.col("scope_type") != "run")
    valid = (F.col("module") == "airr") & count("productive_sequences").isNull()
    before = F.when(sample, F.col("_matched"))
    after = F.when(sample, count("assigned_reads")).when(valid, count("airr_sequences"))
    label = F.when(sample, F.lit(SAMPLE_OUTPUT)).when(valid, F.lit(ALL_AIRR_OUTPUT))
    for module, (a, b, text) in MODULE_OUTPUTS.items():
        mine = F.col("module") == module
        before, label = before.when(mine, count(a)), label.when(mine, F.lit(text))
        after = after.when(mine, count(b))
    values = F.map_values("counts")
    before, after, label = before.otherwise(F.try_element_at(values, F.lit(1))), after.otherwise(F.try_element_at(values, F.lit(-1))), label.otherwise(OTHER_OUTPUT)
    shown = own.select("run_id", "module", "scope_type", "sample", "locus", before.alias("input"), after.alias("output"), label.alias("label"))
    return shown.withColumn("retained", F.round(S.percent(F.col("output"), F.col("input")), 6))


def loci(records: DataFrame) -> DataFrame:
    """AIRR counts and rates of each run and locus over all samples (sample null) and of each sample, with the outcome parts."""
    own = of_loci(records).select(
        "run_id", "locus", "sample", count("input_sequences").alias("input"), count("airr_sequences").alias("valid"),
        count("productive_sequences").alias("productive"), count("productive_heavy_sequences").alias("heavy"))
    sums = [F.sum(c).alias(c) for c in ("input", "valid", "productive", "heavy")]
    rolled = own.groupingSets([["run_id", "locus"], ["run_id", "locus", "sample"]], "run_id", "locus", "sample").agg(F.grouping("sample").alias("is_total"), *sums)
    return rolled.withColumns({
        "annotation_rate": F.round(S.percent(F.col("valid"), F.col("input")), 6), "productive_rate": F.round(S.percent(F.col("productive"), F.col("valid")), 6),
        "nonproductive": F.greatest(F.col("valid") - F.col("productive"), F.lit(0)), "unannotated": F.greatest(F.col("input") - F.col("valid"), F.lit(0))})


def demux_overview(records: DataFrame) -> DataFrame:
    """Assigned reads of each sample, as shares of the matched and of all reads."""
    run = records.where("module = 'demux' and scope_type = 'run'").select("run_id", count("matched_reads").alias("matched"), count("input_reads").alias("input"))
    own = records.where("module = 'demux' and scope_type = 'sample' and sample is not null").select("run_id", "sample", count("assigned_reads").alias("assigned"))
    return own.join(run, "run_id").select("run_id", "sample", "assigned", F.round(S.percent(F.col("assigned"), F.col("matched")), 6).alias("pct_matched"), F.round(S.percent(F.col("assigned"), F.col("input")), 6).alias("pct_input"))


def overview(records: DataFrame) -> DataFrame:
    """Headline numbers of each run: input, filtered, demultiplexed, samples, consensus, tagged, productive, runtime."""
    of = lambda m, k, s="run": F.sum(F.when((F.col("module") == m) & (F.col("scope_type") == s), count(k)))
    agg = records.groupBy("run_id").agg(
        of("filter", "input_reads").alias("f_in"), of("filter", "filtered_reads").alias("filtered_reads"), of("demux", "input_reads").alias("d_in"),
        of("demux", "matched_reads").alias("demultiplexed_reads"), of("demux", "sample_count").alias("samples"),
        of("collapse", "input_reads").alias("c_run"), of("collapse", "input_reads", "sample").alias("c_sample"),
        of("collapse", "consensus_sequences").alias("n_run"), of("collapse", "consensus_sequences", "sample").alias("n_sample"),
        of("seqtag", "matched_sequences").alias("t_run"), of("seqtag", "matched_sequences", "sample").alias("t_sample"),
        of("seqtag", "input_sequences").alias("s_run"), of("seqtag", "input_sequences", "sample").alias("s_sample"),
        F.sum(F.when(F.col("module") == "airr", count("productive_sequences"))).alias("productive"),
        F.round(F.sum(F.coalesce("duration_seconds", F.lit(0.0))), 3).alias("runtime_seconds"), F.count("*").alias("n_records"))
    return agg.select(
        "run_id", F.coalesce("f_in", "d_in", "c_run", "c_sample", "s_run", "s_sample").alias("input_reads"), "filtered_reads", "demultiplexed_reads", "samples",
        F.coalesce("n_run", "n_sample").alias("consensus_sequences"), F.coalesce("t_run", "t_sample").alias("tagged_sequences"), "productive", "runtime_seconds", "n_records")


def quality_links(records: DataFrame) -> DataFrame:
    """Distinct quality-report files."""
    each = records.select("run_id", "module", F.explode("files").alias("key", "path"))
    return each.where(F.lower("path").endswith(".html") | F.lower("key").contains("nanoplot")).distinct()


#: Roles of recorded files by module and key.
FILE_KINDS = {
    "filter": {"inputs": ("input_fastq",), "outputs": ("filtered_fastq", "filtered_fasta"), "diagnostics": ("log", "nanoplot_report")},
    "demux": {"inputs": ("input_barcodes", "input_sequences"), "outputs": ("sample_fasta",), "diagnostics": ("unmatched_fasta", "log"),
              "intermediates": ("forward_failed_fasta", "reverse_complement_fasta", "forward_matched_fasta", "reverse_matched_fasta", "matched_fasta")},
    "collapse": {"inputs": ("input_anchor", "input_sequences", "visium_spatial_barcodes", "visiumhd_spatial_barcode_index"), "outputs": ("consensus_fasta",),
                 "diagnostics": ("log", "failed_spatial_barcodes", "failed_adaptive_filter"),
                 "intermediates": ("annotated_sequences", "length_filtered_sequences", "retained_group_sequences")},
    "seqtag": {"inputs": ("input_anchor", "input_sequences"), "diagnostics": ("failed_fasta", "log")},
    "airr": {"inputs": ("input_sequences", "igblast_database", "germline_database"), "outputs": ("productive_airr_tsv", "productive_heavy_airr_tsv"),
             "diagnostics": ("log",), "intermediates": ("igblast_fmt7",)},
}
#: The command's flag of each parameter, by module.
FLAGS = {
    "filter": {"min_quality": "--min-qual", "min_length": "--minl", "max_length": "--maxl"},
    "demux": {"window_length": "--window-length", "anchor_error": "--anchor-error"},
    "collapse": {
        "library": "--library", "demux": "--demux", "window_length": "--window-length", "anchor_error": "--anchor-error", "umi_length": "--umi-length",
        "spbc_error": "--spbc-error", "spbc_length": "--spbc-length", "min_length": "--minl", "max_length": "--maxl", "group_field": "--group-field",
        "adaptive_filter": "--adaptive-filter", "min_group_size": "--filter-min-size", "bin_size": "--bin-size", "peak_margin": "--peak-margin",
        "consensus_max_gap": "--cons-gap", "consensus_max_error": "--cons-error", "max_reads_per_group": "--n-subsample", "groups_per_chunk": "--n-chunk",
        "seed": "--seed", "parallel_jobs": "--cjobs"},
    "seqtag": {"window_length": "--window-length", "anchor_error": "--anchor-error", "primer_field": "--pf", "split": "--split", "split_regex": "--split-regex"},
    "airr": {"locus": "--loci", "filter_productive": "--ph"},
}
COMMAND_SECTION, OTHER_SECTION = "Command parameters", "Internal and fixed settings"


def file_kinds(records: DataFrame) -> DataFrame:
    """run_id, module, record_id, key, path and kind (inputs, outputs, diagnostics, intermediates, other) of every recorded file.

    A rule table joined by (module, key) decides; the tagged and the annotated table are intermediates where files made
    from them stand beside them in the record. Keys without a rule go by their names.
    """
    rules = records.sparkSession.createDataFrame([(m, k, kind) for m, kinds in FILE_KINDS.items() for kind, keys in kinds.items() for k in keys], "module string, key string, _rule string")
    split = F.col("key").rlike("^split_.*_fasta$")
    each = records.select(
        "run_id", "module", "record_id", F.exists(F.map_keys("files"), lambda k: k.rlike("^split_.*_fasta$")).alias("_split"),
        F.array_contains(F.map_keys("files"), "productive_airr_tsv").alias("_productive"), F.explode("files").alias("key", "path"))
    lower = F.lower("key")
    made = lambda there: F.when(there, "intermediates").otherwise("outputs")
    kind = (
        F.when((F.col("module") == "seqtag") & split, "outputs").when((F.col("module") == "seqtag") & (F.col("key") == "matched_fasta"), made(F.col("_split")))
        .when((F.col("module") == "airr") & (F.col("key") == "airr_tsv"), made(F.col("_productive"))).when(F.col("_rule").isNotNull(), F.col("_rule"))
        .when(lower.startswith("input_"), "inputs").when(lower.rlike("log|qc|failed|nanoplot"), "diagnostics").otherwise("other"))
    return each.join(F.broadcast(rules), ["module", "key"], "left").select("run_id", "module", "record_id", "key", "path", kind.alias("kind"))


def parameter_flags(records: DataFrame) -> DataFrame:
    """run_id, module, record_id, section, label and value of every parameter: the command's flag, or the key in words."""
    flags = records.sparkSession.createDataFrame([(m, k, f) for m, own in FLAGS.items() for k, f in own.items()], "module string, key string, _flag string")
    each = records.select("run_id", "module", "record_id", F.explode("parameters").alias("key", "value"))
    joined = each.join(F.broadcast(flags), ["module", "key"], "left")
    return joined.select(
        "run_id", "module", "record_id", F.when(F.col("_flag").isNotNull(), COMMAND_SECTION).otherwise(OTHER_SECTION).alias("section"),
        F.coalesce("_flag", S.humanise(F.col("key"))).alias("label"), F.coalesce("value", F.lit("null")).alias("value"))
