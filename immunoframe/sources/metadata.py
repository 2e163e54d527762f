"""Run metadata: small JSON files written by the driver, read back as a relation, and the report's files."""

from __future__ import annotations

import datetime as dt
import html
import json
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import runmeta

FOLDER = ".immunoframe"
SCHEMA_VERSION = 1


def _write(path: Path, text: str) -> None:
    """Whole or not at all."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(handle, "w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)


def start_run(root: str, version: str) -> str:
    """The run's id; made where the folder has none. Of several that start at once, all get the first one's."""
    path = Path(root, FOLDER, "run.json")
    if not path.exists():
        own = path.with_name(f"run.{uuid.uuid4()}.json")
        _write(own, json.dumps({
            "schema_version": SCHEMA_VERSION, "run_id": str(uuid.uuid4()), "version": version, "run_root": str(Path(root).resolve()), "created_at": dt.datetime.now(dt.UTC).isoformat()}))
        try:
            os.link(own, path)  # fails where there is one by now
        except FileExistsError:
            pass
        finally:
            own.unlink()
    return json.loads(path.read_text())["run_id"]


def copy_config(config: str, results: str) -> Path:
    """A run's configuration next to its results, as it was at this time; an older copy is replaced."""
    path = Path(results, Path(config).name)
    _write(path, Path(config).read_text())
    return path


def locate(recorded: str, first_root: str, root: str) -> tuple[str, str | None]:
    """Status and place of a recorded path, where a run's folder may have moved from ``first_root`` to ``root``.

    A relative path lies below the first root. ``present``: where it was recorded; ``relocated``: at the same place below
    the present root; ``missing`` (no place): at neither. The present root comes first.
    """
    old = Path(first_root, Path(recorded).expanduser()).resolve()
    start = Path(first_root).resolve()
    if old.is_relative_to(start):
        here = (Path(root) / old.relative_to(start)).resolve()
        if here.exists():
            return ("present" if here == old else "relocated"), str(here)
    return ("present", str(old)) if old.exists() else ("missing", None)


def file_places(records: DataFrame, root: str) -> list[tuple[str, str, str, str, str | None]]:
    """module, record_id, recorded path, status and place of every recorded file (a few for each record, looked up by the driver)."""
    first_root = json.loads(Path(root, FOLDER, "run.json").read_text()).get("run_root") or root
    each = records.select("module", "record_id", F.explode(F.map_values("files")).alias("path")).where("path is not null")
    return [(r.module, r.record_id, r.path, *locate(r.path, first_root, root)) for r in each.orderBy("module", "record_id", "path").collect()]


def find_root(start: str) -> Path | None:
    here = Path(start).resolve()
    return next((p for p in (here, *here.parents) if (p / FOLDER / "run.json").exists()), None)


def write_record(
    root: str, module: str, record_id: str, counts: dict[str, int], started_at: str, finished_at: str, sample: str | None = None,
    locus: str | None = None, parameters: dict | None = None, files: dict | None = None, status: str = "success",
) -> Path:
    """One module record; a later one of the same id replaces it."""
    if any(v < 0 for v in counts.values()):
        raise ValueError("counts are 0 or more")
    kind = "sample_locus" if sample and locus else "sample" if sample else "locus" if locus else "run"
    seconds = (dt.datetime.fromisoformat(finished_at) - dt.datetime.fromisoformat(started_at)).total_seconds()
    run = json.loads(Path(root, FOLDER, "run.json").read_text())
    record = {
        "schema_version": SCHEMA_VERSION, "run_id": run["run_id"], "version": run["version"], "module": module, "record_id": record_id,
        "scope_type": kind, "sample": sample, "locus": locus, "status": status, "started_at": started_at, "finished_at": finished_at,
        "duration_seconds": max(0.0, round(seconds, 3)), "counts": counts, "parameters": {k: _parameter(v) for k, v in (parameters or {}).items()}, "files": {k: v for k, v in (files or {}).items() if v is not None}}
    path = Path(root, FOLDER, "metadata", module, f"{record_id}.json")
    _write(path, json.dumps(record))
    return path


def _parameter(value: object) -> str:
    """A parameter as text: JSON words for truth values and nothing, JSON for lists and objects."""
    return json.dumps(value, ensure_ascii=False) if value is None or isinstance(value, (bool, list, dict)) else str(value)


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """All records of a run; misplaced ones are reported by :func:`misplaced`."""
    return spark.read.schema(runmeta.RECORDS).json(f"{root}/{FOLDER}/metadata/*/*.json", multiLine=True)


def misplaced(spark: SparkSession, root: str) -> DataFrame:
    """Records whose folder is not their module or whose file is not their id."""
    own = spark.read.schema(runmeta.RECORDS).json(f"{root}/{FOLDER}/metadata/*/*.json", multiLine=True).withColumn("_f", F.input_file_name())
    parts = F.split("_f", "/")
    return own.where((F.element_at(parts, -2) != F.col("module")) | (F.element_at(parts, -1) != F.concat("record_id", F.lit(".json")))).select("module", "record_id")


#: Fields of a record; others are reported.
KNOWN = (
    "schema_version", "run_id", "version", "module", "record_id", "scope_type", "sample", "locus", "status", "started_at", "finished_at", "duration_seconds", "counts", "parameters", "files")
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def check_run(root: str) -> dict:
    """The run's marker; ValueError where it is missing, no JSON object, of another schema version or lacks a field."""
    path = Path(root, FOLDER, "run.json")
    try:
        marker = json.loads(path.read_text())
    except (OSError, ValueError) as e:
        raise ValueError(f"{path}: {e}") from e
    if not isinstance(marker, dict):
        raise ValueError(f"{path}: not an object")
    if type(marker.get("schema_version")) is not int or marker["schema_version"] != SCHEMA_VERSION:
        raise ValueError(f"{path}: schema_version is not {SCHEMA_VERSION}")
    for key in ("run_id", "version", "created_at"):
        if not isinstance(marker.get(key), str) or not marker[key].strip():
            raise ValueError(f"{path}: {key} is no text")
    dt.datetime.fromisoformat(marker["created_at"])
    return marker


def problems(spark: SparkSession, root: str) -> DataFrame:
    """path, severity (error, warning) and problem of every record file that a strict reading refuses.

    The raw text is read as a variant, so that wrong types and unknown fields show; the typed columns of
    :func:`read_records` would hold nulls there. A file with no problem has no row.
    """
    marker = check_run(root)
    top = f"{root}/{FOLDER}/metadata"
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(top)
    own = text.select(F.input_file_name().alias("path"), F.try_parse_json("value").alias("v"))
    below = F.split(F.regexp_extract("path", rf"/{re.escape(FOLDER)}/metadata/(.*)$", 1), "/")
    own = own.withColumns({"folder": F.when(F.size(below) > 1, below[0]), "stem": F.regexp_replace(F.element_at(below, -1), r"\.json$", ""), "is_object": F.schema_of_variant("v").startswith("OBJECT<")})
    broken = own.where("v is null").select("path", F.lit("error").alias("severity"), F.lit("no JSON").alias("problem"))
    rootless = own.where("v is not null and not is_object").select("path", F.lit("error").alias("severity"), F.lit("not an object").alias("problem"))

    field = lambda k: F.try_variant_get("v", f"$.{k}", "variant")
    kind = lambda k: F.coalesce(F.schema_of_variant(field(k)), F.lit(""))
    string = lambda k: F.try_variant_get("v", f"$.{k}", "string")
    entries = lambda k: F.coalesce(F.try_variant_get("v", f"$.{k}", "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))
    whole = lambda x: F.schema_of_variant(x).rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    blank = lambda k: (kind(k) != "STRING") | (F.trim(string(k)) == "")
    moment = lambda k: string(k).rlike(_ISO) & F.try_to_timestamp(string(k)).isNotNull()
    scope = string("scope_type")
    rules = [
        (~kind("schema_version").rlike("^(BIGINT|DECIMAL.*,0.*)$"), "schema_version is no whole number"),
        (kind("schema_version").rlike("^BIGINT$") & (F.try_variant_get("v", "$.schema_version", "long") != SCHEMA_VERSION), "schema_version is another one"),
        *[(blank(k), f"{k} is no text") for k in ("run_id", "module", "record_id", "status", "started_at", "finished_at")],
        (~blank("run_id") & (string("run_id") != marker["run_id"]), "run_id is that of another run"),
        (F.col("folder").isNull(), "not below a module's folder"), (~blank("module") & (string("module") != F.col("folder")), "module is not its folder"),
        (~blank("record_id") & (string("record_id") != F.col("stem")), "record_id is not its file's name"),
        ((kind("scope_type") != "STRING") | ~F.coalesce(scope.isin(*runmeta.SCOPES), F.lit(False)), "unknown scope"),
        (scope.isin("sample", "sample_locus") & blank("sample"), "scope without a sample"), (scope.isin("locus", "sample_locus") & blank("locus"), "scope without a locus"),
        (~blank("status") & ~string("status").isin(*runmeta.STATES), "unknown status"),
        *[(~blank(k) & ~F.coalesce(moment(k), F.lit(False)), f"{k} is no ISO date") for k in ("started_at", "finished_at")],
        (moment("started_at") & moment("finished_at") & (F.try_to_timestamp(string("finished_at")) < F.try_to_timestamp(string("started_at"))), "finished before start"),
        *[(~kind(k).startswith("OBJECT<"), f"{k} is no object") for k in ("counts", "parameters", "files")],
        (~kind("duration_seconds").rlike("^(|VOID|BIGINT|DOUBLE|DECIMAL.*)$") | (F.try_variant_get("v", "$.duration_seconds", "double") < 0), "duration_seconds is no number of 0 or more"),
    ]
    single = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in rules])
    bad_count = F.transform(F.map_entries(entries("counts")), lambda e: F.when(
        (e["key"] == "") | ~whole(e["value"]) | F.coalesce(F.try_variant_get(e["value"], "$", "decimal(38,0)") < 0, F.lit(True)), F.concat(F.lit("count '"), e["key"], F.lit("' is no whole number of 0 or more"))))
    bad_file = F.transform(F.map_entries(entries("files")), lambda e: F.when(
        (e["key"] == "") | (F.schema_of_variant(e["value"]) != "STRING") | (F.try_variant_get(e["value"], "$", "string") == ""), F.concat(F.lit("file '"), e["key"], F.lit("' is no path"))))
    unknown = F.transform(F.array_except(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")), F.array(*map(F.lit, KNOWN))), lambda k: F.concat(F.lit("unknown field "), k))
    version = F.when(F.coalesce(string("version"), F.lit("")) != marker["version"], F.array(F.lit("version is not the run's"))).otherwise(F.array().cast("array<string>"))
    objects = own.where("is_object")
    found = lambda severity, texts: objects.select("path", F.lit(severity).alias("severity"), F.explode(texts).alias("problem")).where("problem is not null")
    names = objects.select("path", string("module").alias("m"), string("record_id").alias("r")).where("m is not null and r is not null")
    double = names.groupBy("m", "r").agg(F.sort_array(F.collect_list("path")).alias("paths")).where("size(paths) > 1").select(F.explode(F.slice("paths", 2, 1 << 20)).alias("path"), F.lit("error").alias("severity"), F.lit("duplicate record").alias("problem"))
    parts = [broken, rootless, found("error", F.concat(single, bad_count, bad_file)), found("warning", F.concat(unknown, version)), double]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_summary(records: DataFrame, path: str, title: str = "summary") -> None:
    """The summary as tab-separated text behind two lines of preamble (a few rows for each record)."""
    rows = runmeta.summary_rows(records).orderBy("ord").collect()
    clean = lambda v: "" if v is None else str(v).replace("\t", " ").replace("\n", " ")
    names = ["Step", "PathInfo", "Date", "InputReads", "OutputReads", "PercentRetained", "InputDescription", "OutputDescription"]
    out = [f"# {title}", f"# records: {records.count()}", "\t".join(names)]
    for r in rows:
        out.append("\t".join(clean(f"{r[n]:.1f}%" if n == "PercentRetained" and r[n] is not None else r[n]) for n in names))
    _write(Path(path), "\n".join(out) + "\n")


def write_html(records: DataFrame, path: str, warnings: list[str] = ()) -> None:
    """A page of its own with three panels: overview (headline numbers, warnings, modules, retention, quality reports), loci, run details.

    Panels change by radio buttons, so the page needs no script; every text is escaped.
    """
    text = lambda v: html.escape("" if v is None else str(v))

    def block(title: str, df: DataFrame, bar: str | None = None) -> str:
        found = df.collect()
        cells = lambda tag, r: "".join(f"<{tag}>{text(v)}</{tag}>" for v in r)
        drawn = lambda r: f"<td><div class=bar style='width:{float(r[bar] or 0):.1f}%'></div></td>" if bar else ""
        body = "".join(f"<tr>{cells('td', r)}{drawn(r)}</tr>" for r in found)
        return f"<h2>{text(title)}</h2><table><tr>{cells('th', df.columns)}{'<th></th>' if bar else ''}</tr>{body}</table>"

    def cards(df: DataFrame) -> str:
        return "".join(f"<div class=cards>{''.join(f'<div><b>{text(r[c])}</b>{text(c)}</div>' for c in df.columns if r[c] is not None)}</div>" for r in df.collect())

    def stages(title: str, own: DataFrame) -> str:
        return block(title, runmeta.retention(own).orderBy("run_id", "stage_no"), "bar")

    listed = "".join(f"<li>{text(w)}</li>" for w in warnings)
    panels = {
        "Overview": [
            cards(runmeta.overview(records)), f"<h2>Warnings</h2><ul>{listed}</ul>" if listed else "<h2>Warnings</h2><p class=none>none</p>",
            block("Module summary", runmeta.module_summary(records)), block("Demultiplexing", runmeta.demux_overview(records).orderBy("sample")),
            stages("Read processing retention", runmeta.read_stages(records)), stages("Consensus and receptor yield", runmeta.yield_stages(records)),
            block("Quality reports", runmeta.quality_links(records)),
            f"<details><summary>Full processing table</summary>{block('Summary', runmeta.summary_rows(records).orderBy('ord').drop('ord'))}</details>"],
        "Loci": [block("Locus results", runmeta.loci(records).orderBy("run_id", "locus", "sample"))],
        "Run details": [
            block("Records", runmeta.ordered(records).select("module", "record_id", "status", "started_at", "finished_at", S.duration(F.col("duration_seconds")).alias("took"))),
            block("Parameters", runmeta.parameter_flags(records).orderBy("module", "record_id", "section", "label")), block("Files", runmeta.file_kinds(records).orderBy("module", "record_id", "kind", "key"))],
    }
    style = (
        "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.3em .6em;text-align:left}.bar{background:#285e9a;height:1em}"
        ".cards div{display:inline-block;margin:.4em;padding:.6em;border:1px solid #ccc}.cards b{display:block;font-size:1.4em}.cards{border:0}.panel{display:none}"
        + "".join(f"#t{i}:checked~#p{i}" + "{display:block}" for i in range(len(panels))))
    tabs = "".join(f"<input type=radio name=tab id=t{i}{' checked' if not i else ''}><label for=t{i}>{text(n)}</label>" for i, n in enumerate(panels))
    shown = "".join(f"<section class=panel id=p{i}>{''.join(parts)}</section>" for i, parts in enumerate(panels.values()))
    _write(Path(path), f"<!doctype html><html lang=en><meta charset=utf-8><title>Run report</title><style>{style}</style><h1>Run report</h1>{tabs}{shown}</html>")


def report(spark: SparkSession, root: str, strict: bool = False, validate_only: bool = False, summary: bool = True, page: bool = True) -> list[str]:
    """Writes summary.tsv and report.html, or one of them; returns warnings. Errors (and with strict, warnings) raise."""
    if not (summary or page or validate_only):
        raise ValueError("neither summary nor page: use validate_only")
    found = problems(spark, root).orderBy("path", "problem").collect()
    if bad := [f"{'/'.join(r.path.split('/')[-2:])}: {r.problem}" for r in found if r.severity == "error"]:
        raise ValueError("; ".join(bad))
    records = read_records(spark, root)
    warnings = [f"{'/'.join(r.path.split('/')[-2:])}: {r.problem}" for r in found]
    warnings += [str(tuple(r)) for check in (runmeta.rises, runmeta.wrong_sums, runmeta.mismatches, runmeta.unexpected_samples, runmeta.sample_totals) for r in check(records).collect()]
    if strict and warnings:
        raise ValueError("; ".join(warnings))
    if summary and not validate_only:
        write_summary(records, f"{root}/summary.tsv")
    if page and not validate_only:
        write_html(records, f"{root}/report.html", warnings)
    return warnings
