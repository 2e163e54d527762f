"""Spatial summaries: bins, cells, coordinates, bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S

#: Fixed value: the id that stands for no cell.
NO_CELL = "cellid_000000000"


def mapping_for(mapping: DataFrame, rows: DataFrame) -> DataFrame:
    """The mapping of the 2 um squares that rows has; cells only where the square lies in one."""
    wanted = rows.select(S.strip_suffix(F.col("spbcid")).alias("square")).distinct()
    own = mapping.withColumn("square", S.strip_suffix(F.col("square_002um"))).join(wanted, "square", "left_semi")
    inside = F.col("in_cell") & (F.col("cell_id") != NO_CELL)
    return own.select("square", F.col("square_016um").alias("bin_16um"), F.when(inside, S.strip_suffix(F.col("cell_id"))).alias("cell"))


def with_mapping(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    return rows.withColumn("square", S.strip_suffix(F.col("spbcid"))).join(mapping_for(mapping, rows), "square", "left")


def bin_16um(x: F.Column, y: F.Column) -> F.Column:
    """Id of the 16 um bin around a 2 um square."""
    return F.format_string("s_016um_%05d_%05d", F.floor(x / 8).cast("int"), F.floor(y / 8).cast("int"))


def mapping_quality(mapped: DataFrame) -> DataFrame:
    """(metric, value): rows, mapped rows, rows and distinct numbers of bins and cells."""
    one = mapped.agg(
        F.count("*").alias("rows"), F.count("bin_16um").alias("mapped_rows"), F.count("cell").alias("cell_rows"),
        F.countDistinct("bin_16um").alias("bins"), F.countDistinct("cell").alias("cells"))
    return one.unpivot([], ["rows", "mapped_rows", "cell_rows", "bins", "cells"], "metric", "value")


def richness(mapped: DataFrame, at: str) -> DataFrame:
    """Distinct clones and chains at each place; the null place is a place."""
    return mapped.groupBy(at).agg(F.countDistinct("clone_id").alias("n_clones"), F.count("*").alias("n_chains"))


def clone_at(mapped: DataFrame, clone: str, at: str) -> DataFrame:
    return mapped.where(F.col("clone_id") == clone).groupBy(at).agg(F.count("*").alias("n_chains"))


def with_coordinates(summary: DataFrame, places: DataFrame, at: str, key: str) -> DataFrame:
    """Left join in which a null place meets a null key."""
    return summary.join(places, summary[at].eqNullSafe(places[key]), "left").drop(key)


def centroids(positions: DataFrame, mapping: DataFrame, scale: float) -> DataFrame:
    """Mean image position of each cell's squares."""
    own = positions.select(S.strip_suffix(F.col("barcode")).alias("square"), (F.col("pxl_col_in_fullres") * scale).alias("image_x"), (F.col("pxl_row_in_fullres") * scale).alias("image_y"))
    return own.join(mapping.where("cell is not null").select("square", "cell"), "square").groupBy("cell").agg(
        F.round(F.avg("image_x"), 6).alias("image_x"), F.round(F.avg("image_y"), 6).alias("image_y"), F.count("*").alias("n_squares"))


def bounds(places: DataFrame, x: str = "image_x", y: str = "image_y", padding: float = 0.05, width: float | None = None, height: float | None = None) -> DataFrame:
    """One row: least and greatest coordinates, and those of a padded crop box that stays within the image.

    Without the image's size only the origin bounds the box.
    """
    one = places.agg(F.min(x).alias("min_x"), F.max(x).alias("max_x"), F.min(y).alias("min_y"), F.max(y).alias("max_y"))
    pad = lambda a, b: (F.col(b) - F.col(a)) * padding
    low = lambda a, b: F.round(F.greatest(F.lit(0.0), F.col(a) - pad(a, b)), 6)
    high = lambda a, b, most: F.round(F.col(b) + pad(a, b) if most is None else F.least(F.lit(float(most)), F.col(b) + pad(a, b)), 6)
    return one.withColumns({
        "crop_min_x": low("min_x", "max_x"), "crop_max_x": high("min_x", "max_x", width), "crop_min_y": low("min_y", "max_y"), "crop_max_y": high("min_y", "max_y", height)})


def zoom_box(cropped: DataFrame, share: float = 0.4) -> DataFrame:
    """The box with a share of both sides in the corner of least x and greatest y (bottom left on an image) of a crop box."""
    span = lambda a: (F.col(f"crop_max_{a}") - F.col(f"crop_min_{a}")) * share
    return cropped.select(
        F.col("crop_min_x").alias("zoom_min_x"), F.round(F.col("crop_min_x") + span("x"), 6).alias("zoom_max_x"),
        F.round(F.col("crop_max_y") - span("y"), 6).alias("zoom_min_y"), F.col("crop_max_y").alias("zoom_max_y"))
