"""Per-page summaries: manifest pages, render manifests, overlay coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import EDGES, outline_width, scaled
from ..functions.naming import caption, overlay_image
from ..schemas import COLORS

PAGE = ["doc_key", "page_number"]


def visual_regions(regions: DataFrame) -> DataFrame:
    """Only visual regions have a page."""
    return regions.where(F.col("location.type") == "visual").withColumn("page_number", F.col("location.page_number"))


def region_ids_by_page(regions: DataFrame) -> DataFrame:
    """doc_key, page_number, region_ids in detector order, region_count."""
    ordered = F.array_sort(F.collect_list(F.struct("region_idx", "id")))
    grouped = visual_regions(regions).groupBy(*PAGE).agg(ordered.alias("_ids"))
    return grouped.select(*PAGE, F.transform("_ids", lambda e: e["id"]).alias("region_ids"), F.size("_ids").alias("region_count"))


def _with_ids(pages: DataFrame, regions: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    joined = pages.join(region_ids_by_page(regions), PAGE, "left")
    return joined.withColumns({"region_ids": F.coalesce("region_ids", none), "region_count": F.coalesce("region_count", F.lit(0))})


def manifest_pages(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """One row a page, with zero counts for pages without regions."""
    return _with_ids(pages, regions).select(
        *PAGE,
        "rotation_degrees",
        F.col("page_width").alias("pixel_width"),
        F.col("page_height").alias("pixel_height"),
        "image",
        overlay_image(F.col("image")).alias("bbox_image"),
        "region_count",
        "region_ids",
    )


def render_manifest_pages(pages: DataFrame, regions: DataFrame, overlays: DataFrame | None = None) -> DataFrame:
    """As manifest pages; a page without an overlay has a null bbox_image_name, count and ids."""
    out = _with_ids(pages, regions)
    if overlays is None:
        overlays = pages.select(*PAGE, overlay_image(F.col("image")).alias("bbox_image"))
    out = out.join(overlays.select(*PAGE, F.col("bbox_image").alias("bbox_image_name")), PAGE, "left")
    there = F.col("bbox_image_name").isNotNull()
    return out.select(
        *PAGE,
        "rotation_degrees",
        F.col("page_width").alias("pixel_width"),
        F.col("page_height").alias("pixel_height"),
        F.col("image").alias("image_name"),
        "bbox_image_name",
        F.when(there, F.col("region_count")).alias("region_count"),
        F.when(there, F.col("region_ids")).alias("region_ids"),
    )


def overlay_coverage(pages: DataFrame, overlays: DataFrame) -> DataFrame:
    """Pages without an overlay and overlays without a page; empty if the sets agree."""
    left = pages.select(*PAGE, F.lit(True).alias("page"))
    right = overlays.select(*PAGE, F.lit(True).alias("overlay"))
    both = left.join(right, PAGE, "full")
    missing = F.when(F.col("overlay").isNull(), "overlay").when(F.col("page").isNull(), "page")
    return both.select(*PAGE, missing.alias("missing")).where(F.col("missing").isNotNull())


def color(kind: Column) -> Column:
    out = F.lit(None).cast("array<int>")
    for name, rgb in COLORS.items():
        out = F.when(kind == name, F.array(*map(F.lit, rgb))).otherwise(out)
    return out


def overlay_boxes(pages: DataFrame, regions: DataFrame, dpi: int | None = None, image_size: tuple[str, str] = ("page_width", "page_height")) -> DataFrame:
    """One row for each region to draw, and one with a null id for a page without any.

    ``image_size`` names the columns of ``pages`` with the saved image's size.
    """
    found = visual_regions(regions).select(*PAGE, "region_idx", "id", "kind", F.col("location").alias("at"))
    joined = pages.join(found, PAGE, "left")
    box = {}
    for k, edge in enumerate(EDGES):
        size, declared = (F.col(image_size[0]), F.col("at.page_width")) if k % 2 == 0 else (F.col(image_size[1]), F.col("at.page_height"))
        box[edge] = scaled(F.get(F.col("at.bbox"), F.lit(k)), size, declared)
    return joined.select(
        *PAGE,
        "image",
        "region_idx",
        "id",
        "kind",
        *[v.alias(k) for k, v in box.items()],
        color(F.col("kind")).alias("color"),
        outline_width(F.lit(dpi)).alias("line_width"),
        F.when(F.col("id").isNotNull(), caption(F.col("kind"), F.col("id"))).alias("caption"),
    )
