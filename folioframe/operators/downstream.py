"""Extensions for consumers of the tables: regions with OCR boxes, tables and crops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import POINTS_PER_INCH
from .manifests import visual_regions

PAGE = ["doc_key", "page_number"]


def flat_regions(regions: DataFrame) -> DataFrame:
    """Page, id and page box of every visual region, as every later row should carry them."""
    box = [F.get(F.col("location.bbox"), F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))]
    return visual_regions(regions).select(*PAGE, "region_idx", "id", "kind", "role", "raw_label", "confidence", *box)


def associate(regions: DataFrame, ocr: DataFrame) -> DataFrame:
    """OCR boxes (x0..y1 in page pixels) with the regions they overlap, and the overlap's area.

    Page is an equi key; the rectangle test is a residual of the same join.
    """
    r, o = flat_regions(regions).alias("r"), ocr.alias("o")
    width = F.least("r.x1", "o.x1") - F.greatest("r.x0", "o.x0")
    height = F.least("r.y1", "o.y1") - F.greatest("r.y0", "o.y0")
    on = (F.col("r.doc_key") == F.col("o.doc_key")) & (F.col("r.page_number") == F.col("o.page_number")) & (width > 0) & (height > 0)
    names = [F.col(f"o.{c}") for c in ocr.columns]
    return r.join(o, on).select(*names, F.col("r.id").alias("region_id"), (width * height).alias("overlap"))


def from_crop(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """Boxes in a region's crop (doc_key, page_number, id, x0..y1) moved to page pixels."""
    origin = flat_regions(regions).select(*PAGE, "id", F.col("x0").alias("_x"), F.col("y0").alias("_y"))
    moved = {c: F.col(c) + F.col("_x" if c[0] == "x" else "_y") for c in ("x0", "y0", "x1", "y1")}
    return boxes.join(origin, [*PAGE, "id"]).withColumns(moved).drop("_x", "_y")


def from_points(boxes: DataFrame, pages: DataFrame, dpi: int, bottom_left: bool = False) -> DataFrame:
    """Boxes in PDF points to page pixels; ``bottom_left`` flips a y axis that points up."""
    scale = dpi / POINTS_PER_INCH
    out = boxes.join(pages.select(*PAGE, "page_height"), PAGE)
    low, high = (F.col("page_height") - F.col("y1") * scale, F.col("page_height") - F.col("y0") * scale) if bottom_left else (F.col("y0") * scale, F.col("y1") * scale)
    return out.withColumns({"x0": F.col("x0") * scale, "x1": F.col("x1") * scale, "y0": low, "y1": high}).drop("page_height")


def tables(regions: DataFrame) -> DataFrame:
    return flat_regions(regions).where(F.col("kind") == "table")


def attach(regions: DataFrame, output: DataFrame) -> DataFrame:
    """OCR or table output (doc_key, page_number, id, ...) joined back; regions without any stay."""
    return flat_regions(regions).join(output, [*PAGE, "id"], "left")
