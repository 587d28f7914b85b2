"""The contract's constraints as columns: each gives the name of the first broken one, or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FORMATS, KINDS, ORIGIN, ROLES, STATUSES
from .geometry import is_finite
from .labels import stripped


def _blank(value: Column) -> Column:
    return value.isNull() | (stripped(value) == "")


def _outside(value: Column, domain: tuple[str, ...]) -> Column:
    return value.isNull() | ~value.isin(*domain)


def visual_error(page_number: Column, bbox: Column, width: Column, height: Column, origin: Column) -> Column:
    x0, y0, x1, y1 = (F.get(bbox, F.lit(k)) for k in range(4))
    return (
        F.when(page_number.isNull() | (page_number < 1), "page_number")
        .when(bbox.isNull() | (F.size(bbox) != 4), "bbox_count")
        .when(F.exists(bbox, lambda v: v.isNull() | ~is_finite(v)), "bbox_not_finite")
        .when(width.isNull() | height.isNull() | ~is_finite(width) | ~is_finite(height) | (width <= 0) | (height <= 0), "page_size")
        .when(origin.isNull() | (origin != ORIGIN), "coordinate_origin")
        .when((x0 < 0) | (y0 < 0), "bbox_negative")
        .when((x0 >= x1) | (y0 >= y1), "bbox_no_area")
        .when((x1 > width) | (y1 > height), "bbox_off_page")
    )


def structural_error(source_format: Column, item_ref: Column) -> Column:
    return F.when(_outside(source_format, FORMATS), "source_format").when(_blank(item_ref), "item_ref")


def region_error(region: Column, kind: Column, role: Column, raw_label: Column, confidence: Column) -> Column:
    return (
        F.when(_blank(region), "id")
        .when(_outside(kind, KINDS), "kind")
        .when(_outside(role, ROLES), "role")
        .when(_blank(raw_label), "raw_label")
        .when(confidence.isNotNull() & (F.isnan(confidence) | ~confidence.between(0.0, 1.0)), "confidence")
    )


def derived_status(n_regions: Column, n_errors: Column) -> Column:
    """No errors: complete.  Errors and a region: partial.  Else failed."""
    return F.when(n_errors == 0, "complete").when(n_regions > 0, "partial").otherwise("failed")


def document_error(version: Column, source: Column, source_format: Column, status: Column, n_regions: Column, n_errors: Column) -> Column:
    return (
        F.when(version.isNull() | ~version.rlike(r"^[0-9]+\.[0-9]+$"), "schema_version")
        .when(_blank(source), "source")
        .when(_outside(source_format, FORMATS), "source_format")
        .when(_outside(status, STATUSES), "status")
        .when(status != derived_status(n_regions, n_errors), "status_mismatch")
    )
