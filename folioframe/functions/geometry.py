"""Boxes: clamping, the error of a raw box, and overlay coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import POINTS_PER_INCH
from .labels import lookup_key

EDGES = ("x0", "y0", "x1", "y1")

#: Codes of page errors, with the exception type each stands for and a message.
ERROR_CODES = {
    "box_not_mapping": ("ValueError", "a detector box has to be a mapping"),
    "label_blank": ("ValueError", "a detector box needs a label that is a nonblank string"),
    "score_missing": ("KeyError", "'score'"),
    "score_type": ("TypeError", "the score is no number"),
    "score_value": ("ValueError", "the score is no number"),
    "page_size": ("ValueError", "the page needs a positive width and height"),
    "coord_count": ("ValueError", "a bounding box needs four coordinates"),
    "coord_not_real": ("ValueError", "bounding box coordinates have to be real numbers"),
    "coord_not_finite": ("ValueError", "bounding box coordinates have to be finite"),
    "no_area": ("ValueError", "a bounding box needs a positive width and height"),
    "off_page": ("ValueError", "the bounding box lies outside the page"),
    "confidence_range": ("ValidationError", "the confidence has to lie between 0 and 1"),
    "init_failure": ("RuntimeError", "the detector could not be created"),
}


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def clamp(value: Column, size: Column) -> Column:
    """Into [0, size]; adding zero turns -0.0 into 0.0."""
    return F.least(F.greatest(value, F.lit(0.0)), size.cast("double")) + F.lit(0.0)


def clamped_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    return {"x0": clamp(x0, width), "y0": clamp(y0, height), "x1": clamp(x1, width), "y1": clamp(y1, height)}


def box_error(width: str = "page_width", height: str = "page_height") -> Column:
    """The code of a raw box's first error in the fixed order of checks, or null.

    Reads the columns of RAW_BOXES; types were judged by the provider, values are judged here.
    """
    c = F.col
    held = clamped_box(*(c(e) for e in EDGES), c(width), c(height))
    finite = [~is_finite(c(e)) | c(e).isNull() for e in EDGES]
    return (
        F.when(~c("is_mapping"), "box_not_mapping")
        .when(~c("label_ok") | (lookup_key(c("label")) == ""), "label_blank")
        .when(c("score_error").isNotNull(), F.concat(F.lit("score_"), c("score_error")))
        .when((c(width) <= 0) | (c(height) <= 0), "page_size")
        .when(c("coord_error").isNotNull(), F.concat(F.lit("coord_"), c("coord_error")))
        .when(finite[0] | finite[1] | finite[2] | finite[3], "coord_not_finite")
        .when((c("x0") >= c("x1")) | (c("y0") >= c("y1")), "no_area")
        .when((held["x0"] >= held["x1"]) | (held["y0"] >= held["y1"]), "off_page")
        .when(F.isnan("score") | ~c("score").between(0.0, 1.0), "confidence_range")
    )


def _by_code(code: Column, part: int) -> Column:
    out = F.lit(None).cast("string")
    for name, texts in ERROR_CODES.items():
        out = F.when(code == name, texts[part]).otherwise(out)
    return out


def exception_type(code: Column) -> Column:
    return _by_code(code, 0)


def message(code: Column) -> Column:
    return _by_code(code, 1)


def render_scale(dpi: Column) -> Column:
    return dpi.cast("double") / F.lit(float(POINTS_PER_INCH))


def scaled(value: Column, image_size: Column, page_size: Column) -> Column:
    """A page coordinate in image pixels, rounded half to even."""
    return F.rint(value * (image_size.cast("double") / page_size.cast("double"))).cast("int")


def outline_width(dpi: Column) -> Column:
    return F.greatest(F.lit(2), F.floor(dpi / 80).cast("int"))
