"""Raw boxes to regions, page errors and status.

Everything from raw boxes to status is Catalyst expressions.  A page's regions and its error come from
one window over (doc_key, page_number): the only shuffle of the box rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import derived_status
from ..functions.geometry import EDGES, box_error, clamped_box, exception_type, message
from ..functions.labels import kind_role, stripped
from ..functions.naming import region_id
from ..schemas import LOCATION, ORIGIN
from ..scratch import stored

PAGE = ["doc_key", "page_number"]


@dataclass(frozen=True)
class Resolved:
    regions: DataFrame
    errors: DataFrame


def checked_boxes(pages: DataFrame, raw_boxes: DataFrame) -> DataFrame:
    """Raw boxes with their page's size and the code of their first error (``code``, null if good)."""
    sized = raw_boxes.join(pages.select(*PAGE, "page_width", "page_height"), PAGE)
    code = F.when(F.col("exception_type").isNotNull(), "detector").otherwise(box_error())
    return sized.where(F.col("box_idx").isNotNull()).withColumn("code", code)


def with_page_outcome(checked: DataFrame) -> DataFrame:
    """Adds ``first_bad``: box_idx and code of the page's first bad box, or null."""
    bad = F.when(F.col("code").isNotNull(), F.struct("box_idx", "code"))
    return checked.withColumn("first_bad", F.min(bad).over(Window.partitionBy(*PAGE)))


def good_regions(outcome: DataFrame) -> DataFrame:
    """The regions of pages without a bad box; a bad box drops its page's good ones."""
    held = clamped_box(*(F.col(e) for e in EDGES), F.col("page_width"), F.col("page_height"))
    named = kind_role(F.col("label"))
    # The first box of a page is 1, so box_idx is the running index within the page.
    location = F.struct(
        F.lit("visual").alias("type"),
        "page_number",
        F.array(*(held[e] for e in EDGES)).alias("bbox"),
        F.col("page_width").cast("double").alias("page_width"),
        F.col("page_height").cast("double").alias("page_height"),
        F.lit(ORIGIN).alias("coordinate_origin"),
        F.lit(None).cast("string").alias("source_format"),
        F.lit(None).cast("string").alias("item_ref"),
    ).cast(LOCATION)
    return outcome.where(F.col("first_bad").isNull()).select(
        "doc_key",
        F.col("box_idx").alias("region_idx"),
        region_id(F.col("page_number"), F.col("box_idx")).alias("id"),
        named["kind"].alias("kind"),
        named["role"].alias("role"),
        stripped(F.col("label")).alias("raw_label"),
        F.col("score").alias("confidence"),
        location.alias("location"),
    )


def box_errors(outcome: DataFrame) -> DataFrame:
    code = F.col("code")
    kind, text = F.coalesce("exception_type", exception_type(code)), F.when(F.col("exception_type").isNotNull(), stripped(F.col("message"))).otherwise(message(code))
    return outcome.where(F.col("box_idx") == F.col("first_bad")["box_idx"]).select(*PAGE, kind.alias("exception_type"), "code", text.alias("message"))


def raised_errors(raw_boxes: DataFrame) -> DataFrame:
    """Pages on which the detector raised before any box."""
    return raw_boxes.where(F.col("box_idx").isNull() & F.col("exception_type").isNotNull()).select(
        *PAGE, "exception_type", F.lit("detector").alias("code"), stripped(F.col("message")).alias("message")
    )


def init_errors(pages: DataFrame, failed_documents: DataFrame) -> DataFrame:
    """A document whose detector could not be created fails on every page.

    ``failed_documents``: doc_key, and optionally exception_type and message.
    """
    given = failed_documents.columns
    kind = F.col("exception_type") if "exception_type" in given else exception_type(F.lit("init_failure"))
    text = stripped(F.col("message")) if "message" in given else message(F.lit("init_failure"))
    return pages.select(*PAGE).join(failed_documents, "doc_key").select(*PAGE, kind.alias("exception_type"), F.lit("init_failure").alias("code"), text.alias("message"))


def resolve(pages: DataFrame, raw_boxes: DataFrame, failed_documents: DataFrame | None = None, keep: bool = False) -> Resolved:
    """Regions and errors of all documents.  Pages of failed documents are not looked at.

    With ``keep`` the judged boxes are stored: those who read regions and errors several times pay
    for the shuffle and the window once.
    """
    live = pages if failed_documents is None else pages.join(failed_documents.select("doc_key"), "doc_key", "left_anti")
    raised = raised_errors(raw_boxes).join(live.select(*PAGE), PAGE, "left_semi")
    outcome = with_page_outcome(checked_boxes(live, raw_boxes))
    if keep:
        outcome = stored(outcome, "judged")
    errors = raised.unionByName(box_errors(outcome))
    if failed_documents is not None:
        errors = errors.unionByName(init_errors(pages, failed_documents))
    return Resolved(good_regions(outcome), errors)


def document_counts(documents: DataFrame, pages: DataFrame, regions: DataFrame, errors: DataFrame) -> DataFrame:
    """doc_key, page_count, region_count, error_count; documents without any have zeros.

    The three tables are stacked as one-column counts and summed together: one shuffle, with sums
    before it.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    names = ("page_count", "region_count", "error_count")
    stacked = None
    for k, table in enumerate((pages, regions, errors)):
        part = table.select("doc_key", *[(one if j == k else zero).alias(n) for j, n in enumerate(names)])
        stacked = part if stacked is None else stacked.unionAll(part)
    sums = stacked.groupBy("doc_key").agg(*[F.sum(n).alias(n) for n in names])
    return documents.select("doc_key").join(sums, "doc_key", "left").fillna(0, list(names))


def document_status(documents: DataFrame, pages: DataFrame, regions: DataFrame, errors: DataFrame) -> DataFrame:
    """The counts, and ``status`` derived from them."""
    counts = document_counts(documents, pages, regions, errors)
    return counts.withColumn("status", derived_status(F.col("region_count"), F.col("error_count")))
