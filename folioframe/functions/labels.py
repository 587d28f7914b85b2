"""Detector labels to (kind, role)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the layout contract: (kind, role) and its labels.
LABELS = {
    ("text", "body"): ("text",),
    ("table", "body"): ("table", "document_index"),
    ("picture", "body"): ("image", "picture", "figure", "chart", "seal"),
    ("picture", "header"): ("header_image",),
    ("picture", "footer"): ("footer_image",),
    ("text", "header"): ("header", "page_header"),
    ("text", "footer"): ("footer", "page_footer"),
    ("text", "page_number"): ("page_number", "number"),
    ("text", "title"): ("title", "document_title", "paragraph_title", "section_header", "figure_title", "table_title", "table_caption"),
}
UNKNOWN = ("other", "body")

#: What a label is stripped of before lookup: Unicode white space and the four separators.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: What stored strings are stripped of: Unicode white space alone.
_STORED_EDGES = r"(?U)^\s+|\s+$"


def stripped(value: Column) -> Column:
    """As strings are stored."""
    return F.regexp_replace(value, _STORED_EDGES, "")


def lookup_key(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, _EDGES, ""))


def kind_role(label: Column) -> Column:
    """struct(kind, role); labels without an entry are ("other", "body").  Folds to one literal map."""
    pairs = [(F.lit(name), F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"))) for (kind, role), names in LABELS.items() for name in names]
    table = F.create_map(*reduce(lambda a, b: a + b, pairs))
    other = F.struct(F.lit(UNKNOWN[0]).alias("kind"), F.lit(UNKNOWN[1]).alias("role"))
    return F.coalesce(F.try_element_at(table, lookup_key(label)), other)
