"""Tables of the layout engine, and the values its contract fixes."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the layout contract.
SCHEMA_VERSION = "1.0"
MANIFEST_VERSION = "1.0"
FORMATS = ("pdf", "docx")
EXTENSIONS = {".pdf": "pdf", ".docx": "docx"}
STATUSES = ("complete", "partial", "failed")
KINDS = ("text", "table", "picture", "other")
ROLES = ("body", "title", "header", "footer", "page_number")
ORIGIN = "top_left"
MODEL_NAME = "PP-DocLayout_plus-L"
DEFAULT_DPI = 200
DEFAULT_IMAGE_DIR = "pages"
OVERLAY_DIR = "bbox"
POINTS_PER_INCH = 72
COLORS = {"text": (255, 196, 0), "table": (255, 48, 48), "picture": (0, 180, 255), "other": (255, 0, 255)}

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<double>": T.ArrayType(T.DoubleType())}


def struct(fields: str) -> T.StructType:
    """A schema from ``name type, ...``, without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(","))])


DOCUMENTS = struct("doc_key string, source string, source_format string, schema_version string, dpi int")
PAGES = struct("doc_key string, page_number int, image string, page_width int, page_height int, rotation_degrees int")
#: One row for each detected box, and one with box_idx null for a page that gave none.  A row with an
#: exception_type stands where the detector raised, behind the boxes that it gave before.
RAW_BOXES = struct(
    "doc_key string, page_number int, box_idx int, is_mapping boolean, label string, label_ok boolean, score double, score_error string,"
    " coord_error string, x0 double, y0 double, x1 double, y1 double, exception_type string, message string"
)
ERRORS = struct("doc_key string, page_number int, exception_type string, code string, message string")
LOCATION = struct(
    "type string, page_number int, bbox array<double>, page_width double, page_height double, coordinate_origin string, source_format string, item_ref string"
)
REGIONS = T.StructType(
    [
        *struct("doc_key string, region_idx int, id string, kind string, role string, raw_label string, confidence double"),
        T.StructField("location", LOCATION),
    ]
)
