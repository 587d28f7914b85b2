"""Names: formats, slugs, document keys, region ids, artifact paths."""

from __future__ import annotations

import hashlib
import posixpath
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..schemas import EXTENSIONS, OVERLAY_DIR

SUPPORTED = ", ".join(EXTENSIONS)


class UnsupportedFormat(ValueError):
    """The source's extension has no format."""


def basename(path: Column) -> Column:
    """The last part of a path, without trailing slashes."""
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def suffix(path: Column) -> Column:
    """The last extension with its dot, lower-cased, or empty."""
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    name = basename(path)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(.+)\.[^.]+$", 1), F.lit("")), name)


def detect_format(path: Column) -> Column:
    """pdf, docx, or null."""
    out = F.lit(None).cast("string")
    for extension, name in EXTENSIONS.items():
        out = F.when(suffix(path) == extension, name).otherwise(out)
    return out


def format_error(path: Column) -> Column:
    """What is wrong with a path whose format is null."""
    shown = F.coalesce(F.nullif(suffix(path), F.lit("")), F.lit("<no extension>"))
    return F.when(detect_format(path).isNull(), F.concat(F.lit("no layout format for '"), shown, F.lit(f"'; supported: {SUPPORTED}")))


def detect_document_format(source: str) -> str:
    """The driver's form of ``detect_format``; raises."""
    found = re.search(r"^.+(\.[^.]+)$", posixpath.basename(str(source).rstrip("/")))
    extension = found[1].lower() if found else ""
    if extension not in EXTENSIONS:
        raise UnsupportedFormat(f"no layout format for {extension or '<no extension>'!r}; supported: {SUPPORTED}")
    return EXTENSIONS[extension]


def slug(path: Column) -> Column:
    clean = F.btrim(F.regexp_replace(stem(path), r"[^A-Za-z0-9._-]+", "_"), F.lit("._-"))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("document"))


@F.pandas_udf(StringType())
def _folded(path: pd.Series) -> pd.Series:
    """Full case folding, which Spark's lower() is not."""
    return path.map(lambda p: None if p is None else p.casefold())


def path_hash(path: Column) -> Column:
    """12 hex digits for a resolved path, by its folded form."""
    return F.substring(F.sha2(_folded(path).cast("binary"), 256), 1, 12)


def document_key(path: Column) -> Column:
    return F.concat_ws("-", slug(path), path_hash(path))


def document_key_of(source: str) -> str:
    """The driver's form of ``document_key`` for an absolute path."""
    name = posixpath.basename(source.rstrip("/"))
    found = re.search(r"^(.+)\.[^.]+$", name)
    clean = re.sub(r"[^A-Za-z0-9._-]+", "_", found[1] if found else name).strip("._-")
    return f"{clean or 'document'}-{hashlib.sha256(source.casefold().encode()).hexdigest()[:12]}"


def region_id(page_number: Column, index: Column) -> Column:
    return F.format_string("p%04d-r%04d", page_number, index)


def page_image(image_dir: str, page_number: Column) -> Column:
    return F.concat_ws("/", F.lit(image_dir), F.format_string("page-%04d.png", page_number))


def overlay_image(image: Column) -> Column:
    return F.concat(F.lit(OVERLAY_DIR + "/"), stem(image), F.lit("_bbox.png"))


def caption(kind: Column, region: Column) -> Column:
    return F.concat_ws(":", kind, region)


def image_dir_error(image_dir: Column) -> Column:
    """Why a folder can't hold page images, or null."""
    parts = F.filter(F.split(image_dir, "/"), lambda p: (p != "") & (p != "."))
    first = F.lower(F.get(parts, F.lit(0)))
    outside = image_dir.startswith("/") | (F.size(parts) == 0) | F.array_contains(parts, "..")
    return F.when(outside, "not_relative").when(first == OVERLAY_DIR, "reserved")


def check_image_dir(image_dir: str) -> str:
    parts = [p for p in image_dir.split("/") if p not in ("", ".")]
    if image_dir.startswith("/") or not parts or ".." in parts:
        raise ValueError("image_dir has to be a relative subdirectory without '..'")
    if parts[0].casefold() == OVERLAY_DIR:
        raise ValueError(f"image_dir can't lie in '{OVERLAY_DIR}', which holds the overlays")
    return "/".join(parts)


def check_dpi(dpi: object) -> int:
    """A whole number from 1 on, of type int itself: True is none."""
    if type(dpi) is int and dpi > 0:
        return dpi
    raise ValueError(f"dpi has to be a positive integer, not {dpi!r}")


def check_device(device: object) -> str:
    name = device.strip() if isinstance(device, str) else ""
    if name:
        return name
    raise ValueError(f"device has to be a nonblank string, not {device!r}")
