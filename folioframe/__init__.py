"""folioframe: page-layout contracts and corpus preparation as Spark DataFrame plans."""

from __future__ import annotations

import os
from importlib import import_module

__version__ = "0.1.0"

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark) -> None:
    """Let Python workers import this package from where the driver has it, if nothing else does."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, path)))


#: The layout engine's public names and their modules, imported when first asked for.
_PUBLIC = {
    "schemas": ("COLORS", "DOCUMENTS", "ERRORS", "FORMATS", "KINDS", "LOCATION", "MODEL_NAME", "PAGES", "RAW_BOXES", "REGIONS", "ROLES", "SCHEMA_VERSION", "STATUSES"),
    "functions.labels": ("kind_role",),
    "functions.naming": ("UnsupportedFormat", "detect_document_format", "detect_format", "document_key"),
    "operators.detection": ("Resolved", "document_status", "resolve"),
    "operators.dispatch": ("dispatch",),
    "operators.manifests": ("manifest_pages", "overlay_boxes", "render_manifest_pages"),
    "plans.pipeline": (
        "Artifacts",
        "Extractor",
        "FormatExtractor",
        "NotRegistered",
        "Run",
        "extract",
        "find_extractor",
        "render_pdf_layout_debug",
        "run_documents",
        "run_pdf_layout",
        "source_documents",
    ),
    "sources.contract_io": ("layout_json", "loaded", "parsed", "unknown_fields", "violations"),
    "sources.overlay": ("crops",),
    "sources.providers": ("decode_box", "detect", "render"),
}
_MODULE_OF = {name: module for module, names in _PUBLIC.items() for name in names}
__all__ = ["ship", *_MODULE_OF]


def __getattr__(name: str):
    if name not in _MODULE_OF:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_MODULE_OF[name]}"), name)
