"""The layout pipeline: documents to pages, boxes, regions, status, overlays and artifacts."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import check_device, check_dpi, check_image_dir, detect_document_format, document_key_of
from ..operators.detection import document_status, resolve
from ..operators.manifests import overlay_boxes
from ..schemas import DEFAULT_DPI, DEFAULT_IMAGE_DIR, EXTENSIONS, FORMATS, SCHEMA_VERSION
from ..scratch import stored
from ..sources import contract_io, overlay, providers
from ..sources.files import absolute, is_file


class NotRegistered(LookupError):
    """A known format without an extractor."""


#: What a run raises for its input or its installation; anything else is a fault of the engine.
EXPECTED = (ValueError, OSError, RuntimeError, NotRegistered)


@dataclass(frozen=True)
class Artifacts:
    """Paths of one document's run."""

    output_dir: str
    manifest_path: str
    layout_path: str
    page_images: tuple[str, ...]
    bbox_images: tuple[str, ...]
    status: str


@dataclass(frozen=True)
class Run:
    """The tables of a run; ``unrendered`` has the documents that could not be opened."""

    documents: DataFrame
    pages: DataFrame
    regions: DataFrame
    errors: DataFrame
    overlays: DataFrame
    exported: DataFrame
    unrendered: DataFrame


def source_documents(spark: SparkSession, sources: list[str], dpi: int, resolve_paths: bool = True) -> DataFrame:
    rows = []
    for source in sources:
        full = absolute(source)
        rows.append((document_key_of(full), full if resolve_paths else source, detect_document_format(source), SCHEMA_VERSION, dpi))
    return spark.createDataFrame(rows, "doc_key string, source string, source_format string, schema_version string, dpi int")


def run_documents(
    documents: DataFrame,
    root: str,
    *,
    dpi: int = DEFAULT_DPI,
    image_dir: str = DEFAULT_IMAGE_DIR,
    device: str = "cpu",
    factory: Callable = providers.default_model,
    opener: Callable = providers.open_pdf,
    only_layout: bool = False,
) -> Run:
    """All documents of a table in one job.  ``root`` is a folder that executors share, or the URI of one.

    Rendered pages, raw boxes, judged boxes and overlays are stored in the shared folder before they
    branch: none is made twice, also where an executor is lost.  A document that can't be rendered is
    recorded and does not stop the others.
    """
    check_dpi(dpi), check_device(device)
    rendered = stored(providers.render(documents, root, dpi=dpi, image_dir=check_image_dir(image_dir), opener=opener), "rendered")
    unrendered = rendered.where(F.col("page_number").isNull() & F.col("exception_type").isNotNull()).select("doc_key", "exception_type", "message")
    pages = rendered.where(F.col("page_number").isNotNull()).drop("exception_type", "message")
    boxes = stored(providers.detect(pages, factory, device=device, root=root), "boxes")
    live = documents.join(unrendered.select("doc_key"), "doc_key", "left_anti")
    found = resolve(pages, boxes, keep=True)
    status = document_status(live, pages, found.regions, found.errors).select("doc_key", "status")
    live = live.join(status, "doc_key")
    overlays = stored(overlay.export(overlay_boxes(pages, found.regions, dpi), root), "overlays")
    exported = stored(contract_io.export(live, pages, found.regions, found.errors, overlays, root, only_layout=only_layout), "exported")
    return Run(live, pages, found.regions, found.errors, overlays, exported, unrendered)


def run_pdf_layout(spark: SparkSession, source: str, *, output_dir: str = "data/extraction", image_dir: str = DEFAULT_IMAGE_DIR, dpi: int = DEFAULT_DPI, device: str = "cpu", factory: Callable = providers.default_model, opener: Callable = providers.open_pdf) -> Artifacts:
    """One PDF, with all checks before any work; a render failure raises."""
    if detect_document_format(source) != "pdf":
        raise NotRegistered("the .docx format is known, but this command processes PDF input only")
    if not is_file(source):
        raise FileNotFoundError(f"the layout input does not exist: {source}")
    check_dpi(dpi), check_image_dir(image_dir), check_device(device)
    documents = source_documents(spark, [source], dpi)
    run = run_documents(documents, absolute(output_dir), dpi=dpi, image_dir=image_dir, device=device, factory=factory, opener=opener)
    if failed := run.unrendered.first():
        raise RuntimeError(f"{failed['exception_type']}: {failed['message']}")
    row = run.exported.first()
    folder = row["output_dir"]
    images = [(r["image"], r["bbox_image"]) for r in run.pages.join(run.overlays, ["doc_key", "page_number"]).orderBy("page_number").toLocalIterator()]
    for pair in images:
        for name in pair:
            contract_io.checked_artifact(f"{folder}/{name}", folder)
    return Artifacts(
        folder, f"{folder}/manifest.json", f"{folder}/layout.json", tuple(f"{folder}/{a}" for a, _ in images), tuple(f"{folder}/{b}" for _, b in images), row["status"]
    )


def render_pdf_layout_debug(spark: SparkSession, source: str, *, dpi: int = DEFAULT_DPI, output_dir: str = "data/extraction/pdf_debug", image_dir: str = DEFAULT_IMAGE_DIR, factory: Callable = providers.default_model, opener: Callable = providers.open_pdf) -> str:
    """The debug run: the source's path as given, no manifest; returns the path of layout.json."""
    if not source.lower().endswith(".pdf"):
        raise ValueError(f"PDF page rendering requires a .pdf source: {source}")
    documents = source_documents(spark, [source], check_dpi(dpi), resolve_paths=False)
    run = run_documents(documents, absolute(output_dir), dpi=dpi, image_dir=image_dir, factory=factory, opener=opener, only_layout=True)
    if failed := run.unrendered.first():
        raise RuntimeError(f"{failed['exception_type']}: {failed['message']}")
    return f"{run.exported.first()['output_dir']}/layout.json"


@runtime_checkable
class Extractor(Protocol):
    """What ``extract`` can send a source to."""

    document_format: str

    def supports(self, source: str | None) -> bool: ...

    def extract(self, spark: SparkSession, source: str) -> DataFrame: ...


class FormatExtractor:
    """An extractor of one format from a callable that gives documents with source_format."""

    def __init__(self, document_format: str, read: Callable[[SparkSession, str], DataFrame]) -> None:
        if document_format not in FORMATS:
            raise ValueError(f"an extractor needs a known format, one of {', '.join(FORMATS)}")
        self.document_format, self._read = document_format, read

    def supports(self, source: str | None) -> bool:
        """False for what has no known format, and for null."""
        suffix = os.path.splitext(source)[1].lower() if source else ""
        return EXTENSIONS.get(suffix) == self.document_format

    def extract(self, spark: SparkSession, source: str) -> DataFrame:
        return self._read(spark, source)


def find_extractor(source: str, extractors) -> Extractor:
    """The one extractor of a source's format; a dict or pairs (format, callable) are wrapped."""
    given = extractors.items() if isinstance(extractors, dict) else extractors
    held = [e if isinstance(e, Extractor) else FormatExtractor(*e) for e in given]
    wanted = detect_document_format(source)
    by_format = [e for e in held if e.document_format == wanted]
    if len(by_format) == 1:
        return by_format[0]
    if by_format:
        raise ValueError(f"several layout extractors are registered for .{wanted} input")
    raise NotRegistered(f"no layout extractor is registered for .{wanted} input")


def extract(spark: SparkSession, source: str, extractors) -> DataFrame:
    """A source's documents from its registered extractor, whose format they must have."""
    chosen = find_extractor(source, extractors)
    wanted, result = chosen.document_format, chosen.extract(spark, source)
    wrong = result.where(~F.col("source_format").eqNullSafe(F.lit(wanted)))
    if wrong.take(1):
        raise ValueError("the layout extractor returned a document with another source_format")
    return result
