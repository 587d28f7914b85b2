"""Providers: page rendering and layout detection as table functions.

Rendering and detection libraries are injected through picklable factories and imported on the
executors.  Python decides the types of what a detector returns; values are judged by Catalyst.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from numbers import Real
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.naming import check_device, check_dpi, check_image_dir
from ..schemas import DEFAULT_DPI, DEFAULT_IMAGE_DIR, MODEL_NAME, PAGES, POINTS_PER_INCH, RAW_BOXES
from . import png
from .files import is_uri, read_file, write_file


class LayoutModel(Protocol):
    def predict(self, input: Any, *, batch_size: int) -> Iterable[Any]: ...


ModelFactory = Callable[..., LayoutModel]
#: (path, scale) -> an iterator of (RGB array, rotation in degrees), one for each page.
PageOpener = Callable[[str, float], Iterable[tuple[Any, int]]]


def default_model(*, model_name: str, device: str) -> LayoutModel:
    from paddleocr import LayoutDetection

    # The CPU build of the inference runtime fails with oneDNN.
    return LayoutDetection(model_name=model_name, device=device, enable_mkldnn=False)


def open_pdf(path: str, scale: float) -> Iterator[tuple[Any, int]]:
    try:
        import pypdfium2
    except ImportError as error:
        raise RuntimeError("rendering PDF pages needs pypdfium2") from error
    import numpy as np

    document = pypdfium2.PdfDocument(read_file(path) if is_uri(path) else path)
    try:
        for k in range(len(document)):
            page = document[k]
            try:
                bitmap = page.render(scale=scale)
                try:
                    yield np.asarray(bitmap.to_pil().convert("RGB")), page.get_rotation()
                finally:
                    bitmap.close()
            finally:
                page.close()
    finally:
        document.close()


_ARROW = {"string": pa.string(), "integer": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in schema])


def render(
    documents: DataFrame,
    root: str,
    *,
    dpi: int = DEFAULT_DPI,
    image_dir: str = DEFAULT_IMAGE_DIR,
    opener: PageOpener = open_pdf,
    write: Callable[[str, bytes], None] = write_file,
) -> DataFrame:
    """PAGES, and exception_type and message: a document that can't be rendered gives one row without a page.

    Page images are written below ``root``/doc_key, a folder that executors share or a URI, and travel as paths.
    """
    check_dpi(dpi)
    image_dir = check_image_dir(image_dir)
    schema = T.StructType([*PAGES, *RAW_BOXES.fields[-2:]])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for key, source in zip(part["doc_key"].to_pylist(), part["source"].to_pylist(), strict=True):
                rows = []
                try:
                    if not source.lower().endswith(".pdf"):
                        raise ValueError(f"page rendering requires a .pdf source: {source}")
                    for k, (image, rotation) in enumerate(opener(source, dpi / POINTS_PER_INCH), 1):
                        name = f"{image_dir}/page-{k:04d}.png"
                        write(f"{root}/{key}/{name}", png.encode(image))
                        rows.append(dict(zip(PAGES.names, (key, k, name, image.shape[1], image.shape[0], rotation), strict=True)))
                except Exception as error:  # noqa: BLE001 - recorded for this document
                    rows = [{"doc_key": key, "exception_type": type(error).__name__, "message": str(error)}]
                yield pa.RecordBatch.from_pylist(rows, arrow_schema(schema))

    return documents.select("doc_key", "source").mapInArrow(run, schema)


_COORDINATES = ("x0", "y0", "x1", "y1")


def decode_box(box: Any) -> dict[str, Any]:
    """One detected box as a wire row without its page: types are decided here, in Python."""
    row: dict[str, Any] = dict.fromkeys(("label", "score", "score_error", "coord_error", *_COORDINATES))
    row |= {"is_mapping": isinstance(box, Mapping), "label_ok": False}
    if not row["is_mapping"]:
        return row
    label = box.get("label")
    row["label_ok"] = isinstance(label, str) and bool(label.strip())
    row["label"] = label if isinstance(label, str) else None
    if "score" not in box:
        row["score_error"] = "missing"
    else:
        try:
            row["score"] = float(box["score"])
        except (TypeError, ValueError, OverflowError) as error:
            row["score_error"] = "type" if isinstance(error, TypeError) else "value"
    given = box.get("coordinate")
    if isinstance(given, (str, bytes)) or not isinstance(given, Sequence) or len(given) != 4:
        row["coord_error"] = "count"
        return row
    for name, value in zip(_COORDINATES, given, strict=True):
        if isinstance(value, bool) or not isinstance(value, Real):
            row["coord_error"] = "not_real"
            break
        row[name] = float(value)
        if not math.isfinite(row[name]):
            row["coord_error"] = "not_finite"
            break
    return row


_models: dict[tuple, Any] = {}


def _model(factory: ModelFactory, device: str) -> Any:
    """One model in each Python worker; a failure is remembered too."""
    key = (factory, device)
    if key not in _models:
        try:
            _models[key] = factory(model_name=MODEL_NAME, device=device)
        except Exception as error:  # noqa: BLE001 - becomes the pages' error
            _models[key] = error
    return _models[key]


def _input(path: str) -> Any:
    return png.decode(read_file(path))[:, :, ::-1] if is_uri(path) else path


def detect(pages: DataFrame, factory: ModelFactory = default_model, *, device: str = "cpu", root: str = "") -> DataFrame:
    """RAW_BOXES of every page.  A page without boxes, or that raised before any, has one row without box_idx.

    The model gets an image's path, and where ``root`` is a URI its pixels, in the order blue, green, red.

    A raise after boxes is a row behind them with its exception_type: the first that is wrong counts.

    The model is made when a worker's first page comes; without pages there is none.  Keep the
    result (write or persist it) before branching, or detection runs again.
    """
    device = check_device(device)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for key, number, image in zip(*(part[c].to_pylist() for c in ("doc_key", "page_number", "image")), strict=True):
                rows: list[dict] = []
                page = {"doc_key": key, "page_number": number}
                try:
                    model = _model(factory, device)
                    if isinstance(model, Exception):
                        rows = [{"exception_type": type(model).__name__, "message": str(model)}]
                    else:
                        for prediction in model.predict(_input(f"{root}/{key}/{image}" if root else image), batch_size=1):
                            data = prediction.json
                            boxes = data.get("res", data).get("boxes", [])
                            rows += [decode_box(b) | {"box_idx": len(rows) + k} for k, b in enumerate(boxes, 1)]
                except Exception as error:  # noqa: BLE001 - becomes the page's error, if no box before it is bad
                    place = {"box_idx": len(rows) + 1} if rows else {}
                    rows.append(place | {"exception_type": type(error).__name__, "message": str(error)})
                out += [page | r for r in rows] or [page]
            yield pa.RecordBatch.from_pylist(out, arrow_schema(RAW_BOXES))

    return pages.select("doc_key", "page_number", "image").mapInArrow(run, RAW_BOXES)
