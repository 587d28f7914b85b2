"""Overlays: page copies with their regions outlined and captioned."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.downstream import flat_regions
from ..schemas import OVERLAY_DIR
from . import png
from .files import read_file, write_file

# A 3 x 5 bitmap font: five rows of three bits for each character.  The caption's look is free.
_GLYPHS = {
    "0": "757", "1": "262", "2": "743", "3": "717", "4": "571", "5": "617", "6": "477", "7": "711", "8": "777", "9": "771",
    "a": "257", "b": "676", "c": "747", "d": "656", "e": "767", "f": "764", "g": "757", "h": "575", "i": "222", "j": "116",
    "k": "565", "l": "447", "m": "775", "n": "655", "o": "757", "p": "774", "q": "771", "r": "765", "s": "616", "t": "722",
    "u": "557", "v": "552", "w": "577", "x": "525", "y": "572", "z": "727", ":": "202", "-": "070",
}


def text_mask(text: str) -> np.ndarray:
    """Booleans 9 rows high; each character takes 8 columns, drawn twice its glyph's size."""
    out = np.zeros((9, 8 * len(text) + 1), bool)
    for k, char in enumerate(text.lower()):
        for row, bits in enumerate(_GLYPHS.get(char, "777")):
            for col in range(3):
                if int(bits) >> (2 - col) & 1:
                    out[1 + 2 * row + row // 2 : 3 + 2 * row, 1 + 8 * k + 2 * col : 3 + 8 * k + 2 * col] = True
    return out


def rectangle(image: np.ndarray, box: tuple[int, int, int, int], color: tuple[int, ...], width: int | None) -> None:
    """An outline that grows inwards and includes the far corner, or a filled box; clipped to the image."""
    height, across = image.shape[:2]
    x0, y0, x1, y1 = box

    def fill(a: int, b: int, c: int, d: int) -> None:
        if c >= a and d >= b:
            image[max(b, 0) : min(d + 1, height), max(a, 0) : min(c + 1, across)] = color

    if width is None:
        fill(x0, y0, x1, y1)
        return
    fill(x0, y0, x1, min(y0 + width - 1, y1))
    fill(x0, max(y1 - width + 1, y0), x1, y1)
    fill(x0, y0, min(x0 + width - 1, x1), y1)
    fill(max(x1 - width + 1, x0), y0, x1, y1)


def draw(image: np.ndarray, boxes: list[dict]) -> np.ndarray:
    """Regions paint in list order: outline, caption box, caption."""
    image = image.copy()
    for b in boxes:
        rectangle(image, (b["x0"], b["y0"], b["x1"], b["y1"]), tuple(b["color"]), b["line_width"])
        mask = text_mask(b["caption"])
        x, y = b["x0"], b["y0"]
        rectangle(image, (x, y, x + mask.shape[1] - 1, y + mask.shape[0] - 1), tuple(b["color"]), None)
        if x >= 0 and y >= 0:
            part = image[y : y + mask.shape[0], x : x + mask.shape[1]]
            part[mask[: part.shape[0], : part.shape[1]]] = 0
    return image


def export(boxes: DataFrame, root: str, read: Callable[[str], bytes] = read_file, write: Callable[[str, bytes], None] = write_file) -> DataFrame:
    """Write an overlay for every page of ``boxes`` (see ``overlay_boxes``); doc_key, page_number, bbox_image.

    Executors open paths below ``root``, a folder they share or a URI.  One page's boxes meet in one task.
    ``read`` and ``write`` may go to another store.  ``image`` must hold paths: another type is refused
    here, and a page without a path before any image of its task is read.
    """
    kind = boxes.schema["image"].dataType.simpleString()
    if kind != "string":
        raise TypeError(f"overlays need the path of each page's image as a string, not as {kind}")

    def pages(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            if bare := [f"{r['doc_key']}/{r['page_number']}" for r in part.select(["doc_key", "page_number", "image"]).to_pylist() if not (r["image"] or "").strip()]:
                raise ValueError(f"pages without an image path have no overlay: {', '.join(bare[:5])}")
            for row in part.to_pylist():
                key, number, image, listed = (row[c] for c in ("doc_key", "page_number", "image", "boxes"))
                folder = f"{root}/{key}"
                picture = png.decode(read(f"{folder}/{image}"))
                name = f"{OVERLAY_DIR}/{image.rsplit('/', 1)[-1].rsplit('.', 1)[0]}_bbox.png"
                write(f"{folder}/{name}", png.encode(draw(picture, listed)))
                out.append({"doc_key": key, "page_number": number, "bbox_image": name})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_key", pa.string()), ("page_number", pa.int32()), ("bbox_image", pa.string())]))

    fields = ("region_idx", "x0", "y0", "x1", "y1", "color", "line_width", "caption")
    listed = F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct(*fields))))
    grouped = boxes.groupBy("doc_key", "page_number", "image").agg(listed.alias("boxes"))
    return grouped.mapInArrow(pages, "doc_key string, page_number int, bbox_image string")


def crops(pages: DataFrame, regions: DataFrame, root: str, read: Callable[[str], bytes] = read_file) -> DataFrame:
    """doc_key, page_number, id, x0, y0, png: every visual region cut from its page's clean image (an extension).

    A cut covers all pixels that the box touches, and x0, y0 is its corner on the page.  A page's
    image is read once; a region whose page has no row is left out.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                picture = png.decode(read(f"{root}/{row['doc_key']}/{row['image']}"))
                height, width = picture.shape[:2]
                out = []
                for b in row["boxes"]:
                    x0, y0 = min(math.floor(b["x0"]), width - 1), min(math.floor(b["y0"]), height - 1)
                    x1, y1 = max(min(math.ceil(b["x1"]), width), x0 + 1), max(min(math.ceil(b["y1"]), height), y0 + 1)
                    out.append({"doc_key": row["doc_key"], "page_number": row["page_number"], "id": b["id"], "x0": x0, "y0": y0, "png": png.encode(picture[y0:y1, x0:x1])})
                yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_key", pa.string()), ("page_number", pa.int32()), ("id", pa.string()), ("x0", pa.int32()), ("y0", pa.int32()), ("png", pa.binary())]))

    boxes = F.array_sort(F.collect_list(F.struct("region_idx", "id", "x0", "y0", "x1", "y1"))).alias("boxes")
    by_page = flat_regions(regions).groupBy("doc_key", "page_number").agg(boxes)
    images = pages.select("doc_key", "page_number", "image")
    return images.join(by_page, ["doc_key", "page_number"]).mapInArrow(cut, "doc_key string, page_number int, id string, x0 int, y0 int, png binary")
