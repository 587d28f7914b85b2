"""Benchmark decontamination: a broadcast hash set of test n-grams.

Benchmark items become windows of 13 normalised words (an item with fewer words is one window).
Their hashes are broadcast in blocks of at most ``block_windows``; a larger benchmark takes more
blocks, each matched against all documents, never a larger broadcast.  A document is read window by
window; a window whose hash is found is compared word by word before it counts.

Documents: a word inside any occurrence of a window is hit.  ``contaminated`` holds if a word is hit
and hits are at least a twentieth of the words.

Edge cases: null and empty texts have no words and are clean.  Very long texts are read whole, window by
window.  An item without words has no window.  A null item_id is named ``null``; repeated items count
once, and windows that tie between items are hits of each.  Repeated documents get equal results, and
a null doc_id stays null.  Columns of any other name are not read, and ``remove_documents`` passes them on.
An empty table of documents gives none; with an empty benchmark every document is clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gram_hashes, id_back, id_of, rows_of, stored, text_of, word_hashes

#: Fixed value of the contract: a word, as UTF-8.  All bytes from 0x80 on belong to words.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
#: A word is hit enough if 20 * n_hit >= n_words.
SHARE = 20
#: Windows in one broadcast, under 1 kB each in a worker.
BLOCK_WINDOWS = 100_000


def tokens(body: bytes | None) -> list[bytes]:
    return WORD.findall((body or b"").lower())


class Windows:
    """The windows of some items, by width: sorted hashes, and the words behind each."""

    def __init__(self, windows: list[tuple[str, tuple[bytes, ...]]]) -> None:
        self.vocabulary = {w for _, words in windows for w in words}
        self.by_width: dict[int, tuple[np.ndarray, dict]] = {}
        widths: dict[int, dict] = {}
        for item, words in windows:
            widths.setdefault(len(words), {}).setdefault(words, set()).add(item)
        for width, items in widths.items():
            hashes = np.array([gram_hashes(word_hashes(list(w)), width)[0] for w in items], np.uint64)
            self.by_width[width] = np.unique(hashes), items

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items with an occurring window."""
        cover, items = np.zeros(len(words) + 1, np.int64), set()
        hashes = word_hashes(words)
        for width, (known, by_words) in self.by_width.items():
            grams = gram_hashes(hashes, width)
            if not len(grams):
                continue
            at = np.searchsorted(known, grams)
            at[at == len(known)] = 0
            for k in np.flatnonzero(known[at] == grams).tolist():
                if found := by_words.get(tuple(words[k : k + width])):
                    items |= found
                    cover[k] += 1
                    cover[k + width] -= 1
        return np.cumsum(cover[:-1]) > 0, items


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """item string, words array<binary>: one row per window of each item."""
    items = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("null")).alias("item"), text_of(benchmark, text_col).cast("binary").alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, out = [], []
            for item, body in zip(batch["item"].to_pylist(), batch["body"].to_pylist(), strict=True):
                words = tokens(body)
                for k in range(max(len(words) - window, 0) + 1 if words else 0):
                    names.append(item)
                    out.append(words[k : k + window])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.list_(pa.binary()))], names=["item", "words"])

    return items.mapInArrow(cut, "item string, words array<binary>").distinct()


def _blocks(windows: DataFrame, block_windows: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The windows with their block, and all blocks: none has more than ``block_windows`` rows, however many items share a window."""
    n = max(1, -(-windows.count() // block_windows))
    order = Window.partitionBy("bucket").orderBy("words", "item")
    numbered = windows.withColumn("bucket", F.pmod(F.xxhash64("words"), F.lit(n)).cast("int"))
    numbered = stored(numbered.withColumn("part", F.floor((F.row_number().over(order) - 1) / block_windows).cast("int")), "windows")
    return numbered, sorted((r["bucket"], r["part"]) for r in numbered.select("bucket", "part").distinct().collect())


def _collected(windows: DataFrame, block: tuple[int, int]) -> list[tuple[str, tuple[bytes, ...]]]:
    found = windows.where((F.col("bucket") == block[0]) & (F.col("part") == block[1]))
    return [(r["item"], tuple(map(bytes, r["words"]))) for r in found.collect()]


_built: dict = {}


def _windows_of(held) -> Windows:
    """Built once in each Python worker for a broadcast."""
    if held.value is not _built.get("from"):
        _built.update({"from": held.value, "windows": Windows(held.value)})
    return _built["windows"]


def _hits_of_blocks(rows: DataFrame, windows: DataFrame, blocks: list[tuple[int, int]]) -> DataFrame:
    """doc, th, starts, stops, items of rows with a hit, from one pass over the rows for each block."""
    found = None
    for block in blocks:
        held = rows.sparkSession.sparkContext.broadcast(_collected(windows, block))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known = _windows_of(held)
            for batch in batches:
                out = []
                for doc, th, body in zip(*(batch[c].to_pylist() for c in ("doc", "th", "body")), strict=True):
                    hit, items = known.find(tokens(body))
                    if items:
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                        out.append((doc, th, edges[::2].tolist(), edges[1::2].tolist(), sorted(items)))
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=["doc", "th", "starts", "stops", "items"])

        part = stored(rows.select("doc", "th", "body").mapInArrow(run, "doc long, th long, starts array<long>, stops array<long>, items array<string>").distinct(), "hits")
        held.destroy()
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc", "th").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items")])


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    share: int = SHARE,
    block_windows: int = BLOCK_WINDOWS,
    carry: bool = False,
    clean_text: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted), contaminated; with ``carry`` also ``row``, the whole row.

    ``clean_text`` adds ``text`` without the runs of hit words.  If the windows fit one block, this
    is a single pass over the documents without a shuffle.  Otherwise each block's hits are stored,
    gathered by document and joined to it.
    """
    windows, blocks = _blocks(stored(item_windows(benchmark, window=window), "windows"), block_windows)
    rows = rows_of(docs)
    if carry:
        rows = docs.select(
            id_of(docs).alias("doc"),
            text_of(docs).cast("binary").alias("body"),
            F.xxhash64(text_of(docs)).alias("th"),
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        )
    if len(blocks) < 2:
        held = docs.sparkSession.sparkContext.broadcast(_collected(windows, blocks[0]) if blocks else [])
    else:
        held = None
        rows = rows.join(_hits_of_blocks(rows, windows, blocks), ["doc", "th"], "left")
    more = ("row",) if carry else ()
    kind = f", row {rows.schema['row'].dataType.simpleString()}" if carry else ""
    schema = "doc_id long, n_words long, n_hit long, n_items long, items array<string>, contaminated boolean" + (", text string" if clean_text else "") + kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            given = zip(*(batch[c].to_pylist() for c in ("starts", "stops", "items")), strict=True) if held is None else None
            for body in batch["body"].to_pylist():
                words = tokens(body)
                if held is not None:
                    hit, items = _windows_of(held).find(words)
                else:
                    starts, stops, names = next(given)
                    hit, items = np.zeros(len(words), bool), set(names or ())
                    for x, y in zip(starts or (), stops or (), strict=True):
                        hit[x:y] = True
                n = int(hit.sum())
                row = (len(words), n, len(items), sorted(items), n > 0 and share * n >= len(words))
                out.append(row + ((_cut(body, hit),) if clean_text else ()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_()] + [pa.string()] * clean_text
            names = ["n_words", "n_hit", "n_items", "items", "contaminated"] + ["text"] * clean_text
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc"], *columns, *(batch[c] for c in more)], names=["doc_id", *names, *more])

    return rows.mapInArrow(run, schema).withColumn("doc_id", id_back(F.col("doc_id")))


def _cut(body: bytes | None, hit: np.ndarray) -> str:
    """The text without runs of hit words."""
    body = body or b""
    out, last, spans = [], 0, [m.span() for m in WORD.finditer(body.lower())]
    k = 0
    while k < len(spans):
        if hit[k]:
            first = k
            while k + 1 < len(spans) and hit[k + 1]:
                k += 1
            out.append(body[last : spans[first][0]])
            last = spans[k][1]
        k += 1
    return b"".join([*out, body[last:]]).decode("utf-8", "replace")


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    return scan(docs, benchmark, carry=True, **options).where(~F.col("contaminated")).select("row.*")
