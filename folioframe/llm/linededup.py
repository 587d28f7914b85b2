"""Line dedup: range-partitioned line hashes, sorted by document and position, streamed.

Every long enough line becomes (128-bit key hash, document, position).  Rows are range-partitioned by
(hash, document) and sorted by hash, document descending, position.  Each partition is streamed: a
hash seen in ``min_docs`` documents or more keeps its lines in the first document of its run, the
largest doc_id, and loses the others.  Since the document is part of the range key, a line that a
third of all documents hold is dealt over many partitions.  A run that touches a partition's end may
go on next door, so each partition passes on its first and last key with their document counts (two
rows a partition, broadcast if they are few), and the rows of those keys are settled by the sums.

What comes back is a compressed keep bitmap for each document that loses lines, not text.

Edge cases: a null or empty text is one empty line.  Very long texts are read whole, and their bitmap
has a bit a line.  A null doc_id ranks as the largest id.  Rows that share a doc_id count as one
document.  Lines of one document that tie in their key stay or go together.  Repeated rows lose the
same lines.  Columns of any other name are not read.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_back, rows_of, small, stored

MIN_CHARS = 20
MIN_DOCS = 3
_SPACE = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line's key, or None if it is too short.  ``line`` is UTF-8 with A-Z already lower-cased."""
    key = line.strip(_SPACE)
    if len(key) < min_chars or len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def _line_rows(rows: DataFrame, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            digests, at, where = [], [], []
            for k, body in enumerate(batch["body"].to_pylist()):
                for pos, line in enumerate(body.lower().split(b"\n")):
                    if len(line) >= min_chars and (key := key_of(line, min_chars)) is not None:
                        digests.append(xxh3_128_digest(key))
                        at.append(pos)
                        where.append(k)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            take = pa.array(where, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])), batch["doc"].take(take), batch["th"].take(take), pa.array(at, pa.int32())],
                names=["h1", "h2", "doc", "th", "pos"],
            )

    return rows.mapInArrow(run, "h1 long, h2 long, doc long, th long, pos int")


#: Kinds of rows that a partition passes on.
_DROP, _OPEN, _COUNT = 0, 1, 2


def _settle(run: list[np.ndarray], is_open: bool, min_docs: int) -> list[np.ndarray]:
    """Decide whole runs of keys: rows (h1, h2, doc, th, pos) sorted as above, one array a column."""
    h1, h2, doc, th, pos = run
    first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
    size = np.diff(np.append(first, len(h1)))
    new_doc = np.concatenate([[1], (doc[1:] != doc[:-1]).astype(np.int64)])
    new_doc[first] = 1
    n_docs = np.add.reduceat(new_doc, first)
    top = np.repeat(doc[first], size)
    if is_open:  # a single key
        rows = [np.full(len(h1), _OPEN), h1, h2, doc, th, pos, np.zeros(len(h1), np.int64)]
        count = [np.array([v]) for v in (_COUNT, h1[0], h2[0], doc[0], 0, 0, n_docs[0])]
        return [np.concatenate([a, b]) for a, b in zip(rows, count, strict=True)]
    lost = (np.repeat(n_docs, size) >= min_docs) & (doc != top)
    zero = np.zeros(int(lost.sum()), np.int64)
    return [zero + _DROP, h1[lost], h2[lost], doc[lost], th[lost], pos[lost], zero]


def _streamed(lines: DataFrame, min_docs: int) -> DataFrame:
    names = ["kind", "h1", "h2", "doc", "th", "pos", "n_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

        held: list[list[np.ndarray]] = []  # rows of the run that may still grow
        seen_one = False  # whether the partition's first key has been passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch[c].to_numpy() for c in ("h1", "h2", "doc", "th", "pos")]
            change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
            same = bool(held) and held[-1][0][-1] == rows[0][0] and held[-1][1][-1] == rows[1][0]
            if len(change) == 0 and (same or not held):
                held.append(rows)
                continue
            cut = int(change[0]) if same and len(change) else 0
            if held:
                whole = [np.concatenate(x) for x in zip(*held, [c[:cut] for c in rows], strict=True)] if cut else [np.concatenate(x) for x in zip(*held, strict=True)]
                yield out(_settle(whole, not seen_one, min_docs))
                seen_one = True
            last = int(change[-1]) if len(change) else 0
            inner = [c[cut:last] for c in rows]
            if len(inner[0]) and not seen_one:
                yield out(_settle([c[: change[0]] for c in rows], True, min_docs))
                seen_one = True
                inner = [c[change[0] : last] for c in rows]
            if len(inner[0]):
                yield out(_settle(inner, False, min_docs))
            held = [[c[last:] for c in rows]]
        if held:
            yield out(_settle([np.concatenate(x) for x in zip(*held, strict=True)], True, min_docs))

    return lines.mapInArrow(run, "kind long, h1 long, h2 long, doc long, th long, pos long, n_docs long")


def keep_bitmaps(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc, th, n_dropped, bitmap for each row that loses lines.

    ``bitmap`` is zlib-compressed, one bit a line from the highest bit on, 1 to keep; lines beyond it stay.
    """
    lines = _line_rows(rows_of(docs), min_chars)
    ranged = lines.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", F.desc("doc"), "pos")
    found = stored(_streamed(ranged, min_docs), "line-runs")
    edges = found.where(F.col("kind") == _COUNT).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n"), F.max("doc").alias("top"))
    # Two keys a partition at most; counted, since partitions grow with the input.
    edges = stored(edges, "line-edges")
    settled = found.where(F.col("kind") == _OPEN).join(small(edges, edges.count()), ["h1", "h2"]).where((F.col("n") >= min_docs) & (F.col("doc") < F.col("top")))
    lost = found.where(F.col("kind") == _DROP).select("doc", "th", "pos").unionAll(settled.select("doc", "th", "pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, counts = [], []
            for positions in batch["at"]:
                at = np.unique(positions.values.to_numpy())
                keep = np.ones((int(at[-1]) + 8) // 8 * 8, np.uint8)
                keep[at] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
                counts.append(len(at))
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["th"], pa.array(counts, pa.int64()), pa.array(maps, pa.binary())], names=["doc", "th", "n_dropped", "bitmap"])

    return lost.groupBy("doc", "th").agg(F.collect_list("pos").alias("at")).mapInArrow(run, "doc long, th long, n_dropped long, bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, with_text: bool = True) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, and the kept ``text``, of every row of ``docs``."""
    rows = rows_of(docs).join(bitmaps, ["doc", "th"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, lost, shas, texts = [], [], [], []
            for body, n, bits in zip(batch["body"].to_pylist(), batch["n_dropped"].to_pylist(), batch["bitmap"].to_pylist(), strict=True):
                n_lines.append(body.count(b"\n") + 1)
                lost.append(n or 0)
                if bits is not None:
                    lines = body.split(b"\n")
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))[: len(lines)].tolist()
                    keep += [1] * (len(lines) - len(keep))
                    kept = [line for line, k in zip(lines, keep, strict=True) if k]
                    body = b"\n".join(kept)
                shas.append(hashlib.sha256(body).hexdigest())
                texts.append(body)
            columns = [batch["doc"], pa.array(n_lines, pa.int64()), pa.array(lost, pa.int64()), pa.array(shas, pa.string())]
            names = ["doc", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                columns.append(pa.array(texts, pa.binary()))
                names.append("body")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc long, n_lines long, n_dropped long, kept_sha256 string" + (", body binary" if with_text else "")
    out = rows.mapInArrow(run, schema)
    text = [F.col("body").cast("string").alias("text")] if with_text else []
    return out.select(id_back(F.col("doc")).alias("doc_id"), "n_lines", "n_dropped", "kept_sha256", *text)
