"""Token ids in bit-packed shard files.

A document's ids, with the end id appended, are stored in ``bits`` bits each, the fewest that hold
the vocabulary.  Documents are written in ascending doc_id order; a shard holds whole documents.

File format (integers little-endian)::

    magic    8 bytes  b"FFTOKS1\\n"
    header   6 int64  bits, partition, shard in partition, documents, ids, ids before it in its partition
    docs     int64[documents]      doc_id
    ends     int64[documents]      ids up to the end of each document, from the shard's start
    payload  8 * ceil(ids * bits / 64) bytes: id k lies in bits [k * bits, (k + 1) * bits)

followed by one newline.  The shards of partition p come before those of partition p + 1.  Ids are in
blocks of ``BLOCK`` = 64 ids, each of exactly ``bits`` 64-bit words, so block b starts at word
b * bits: any run of ids is read with numpy from the blocks that hold it.

The shards are written by Spark's own file writer (one file for each row), which commits whole tasks
and reaches any file system Spark knows, and read with the ``binaryFile`` source.

Edge cases: a null or empty text has the end id alone.  A very long text is encoded whole, and may make a
shard of its own.  A null doc_id ranks last and is stored as the largest long.  Rows that tie in doc_id
are each written, in order of their text's hash; repeated rows likewise.  Columns of any other name are
not read.  An empty table gives no shards.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_back, id_of, scratch_path, small, stored, text_of

MAGIC = b"FFTOKS1\n"
BLOCK = 64
END_ID = 0
#: Ids in a shard, unless one document has more.
SHARD_IDS = 1 << 22

#: Splits a text as the vocabulary's byte-level pre-tokenizer does, for the characters in EASY.
PIECES = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters on which Python's classes and the library's might differ: such a text is given whole to the library.
HARD = re.compile("[\x1c-\x1f\x85\xb2\xb3\xb9\xbc\xbd\xbe]|[^\x00-ɏ]")

_AS_BYTES = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _is_hard(text: str) -> bool:
    """As HARD.search, faster for texts in ASCII and Latin-1."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return HARD.search(text) is not None
        if any(c in text for c in "\x85\xb2\xb3\xb9\xbc\xbd\xbe"):
            return True
    return any(c in text for c in "\x1c\x1d\x1e\x1f")


def _uncached(path: str):
    """The file's model without the library's own memory of words, which costs more than it saves behind ours; None unless it is a plain BPE."""
    from tokenizers.models import BPE

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("type") != "BPE" or any(v for k, v in model.items() if k not in ("type", "vocab", "merges")):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)


class Encoder:
    """The tokenizer file's ids as little-endian uint32 bytes, with the pieces' ids remembered.

    The library's model encodes each new piece; a text with hard characters or a special token's
    string goes through the library's whole chain.
    """

    #: Pieces in each of the two generations that a Python worker remembers, about 250 bytes each.
    LIMIT = 250_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = _uncached(path) or self.whole.model
        self.vocab_size = self.whole.get_vocab_size(with_added_tokens=True)
        special = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        before = self.whole.pre_tokenizer
        self.plain = type(before).__name__ == "ByteLevel" and before.use_regex and not before.add_prefix_space and self.whole.normalizer is None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.table = dict(zip(shown, map(chr, shown), strict=True))
        hidden = (b for b in range(256) if b not in self.table)
        self.table |= {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if len(self.pieces) >= self.LIMIT:
            self.older, self.pieces = self.pieces, {}
        if (known := self.older.get(piece)) is not None:
            self.pieces[piece] = known
            return known
        if piece.isascii() and piece.isprintable() and " " not in piece[1:]:
            shown = "\u0120" + piece[1:] if piece[0] == " " else piece  # as the table has it
        else:
            shown = piece.encode().decode("latin-1").translate(self.table)
        ids = [t.id for t in self.model.tokenize(shown)]
        out = self.pieces[piece] = _AS_BYTES[len(ids)](*ids) if len(ids) < len(_AS_BYTES) else struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> bytes:
        if not self.plain or self.special and self.special.search(text) or _is_hard(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # A text may start a new generation: the dictionary at hand is still right for all of it.
        get, piece = self.pieces.get, self._piece
        return b"".join([get(p) or piece(p) for p in PIECES.findall(text)])


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing; every id must be below 2 ** bits."""
    n_words = -(-len(ids) * bits // 64)
    out = np.zeros(-(-len(ids) // BLOCK) * bits + 1, np.uint64)
    at = np.arange(BLOCK) * bits
    padded = np.zeros(-(-len(ids) // BLOCK) * BLOCK, np.uint64)
    padded[: len(ids)] = ids
    lanes, words = padded.reshape(-1, BLOCK), out[:-1].reshape(-1, bits)
    for lane in range(BLOCK):
        word, shift = int(at[lane]) >> 6, int(at[lane]) & 63
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return out[:n_words].astype("<u8").tobytes()


def unpack(payload: bytes | memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop as uint32, from the words of their blocks alone."""
    first = start // BLOCK
    n_blocks = -(-stop // BLOCK) - first
    words = np.zeros(n_blocks * bits, np.uint64)
    held = np.frombuffer(payload, "<u8")[first * bits : (first + n_blocks) * bits]
    words[: len(held)] = held
    words = words.reshape(-1, bits)
    out = np.empty((n_blocks, BLOCK), np.uint64)
    for lane in range(BLOCK):
        word, shift = lane * bits >> 6, lane * bits & 63
        out[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            out[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    out &= np.uint64((1 << bits) - 1)
    return out.reshape(-1)[start - first * BLOCK : stop - first * BLOCK].astype(np.uint32)


class Shard:
    """A shard file in memory."""

    def __init__(self, content: bytes | memoryview) -> None:
        content = memoryview(content)
        if bytes(content[:8]) != MAGIC:
            raise ValueError("not a token shard")
        self.bits, self.partition, self.number, n_docs, self.n_ids, self.before = np.frombuffer(content[8:56], "<i8").tolist()
        self.docs = np.frombuffer(content[56 : 56 + 8 * n_docs], "<i8")
        self.ends = np.frombuffer(content[56 + 8 * n_docs : 56 + 16 * n_docs], "<i8")
        n_words = -(-self.n_ids * self.bits // 64)
        self.payload = content[56 + 16 * n_docs : 56 + 16 * n_docs + 8 * n_words]
        if len(self.payload) != 8 * n_words:
            raise ValueError("a token shard is cut short")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        return unpack(self.payload, self.bits, start, self.n_ids if stop is None else stop)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def _shard(partition: int, number: int, before: int, docs: list[int], parts: list[bytes], bits: int) -> bytes:
    ids = np.frombuffer(b"".join(parts), "<u4")
    ends = np.cumsum([len(p) // 4 for p in parts])
    header = np.array([bits, partition, number, len(docs), len(ids), before], "<i8").tobytes()
    return MAGIC + header + np.array(docs, "<i8").tobytes() + ends.astype("<i8").tobytes() + pack(ids, bits)


def write(docs: DataFrame, tokenizer: str, path: str, *, end_id: int = END_ID, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document and write the shards to the folder ``path``."""
    rows = docs.select(id_of(docs, id_col).alias("doc"), text_of(docs, text_col).alias("body"))
    # By id, then text, so that reruns write equal files even where ids repeat.
    rows = rows.repartitionByRange("doc").sortWithinPartitions("doc", F.xxhash64("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer)
        bits = max(1, (max(encoder.vocab_size - 1, end_id)).bit_length())
        end = np.array([end_id], "<u4").tobytes()
        ids, parts, n, number, before = [], [], 0, 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_shard(partition, number, before, ids, parts, bits)], pa.binary())], names=["shard"])

        for batch in batches:
            for doc, body in zip(batch["doc"].to_pylist(), batch["body"].to_pylist(), strict=True):
                part = encoder.encode(body) + end
                if parts and n + len(part) // 4 > shard_ids:
                    yield out()
                    ids, parts, n, number, before = [], [], 0, number + 1, before + n
                ids.append(doc)
                parts.append(part)
                n += len(part) // 4
        if parts:
            yield out()

    shards = rows.mapInArrow(run, "shard binary")
    # The text writer copies a string's bytes as they are; one row a file, and a newline at its end.
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the shard files alone.

    ``start`` counts the ids of all documents before it.  Each shard knows the ids before it in its
    partition; what is summed over partitions is one row for each partition.
    """
    files = shard_files(spark, path)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = [Shard(x.as_buffer()) for x in batch["content"]]
            yield pa.RecordBatch.from_arrays([pa.array([s.partition for s in shards], pa.int64()), pa.array([s.n_ids for s in shards], pa.int64())], names=["partition", "n"])

    totals = stored(files.select("content").mapInArrow(heads, "partition long, n long").groupBy("partition").agg(F.sum("n").alias("n")), "token-totals")
    order = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("partition", F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long").alias("offset"))
    kind = pa.list_(pa.int32())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                shard = Shard(content.as_buffer())
                ids = shard.ids().astype("<u4")
                begins = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
                raw, spans = memoryview(ids.tobytes()), list(zip(begins.tolist(), shard.ends.tolist(), strict=True))
                columns = [
                    pa.array(np.full(len(spans), shard.partition)),
                    pa.array(shard.docs),
                    pa.array(begins + shard.before),
                    pa.array(shard.ends - begins),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                ]
                names = ["partition", "doc_id", "begin", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in spans], kind))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "partition long, doc_id long, begin long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = files.select("content").mapInArrow(rows, schema)
    offsets = small(offsets, totals.count())
    return found.join(offsets, "partition").select(
        id_back(F.col("doc_id")).alias("doc_id"), (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )


def tokenize(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the shards (to a scratch folder if no path is given) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write(docs, tokenizer, path, **options)
    return read(spark, path)
