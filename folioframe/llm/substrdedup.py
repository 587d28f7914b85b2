"""Substring dedup by super-k-mers: windows of 50 words that also start in a smaller doc_id go.

A window's minimiser is the smallest hash among its runs of 10 words.  Consecutive windows that share
a minimiser form a super-k-mer.  Equal windows have equal minimisers, so only super-k-mers with the
same minimiser need to meet:

1.  Each document gives one small reference for each super-k-mer: its minimiser, a hash of its words
    and its place.  References whose minimiser lies in one document only can repeat nothing.
2.  Equal super-k-mers need no text: all but the one in the smallest document are removed whole, by
    sums before the shuffle.  So copies of a document or passage meet as one string, however many.
3.  The different strings of a minimiser travel to its bucket, each as one packed string of its
    words, from the smallest document that holds it.  A bucket's windows are sorted, and a window is
    removable in every document but the smallest.
4.  A minimiser whose strings hold more than ``bucket_words`` words would be a bucket too large for a
    task.  Its strings are dealt over as many parts as it needs.  A part removes its windows as a
    bucket does, and passes on only those of the smallest document it holds each in, as rows: they
    meet those of the other parts by sums before the shuffle and a join that Spark can split.

Words are compared by 64-bit hashes, windows by two independent 64-bit hashes of these, super-k-mers
by their minimiser and one such hash.

Edge cases: a null or empty text has no words.  Texts of fewer than 50 words have no window.  Very
long texts are read whole; a worker holds one text's words, or the strings of one part of a bucket.
A null doc_id ranks last.  Rows that share a doc_id count as one document, so they never remove from
each other.  Repeated rows lose the same words, and travel once.  Ties of minimisers need no rule, since
equal windows have equal ones.  Columns of any other name are not read.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, gram_hashes, id_back, rows_of, signed, small, stored, word_hashes

WINDOW = 50
#: Words in a run whose hash may be the minimiser.
RUN = 10
#: Words that one bucket may hold; beyond it, words that one part of it may hold.
BUCKET_WORDS = 20_000
#: Bytes of packed strings that a Python worker expands at once, beside the last bucket among them.
CHUNK = 1 << 22
_SEEDS = (0x51ED270B27B4F3CF, 0xD6E8FEB86659FD93)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == width else np.minimum(x[: len(x) - (width - span)], x[width - span :])


def super_kmers(hashes: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer."""
    if len(hashes) < window:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    least = sliding_min(gram_hashes(hashes, run), window - run + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], first, np.diff(np.append(first, len(least)))


def _references(rows: DataFrame, window: int, run_words: int) -> DataFrame:
    """mini, sh, doc, th, first, n: each super-k-mer, with a hash of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            minis, hashes, firsts, counts, take = [], [], [], [], []
            for k, body in enumerate(batch["body"].to_pylist()):
                words = word_hashes(body.split())
                mini, first, count = super_kmers(words, window, run_words)
                raw = memoryview(words).cast("B")
                minis.append(mini)
                hashes += [xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(first.tolist(), (first + count + window - 1).tolist(), strict=True)]
                firsts.append(first)
                counts.append(count)
                take.append(np.full(len(mini), k))
            at = pa.array(np.concatenate(take) if take else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([*minis, np.empty(0, np.uint64)]))),
                    pa.array(signed(np.array(hashes, np.uint64))),
                    batch["doc"].take(at),
                    batch["th"].take(at),
                    pa.array(np.concatenate([*firsts, np.empty(0, np.int64)]).astype(np.int32)),
                    pa.array(np.concatenate([*counts, np.empty(0, np.int64)]).astype(np.int32)),
                ],
                names=["mini", "sh", "doc", "th", "first", "n"],
            )

    return rows.mapInArrow(run, "mini long, sh long, doc long, th long, first int, n int")


def _packed(rows: DataFrame, strings: DataFrame, window: int) -> DataFrame:
    """mini, part, doc, th, first, words: each of ``strings`` with its words, joined by spaces.

    Texts meet their strings in order of (doc, th), so copies of a row are told from the row before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            take, minis, splits, firsts, packed = [], [], [], [], []
            keys = zip(batch["doc"].to_pylist(), batch["th"].to_pylist(), strict=True)
            for k, (key, body, parts) in enumerate(zip(keys, batch["body"], batch["parts"], strict=True)):
                if key == last:
                    continue
                last = key
                words = body.as_py().split()
                fields = [parts.values.field(c).to_numpy() for c in ("mini", "part", "first", "n")]
                for mini, part, first, n in zip(*(f.tolist() for f in fields), strict=True):
                    take.append(k)
                    minis.append(mini)
                    splits.append(part)
                    firsts.append(first)
                    packed.append(b" ".join(words[first : first + n + window - 1]))
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(minis, pa.int64()), pa.array(splits, pa.int32()), batch["doc"].take(at), batch["th"].take(at), pa.array(firsts, pa.int32()), pa.array(packed, pa.binary())],
                names=["mini", "part", "doc", "th", "first", "words"],
            )

    by_row = strings.groupBy("doc", "th").agg(F.collect_list(F.struct("mini", "part", "first", "n")).alias("parts"))
    both = rows.join(by_row.hint("merge"), ["doc", "th"]).select("doc", "th", "body", "parts")
    return both.mapInArrow(run, "mini long, part int, doc long, th long, first int, words binary")


def _window_hashes(packed: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of every window of the strings, its string and its offset there."""
    split = [p.split() for p in packed]
    size = np.array([len(s) for s in split], np.int64)
    flat = word_hashes([w for s in split for w in s])
    owner = np.repeat(np.arange(len(split)), size)
    offset = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    inside = np.flatnonzero(offset + window <= np.repeat(size, size))
    # A window that starts inside a string and ends there lies in the flat array as a whole.
    w1, w2 = (gram_hashes(flat, window, seed) for seed in _SEEDS)
    return w1[inside], w2[inside], owner[inside], offset[inside]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of whole buckets and parts, of about CHUNK bytes."""
    mini, part = batch["mini"].to_numpy(), batch["part"].to_numpy()
    size = np.cumsum(pc.binary_length(batch["words"]).to_numpy().astype(np.int64))
    ends = np.append(np.flatnonzero((mini[1:] != mini[:-1]) | (part[1:] != part[:-1])) + 1, batch.num_rows)
    at = 0
    while at < batch.num_rows:
        full = np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK, side="right")
        end = int(ends[np.searchsorted(ends, min(max(int(full), at + 1), batch.num_rows))])
        yield batch.slice(at, end - at)
        at = end


def _bucket_spans(packed: DataFrame, window: int) -> DataFrame:
    """doc, th, begin, end: word spans to remove, from buckets that are streamed in minimiser order.

    From a part of a heavy bucket also the windows of the smallest document that it holds each in,
    with their hashes w1 and w2, which are else null.
    """

    def spans(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w1, w2, owner, offset = _window_hashes(batch["words"].to_pylist(), window)
        doc, first = batch["doc"].to_numpy(), batch["first"].to_numpy()

        def rows(string: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: list[pa.Array]) -> pa.RecordBatch:
            take = pa.array(string)
            places = [pa.array((first[string] + x).astype(np.int32)) for x in (begin, end)]
            return pa.RecordBatch.from_arrays([batch["doc"].take(take), batch["th"].take(take), *places, *hashes], names=["doc", "th", "begin", "end", "w1", "w2"])

        # Of several buckets at once, equal windows are of one bucket: they have one minimiser.
        part = batch["part"].to_numpy()[owner]
        order = np.lexsort((doc[owner], part, w2, w1))
        a, b, c, d = w1[order], w2[order], part[order], doc[owner][order]
        head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])) if len(a) else np.empty(0, np.int64)
        least = np.repeat(d[head], np.diff(np.append(head, len(a))))
        gone = np.sort(order[d > least])
        string, at = owner[gone], offset[gone]
        cut = np.flatnonzero(np.concatenate([[True], (string[1:] != string[:-1]) | (at[1:] != at[:-1] + 1)])) if len(gone) else gone
        last = np.append(cut[1:], len(gone))[: len(cut)] - 1
        yield rows(string[cut], at[cut], at[last] + window, [pa.nulls(len(cut), pa.int64())] * 2)
        held = order[(d == least) & (c >= 0)]
        yield rows(owner[held], offset[held], offset[held] + window, [pa.array(signed(w[held])) for w in (w1, w2)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last bucket or part, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            mini, part = batch["mini"].to_numpy(), batch["part"].to_numpy()
            change = np.flatnonzero((mini[1:] != mini[:-1]) | (part[1:] != part[:-1])) + 1
            last = int(change[-1]) if len(change) else 0
            if held and not last and (held[-1]["mini"][-1].as_py(), held[-1]["part"][-1].as_py()) == (mini[0], part[0]):
                held.append(batch)
                continue
            whole = pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()
            held = [batch.slice(last)]
            for piece in _pieces(whole[0]) if whole else ():
                yield from spans(piece)
        if held:
            yield from spans(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    ordered = packed.repartition("mini", "part").sortWithinPartitions("mini", "part")
    return ordered.mapInArrow(run, "doc long, th long, begin int, end int, w1 long, w2 long")


def repeated_spans(docs: DataFrame, *, window: int = WINDOW, run: int = RUN, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """doc, th, spans (array of begin, end in words) of every row that loses words; spans may overlap."""
    spark, rows = docs.sparkSession, rows_of(docs)
    references = stored(_references(rows, window, run), "references")
    # Tables that a join reads are stored before it: then both its sides are plain exchanges.
    shared = references.groupBy("mini").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    shared = stored(shared.select("mini"), "shared")
    live = stored(references.join(small(shared, shared.count()), "mini"), "live")
    drop_path(spark, references._scratch)

    # The smallest holder of each different string.
    holder = F.min(F.struct("doc", "th", "first")).alias("holder")
    strings = stored(live.groupBy("mini", "sh", "n").agg(holder, F.count(F.lit(1)).alias("refs")).select("mini", "sh", "n", "holder.*", "refs"), "strings")
    least = strings.where("refs > 1").select("mini", "sh", "n", F.col("doc").alias("least"))
    copies = live.join(least, ["mini", "sh", "n"]).where("doc > least").select("doc", "th", F.col("first").alias("begin"), (F.col("first") + F.col("n") + window - 1).alias("end"))

    # The buckets of minimisers whose different strings lie in different documents.
    held_words = F.sum(F.col("n") + F.lit(window - 1).cast("long")).alias("words")
    buckets = strings.groupBy("mini").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), held_words).where("lo < hi")
    buckets = stored(buckets.select("mini", "words"), "buckets")
    parts = F.ceil(F.col("words") / F.lit(bucket_words)).cast("long")
    part = F.when(F.col("words") > bucket_words, F.pmod("sh", parts)).otherwise(F.lit(-1)).cast("int")
    compared = strings.join(small(buckets, buckets.count()), "mini").withColumn("part", part)
    found = stored(_bucket_spans(_packed(rows, compared, window), window), "found")
    windows = found.where("w1 IS NOT NULL")
    first = stored(windows.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most"), "first")
    many = windows.join(small(first, first.count()), ["w1", "w2"]).where("doc > least").select("doc", "th", "begin", "end")

    light = found.where("w1 IS NULL").select("doc", "th", "begin", "end")
    return copies.unionAll(light).unionAll(many).groupBy("doc", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def remove_spans(docs: DataFrame, spans: DataFrame, *, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and the kept words as ``text``, of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, shas, texts = [], [], [], []
            for body, found in zip(batch["body"].to_pylist(), batch["spans"], strict=True):
                words = body.split()
                n_words.append(len(words))
                lost = 0
                if found.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, found.values.field("begin").to_numpy(), 1)
                    np.add.at(edge, found.values.field("end").to_numpy(), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    lost = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(lost)
                texts.append(b" ".join(words))
                shas.append(hashlib.sha256(texts[-1]).hexdigest())
            columns = [batch["doc"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())]
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(texts, pa.binary()))
                names.append("body")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc long, n_words long, n_removed long, kept_sha256 string" + (", body binary" if with_text else "")
    out = rows_of(docs).join(spans, ["doc", "th"], "left").select("doc", "body", "spans").mapInArrow(run, schema)
    text = [F.col("body").cast("string").alias("text")] if with_text else []
    return out.select(id_back(F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", *text)
