"""N-gram Jaccard join: size-aware, heavy-light, exact.

Sets of 5-word shingles link if their Jaccard similarity is at least ``percent`` / 100.

1.  Equal sets form a class and are represented by their smallest doc_id.
2.  Small sets enumerate subsets.  Sets of n and m shingles link if they share at least
    c(n, m) = ceil(percent * (n + m) / (100 + percent)) of them, so two small sets that link emit an
    equal subset of that fixed size.  How small is small is chosen by cost, see ``boundary``.
3.  Pairs with a large set are found in inverted lists.  Shingles are ordered by rising frequency (a
    sketch of fixed size, of counts over all documents) and then by hash; a set is listed under
    its first n - ceil(percent * n / 100) + 1 shingles, and a pair is looked at where list positions and
    sizes still allow enough overlap.
    A subset list of sizes n <= m pairs each entry with its first one of the smaller size: sets of n
    and m shingles that share c(n, m) link, and so do two of n, but two of m need not.
4.  Lists are scanned twice, so that groups of near copies never make all pairs.  The first scan
    pairs each entry with the one before it and the first of its list, compares each document's few
    most frequent pairs and all those of subset lists exactly, and forms components.  The second
    compares every remaining pair of a list whose ends lie in different components.  Both leave out
    pairs whose parity maps (1024 bits a set) rule a link out.  A pair that is skipped has both ends in one
    component already or can't link, so the components are those of all links.
5.  The second scan joins a list's index entries with its probes.  In a pair that links, the smaller
    set holds the first common shingle so early that c(n, n) more can follow: those are its index
    entries, a seventh of the set.  Pages that share a template, but too little of it to link, have
    it behind their own words, and so no index entry in its lists.  Sizes meet by class, and entries
    of a list's largest component meet only those of others.

Hot lists: the sketch tells an upper bound of a list's length.  A list that may exceed ``hot`` entries
is dealt over as many tasks as it needs.  The entry before is then that of the same part, the first
entry that of the whole list, from an aggregation with sums before the shuffle.

Edge cases: a null or empty text has an empty set, linked with nothing.  A text of fewer than five
words is one shingle of its own kind.  Very long texts are read whole; a worker holds one batch of
texts and one text's set.  A null doc_id ranks last: it is the component's id only where no other is.
In ``join`` rows that share a doc_id count as one document, linked to what any of them links to; in
``keep_first`` they are rows of their own.  Repeated rows get equal results and are compared once.
Ties of frequency are broken by hash, equal sets by the smaller doc_id.  Columns of any other name
are not read, and ``keep_first`` passes them on.  An empty table gives none.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, WORD_PATTERN, drop_path, gram_hashes, id_back, id_of, mixed, rows_of, signed, small, stored, text_of, word_hashes
from .components import components

SHINGLE = 5
PERCENT = 75
#: Counters of the frequency sketch, and the rows it travels in.
COUNTERS = 1 << 20
SLICES = 16
#: Bits of a set's parity map.
PARITY = 1024


def shingles(body: bytes, width: int = SHINGLE) -> np.ndarray:
    """The set as sorted 64-bit hashes."""
    words = body.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < width:
        return gram_hashes(hashes, len(words)) ^ np.uint64(0x632BE59BD9B4E019 * len(words) & (2**64 - 1))
    return np.unique(gram_hashes(hashes, width))


def overlap_needed(n: int, m: int, percent: int = PERCENT) -> int:
    """The least overlap of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def boundary(percent: int = PERCENT, list_cost: float = 6.0) -> int:
    """The largest size whose subsets cost no more rows than its lists.

    A small set of n shingles emits C(n, c(n, m)) subsets for each small size m it can link to.  A
    list entry is one row, and costs ``list_cost`` rows in all, with the comparisons it leads to.
    """
    best = 0
    for n in range(1, 25):
        sizes = [m for m in range(1, n + 1) if 100 * m >= percent * n]
        subsets = sum(math.comb(n, overlap_needed(n, m, percent)) for m in sizes) + sum(
            math.comb(n, c) for m in range(n + 1, 2 * n + 1) if 100 * n >= percent * m and (c := overlap_needed(n, m, percent)) <= n
        )
        if subsets > list_cost * (n - -(-percent * n // 100) + 1):
            break
        best = n
    return best


def parity(s: np.ndarray) -> np.ndarray:
    """One bit for each of PARITY buckets: whether the set has an odd number of shingles there.

    Two maps differ in at most as many bits as the sets differ in shingles.
    """
    odd = np.bincount((s >> np.uint64(44)).astype(np.int64) & (PARITY - 1), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(rows: DataFrame, width: int) -> DataFrame:
    """kind 0: doc, n, sig, bits of each row.  kind 1: a slice of the partition's shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        counts = np.zeros(COUNTERS, np.uint32)
        any_row = False
        for batch in batches:
            sets = [shingles(b, width) for b in batch["body"].to_pylist()]
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            counts += np.bincount((flat & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
            any_row = any_row or len(flat) > 0
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(k, np.int32)),
                    batch["doc"],
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["kind", "doc", "n", "sig", "bits"],
            )
        if any_row:
            parts = counts.reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(SLICES, np.int32)), pa.array(np.arange(SLICES)), pa.array(np.zeros(SLICES, np.int64)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary()), pa.nulls(SLICES, pa.list_(pa.int64()))],
                names=["kind", "doc", "n", "sig", "bits"],
            )

    return rows.mapInArrow(run, "kind int, doc long, n long, sig binary, bits array<long>")


def _classes_of_frequency(counted: DataFrame) -> np.ndarray:
    """One byte for each counter, rising with its count; COUNTERS bytes whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch["doc"].to_pylist(), batch["sig"].to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64)
                sums[k] = sums[k] + part if k in sums else part
        for k, total in sums.items():
            level = np.clip(np.rint(6 * np.log2(total.astype(np.float64) + 1)), 0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([level.tobytes()], pa.binary())], names=["k", "level"])

    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint8)
    for row in counted.repartition(SLICES, "doc").mapInArrow(add, "k long, level binary").collect():
        out[row["k"]] = np.frombuffer(row["level"], np.uint8)
    return out.reshape(-1)


#: Added to a set's size in its subset entries: below 0, and the smaller set ranks first.
_BOTH_SMALL = -(1 << 20)
#: Pairs of each document that the first scan compares, subset pairs aside; the second looks at all that are still apart.
FIRST_PAIRS = 5
#: Shingles by which the second scan knows pairs that it has met before in their lists.
EARLY = 8
#: Entries of a list that one task may take.
HOT = 10_000


def _entries(rows: DataFrame, levels, width: int, percent: int, limit: int, hot: int) -> DataFrame:
    """tok, part, doc, n, pos: the list entries of each set, and the subsets of small ones (n + _BOTH_SMALL).

    ``part`` is -1, or the part of a hot list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        # Parts of a list by the level of its rarest shingle: a list is no longer than that shingle is frequent.
        parts = np.ceil(np.exp2((np.arange(256) + 0.5) / 6) / hot).astype(np.int64)
        for batch in batches:
            toks, sizes, at, take, split = [], [], [], [], []
            for k, body in enumerate(batch["body"].to_pylist()):
                s = shingles(body, width)
                n = len(s)
                if not n:
                    continue
                prefix = n - -(-percent * n // 100) + 1
                rank = level[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                order = np.argsort(rank, kind="stable")  # the set is sorted by hash
                s, rank = s[order], rank[order]
                toks.append(s[:prefix])
                split.append(parts[rank[:prefix]])
                sizes.append(np.full(prefix, n))
                at.append(np.arange(prefix))
                take.append(np.full(prefix, k))
                if n <= limit:
                    keys = []
                    for m in range(1, limit + 1):
                        c = overlap_needed(n, m, percent)
                        if 100 * min(n, m) >= percent * max(n, m) and c <= min(n, m):
                            salt = np.uint64((min(n, m) * 1000 + max(n, m)) * 0x9E3779B97F4A7C15 & (2**64 - 1))
                            by_hash = np.argsort(s)
                            picks = by_hash[np.array(list(combinations(range(n), c)))]
                            h = np.full(len(picks), salt)
                            for j in range(c):
                                h = mixed(h ^ s[picks[:, j]])
                            keys.append(h)
                            split.append(parts[rank[picks].min(axis=1)])
                    if keys:
                        keys = np.concatenate(keys)
                        toks.append(keys)
                        sizes.append(np.full(len(keys), n + _BOTH_SMALL))
                        at.append(np.zeros(len(keys), np.int64))
                        take.append(np.full(len(keys), k))
            if toks:
                at_row, split = np.concatenate(take), np.concatenate(split)
                dealt = mixed(batch["doc"].to_numpy().view(np.uint64))[at_row] % split.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(toks))),
                        pa.array(np.where(split > 1, dealt.astype(np.int64), -1).astype(np.int32)),
                        batch["doc"].take(pa.array(at_row)),
                        pa.array(np.concatenate(sizes).astype(np.int32)),
                        pa.array(np.concatenate(at).astype(np.int32)),
                    ],
                    names=["tok", "part", "doc", "n", "pos"],
                )

    return rows.mapInArrow(run, _ENTRY)


_ENTRY = "tok long, part int, doc long, n int, pos int"


def _listed(entries: DataFrame) -> DataFrame:
    """The entries of hot lists and of those with two entries or more.  Sorted partitions are streamed; no list is held."""
    names = ["tok", "part", "doc", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last entry, which the next batch decides
        met = False  # whether its list had an entry before it
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            tok, part = batch["tok"].to_numpy(), batch["part"].to_numpy()
            like_next = tok[1:] == tok[:-1]
            like_last = np.concatenate([[met], like_next]) | (part >= 0)
            keep = np.flatnonzero(like_last[:-1] | like_next)
            yield batch.take(pa.array(keep))
            held, met = batch.slice(len(tok) - 1), bool(like_last[-1])
        if held is not None and met:
            yield held

    # Parts of one list may mix in a partition: one long alone is sorted by radix.
    return entries.repartition("tok", "part").sortWithinPartitions("tok").select(*names).mapInArrow(run, _ENTRY)


def _may_link(x: str, y: str, percent: int, limit: int) -> Column:
    """Whether two entries of a list may be the first common shingle of linked sets, not both small."""
    return F.expr(
        f"({x}.n >= 0 AND greatest({x}.n, {y}.n) > {limit} AND 100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
        f" AND (100 + {percent}) * least({x}.n - {x}.pos, {y}.n - {y}.pos) >= {percent} * ({x}.n + {y}.n))"
    )


def _pairs(found: DataFrame, a: str, b: str) -> DataFrame:
    return found.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")


def _first_pairs(lists: DataFrame, percent: int, limit: int) -> DataFrame:
    """Each entry with the first of its list and the one before it: twice the entries, not their square."""
    order = Window.partitionBy("tok", "part").orderBy("n", "doc")
    me = F.struct("n", "doc", "pos")
    seen = lists.select("tok", "part", me.alias("x"), F.lag(me).over(order).alias("y"), F.first(me).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("z"))
    with_last = seen.where(_may_link("x", "y", percent, limit))
    # A hot list's first entry is the least of all its parts; stored, the join can split what is skewed.
    hot = lists.where("part >= 0").select("tok", me.alias("x"))
    least = stored(hot.groupBy("tok").agg(F.min("x").alias("z")), "firsts")
    first = seen.where("part < 0").select("x", "z").unionAll(hot.join(small(least, least.count()), "tok").select("x", "z"))
    with_first = first.where("x.doc <> z.doc").where(_may_link("x", "z", percent, limit) | F.expr("x.n < 0 AND z.n < 0"))
    named = lambda found, other: found.select(F.col("x.doc").alias("me"), F.col(f"{other}.doc").alias("other"), F.expr("x.n < 0").alias("subset")).where("me <> other")
    met = named(with_last, "y").unionAll(named(with_first, "z")).groupBy("me", "other").agg(F.count(F.lit(1)).alias("lists"), F.max("subset").alias("subset"))
    # The partners met in most lists connect a group; any other pair is left to the second scan, which reads no subsets.
    likely = Window.partitionBy("me").orderBy(F.desc("lists"), "other")
    chosen = met.withColumn("k", F.row_number().over(likely)).where((F.col("k") <= FIRST_PAIRS) | F.col("subset"))
    return _pairs(chosen, "me", "other").distinct()


#: Whether the parity maps of two sets allow a link: no two sets that link differ in more bits.
_DIFFER = "aggregate(zip_with({x}bits, {y}bits, (a, b) -> bit_count(a ^ b)), 0, (s, v) -> s + v)"


def _near(x: str, y: str, percent: int) -> Column:
    return F.expr(f"(100 + {percent}) * ({x}n + {y}n - {_DIFFER.format(x=x, y=y)}) >= 2 * {percent} * ({x}n + {y}n)")


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that parity maps don't rule out; their texts need not travel for the others."""
    x = sets.select(F.col("doc").alias("a"), F.col("n").alias("x_n"), F.col("bits").alias("x_bits"))
    y = sets.select(F.col("doc").alias("b"), F.col("n").alias("y_n"), F.col("bits").alias("y_bits"))
    return pairs.join(x, "a").join(y, "b").where(_near("x_", "y_", percent)).select("a", "b").distinct()


def _size_class(n: str, percent: int) -> Column:
    """Sets that may link are of one class or of two neighbouring ones; the base leaves room for rounding."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(math.log(101 / percent))).cast("int")


def _mixed_entries(lists: DataFrame, labels: DataFrame, bits: DataFrame, several: DataFrame) -> DataFrame:
    """The entries of lists that meet two components, with component, major, bits and before.

    ``major`` marks those of the list's largest component; ``before`` has the first few listed
    shingles of the document that come before this one: a pair that shares one of them was met there.
    ``several``: documents with more than one set, whose entries can't tell.
    """
    named = lists.where("n >= 0").drop("part").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "doc")), "named")
    sums = named.groupBy("tok", "component").agg(F.count(F.lit(1)).alias("k"))
    tops = sums.groupBy("tok").agg(F.count(F.lit(1)).alias("components"), F.max(F.struct("k", "component")).alias("top")).where("components > 1")
    tops = stored(tops.select("tok", F.col("top.component").alias("top")), "mixed")
    found = stored(named.join(small(tops, tops.count()), "tok").withColumn("major", F.col("component") == F.col("top")).drop("top"), "entries")
    early = F.slice(F.array_sort(F.collect_list(F.struct("pos", "tok"))), 1, EARLY)
    firsts = found.groupBy("doc").agg(early.alias("early")).join(several.withColumn("more", F.lit(True)), "doc", "left")
    firsts = firsts.select("doc", F.when(F.col("more"), F.slice("early", 1, 0)).otherwise(F.col("early")).alias("early"))
    found = found.join(firsts, "doc").join(bits, "doc")
    return stored(found.withColumn("before", F.expr("transform(filter(early, e -> e.pos < pos), e -> e.tok)")).drop("early"), "entries")


def _second_pairs(entries: DataFrame, percent: int, limit: int) -> DataFrame:
    """The pairs of each list between different components, but for those whose parity maps differ too much to link."""
    own = _size_class("n", percent)
    # Side 1 holds all entries, side 2 those outside the list's largest component.
    index = entries.where(f"(100 + {percent}) * (n - pos) >= 2 * {percent} * n")
    x = index.withColumn("side", F.when(F.col("major"), 2).otherwise(1)).withColumn("class", F.explode(F.array(own, own + 1))).alias("x")
    y = entries.withColumn("side", F.explode(F.when(F.col("major"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2))))).withColumn("class", own).alias("y")
    same_list = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.class") == F.col("y.class")) & (F.col("x.side") == F.col("y.side"))
    smaller = F.expr("x.component <> y.component AND (x.n < y.n OR x.n = y.n AND x.doc < y.doc)")
    joined = x.join(y, same_list & smaller & _may_link("x", "y", percent, limit) & ~F.arrays_overlap("x.before", "y.before") & _near("x.", "y.", percent))
    return _pairs(joined, "x.doc", "y.doc").distinct()


def _links(pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link: each pair meets both its texts, which travel compressed, and compares their sets."""
    ids = stored(pairs.select(F.col("a").alias("doc")).unionAll(pairs.select(F.col("b").alias("doc"))).distinct(), "ids")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["th"], pa.array([zlib.compress(b, 1) for b in batch["body"].to_pylist()], pa.binary())], names=["doc", "th", "z"])

    content = rows.join(small(ids, ids.count()), "doc", "left_semi").mapInArrow(squeeze, "doc long, th long, z binary")
    # Each text once, however often its row is repeated.
    content = stored(content.dropDuplicates(["doc", "th"]).select("doc", "z"), "content")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, None
        for batch in batches:
            keep = []
            for k, (za, zb) in enumerate(zip(batch["za"], batch["zb"], strict=True)):
                if (zb := zb.as_py()) != last:  # rows come sorted by b
                    last, y = zb, shingles(zlib.decompress(zb), width)
                x = shingles(zlib.decompress(za.as_py()), width)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    left = pairs.join(content.select(F.col("doc").alias("a"), F.col("z").alias("za")), "a")
    both = left.join(content.select(F.col("doc").alias("b"), F.col("z").alias("zb")), "b").select("a", "b", "za", "zb")
    found = stored(both.mapInArrow(compare, "a long, b long").distinct(), "links")
    drop_path(rows.sparkSession, content._scratch)
    return found


def links(docs: DataFrame, *, width: int = SHINGLE, percent: int = PERCENT, limit: int | None = None, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """All links a > b between class representatives, and the membership (doc, rep) of every row with words.

    For those who need the links themselves: there are as many as there are, in a group of near
    copies about the square of its size.  Components don't need them, see ``near_components``.
    """
    limit = boundary(percent) if limit is None else limit
    rows, members, classes, lists = _prepared(docs, width, percent, limit, hot)
    x, y = lists.alias("x"), lists.alias("y")
    subsets = F.expr("x.n < 0 AND y.n < 0")
    joined = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.doc") > F.col("y.doc")) & (_may_link("x", "y", percent, limit) | subsets))
    found = _links(_pairs(joined, "x.doc", "y.doc").distinct(), rows, width, percent)
    return found, members.where("n > 0").join(classes, "sig").select("doc", "rep")


def _prepared(docs: DataFrame, width: int, percent: int, limit: int, hot: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows, their classes' signatures, the classes, and the lists of the representatives."""
    rows = rows_of(docs)
    read = stored(_signatures(rows.select("doc", "body"), width), "signatures")
    levels = docs.sparkSession.sparkContext.broadcast(_classes_of_frequency(read.where("kind = 1")))
    members = read.where("kind = 0").drop("kind")
    classes = stored(members.where("n > 0").groupBy("sig").agg(F.min("doc").alias("rep"), F.any_value("n").alias("n"), F.any_value("bits").alias("bits")), "classes")
    # Always by a shuffle of the texts, however few the classes: the plan is the same at every size.
    chosen = rows.select("doc", "body").join(classes.select(F.col("rep").alias("doc")).hint("merge"), "doc", "left_semi")
    return rows, members.drop("bits"), classes, stored(_listed(_entries(chosen, levels, width, percent, limit, hot)), "lists")


def near_components(docs: DataFrame, *, width: int = SHINGLE, percent: int = PERCENT, limit: int | None = None, hot: int = HOT) -> DataFrame:
    """doc, sig, n, component for every row: the smallest doc_id that links lead to (null ids as NULL_ID)."""
    limit = boundary(percent) if limit is None else limit
    rows, members, classes, lists = _prepared(docs, width, percent, limit, hot)
    several = stored(members.where("n > 0").groupBy("doc").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).where("x <> y").select("doc"), "several")
    own = members.join(several, "doc", "left_semi").join(classes, "sig").select(F.col("doc").alias("a"), F.col("rep").alias("b"))

    sets = classes.select(F.col("rep").alias("doc"), "n", "bits")
    first = stored(_plausible(_first_pairs(lists, percent, limit), sets, percent), "pairs")
    labels = stored(components(_links(first, rows, width, percent).unionAll(own)), "labels")
    entries = _mixed_entries(lists, labels, sets.drop("n"), several)
    drop_path(docs.sparkSession, lists._scratch)
    second = stored(_second_pairs(entries, percent, limit).join(first, ["a", "b"], "left_anti"), "pairs")
    more = _links(second, rows, width, percent)
    if more.take(1):
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    found = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("sig", F.coalesce("component", "rep").alias("component"))
    return members.join(found, "sig", "left").withColumn("component", F.coalesce("component", "doc"))


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return near_components(docs, **options).select(
        id_back(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), id_back(F.col("component")).alias("component_id")
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each component: that of its smallest doc_id, null last, with the columns of ``docs``.

    A row is named by its doc_id, or where that is null or has several texts, by a hash of both: only
    rows whose texts link or are equal make a component.  Of rows that agree in id and text one stays.
    Rows without words all stay.
    """
    doc, body = id_of(docs), text_of(docs)
    named = docs.select(doc.alias("real"), F.xxhash64(body).alias("th"))
    shared = named.groupBy("real").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where(f"lo < hi OR real = {NULL_ID}")
    shared = stored(shared.select("real"), "shared-ids")
    mark = small(shared.select("real", F.lit(True).alias("shared")), shared.count())
    row = docs.select(doc.alias("real"), F.struct(*[docs[c] for c in docs.columns]).alias("row"), body.alias("text"), body.rlike(WORD_PATTERN).alias("worded")).join(mark, "real", "left")
    row = row.withColumn("doc_id", F.when(F.col("shared"), F.xxhash64("real", "text")).otherwise(F.col("real")))
    worded = row.where("worded")
    found = near_components(worded.select("doc_id", "text"), **options)
    # The ids that stand behind hashes rank by themselves.
    behind = worded.where("shared").select(F.col("doc_id").alias("doc"), "real").distinct()
    ranked = found.select("doc", "component").distinct().join(behind, "doc", "left")
    stay = ranked.groupBy("component").agg(F.min(F.struct(F.coalesce("real", "doc"), "doc")).alias("first")).select(F.col("first.doc").alias("doc_id"))
    order = Window.partitionBy("doc_id").orderBy(F.hash("row"))
    kept = worded.select("doc_id", "row").join(stay, "doc_id", "left_semi").withColumn("_k", F.row_number().over(order)).where("_k = 1")
    return kept.select("row.*").unionAll(row.where("NOT worded").select("row.*"))
