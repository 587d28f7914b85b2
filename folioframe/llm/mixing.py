"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source gets a target number of words.  A source with target / size = c + f (c whole, 0 <= f < 1)
takes c certain whole copies of each document, and a sample that adds f of the source's words.  In it
a document of size class k (2^k to 2^(k+1) - 1 words) is included with probability

    p = min(1, level * 2^(power * k)),   where level makes the expected words those that are wanted:

longer documents are taken rather than short ones, those with p = 1 are certain, and power = 0 gives
all documents of a source equal odds.  The sample is an order sample: documents are ranked by

    odds(U) / odds(p),   odds(x) = x / (1 - x),   U uniform, a hash of doc_id and seed,

and the lowest ranked are taken until the source's words reach the target; the document at the
boundary is taken if that brings the words nearer to it.

The texts are read once, for their sizes; a mix that carries whole rows reads them once more.  No
window runs over a whole source.  Words are first summed by source and fine slice of the rank (a
map-side sum).  Running sums find the boundary's coarse slice and then its fine slice within that, each
over ``FAN`` rows of a source at most, and only the rows of this fine slice are ranked one by one.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share all words.  A target
stops at ``max_copies`` times its source's size and the excess is shared by weight again; this is the
water level of the capped shares, found by sorting the caps.  One task sorts the sources, a row each.

Edge cases: null and empty texts have size 0; they get the certain copies and count no words.  Very
long texts are only counted.  Rows that agree in id, size and source are interchangeable, and ties
are broken by id and size.  A null doc_id draws one U, the same for all such rows.  Columns of any
other name are not read, and ``mixed_documents`` passes them on.  An empty table gives an empty
result.  An empty source has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, small, stored

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = 7
#: How inclusion rises with a document's size class.
POWER = 0.5
#: Coarse slices of U, and fine slices in each: about one in FAN * FAN rows is ranked one by one.
FAN = 1024

_UNIT = float(1 << 48)


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def _uniform(doc_id: Column, seed: int) -> Column:
    """In (0, 1), the same in every run."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_UNIT)


def _shares(rows: DataFrame, by: str | None, total: Column, weight: str, cap: str, share: str) -> DataFrame:
    """``total`` dealt by weight, within each ``by``, where no share exceeds its cap: least(cap, level * weight)."""
    part = Window.partitionBy(F.lit(1) if by is None else F.col(by))
    by_cap = part.orderBy(F.col(cap) / F.col(weight), F.col(weight), cap)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum(weight).over(after)
    # The level is that of the first row, in order of cap, that the level doesn't fill.
    held = rows.withColumn("_level", level)
    is_open = F.col("_level") * F.col(weight) <= F.col(cap)
    first = F.min(F.when(is_open, F.struct((F.col(cap) / F.col(weight)).alias("at"), F.col(weight).alias("w"), F.col("_level").alias("level")))).over(part)
    return held.withColumn("_first", first["level"]).withColumn(share, F.coalesce(F.least(F.col(cap), F.col("_first") * F.col(weight)), F.col(cap))).drop("_level", "_first")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row per source; ``sizes`` has source and size."""
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # From here on the rows are the sources.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    capped = by_source.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * float(max_copies)).alias("_cap"))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    return _shares(capped, None, total, "_w", "_cap", "target").select("source", "source_size", "target")


def _chances(classes: DataFrame, plan: DataFrame, power: float) -> DataFrame:
    """_s, _k, _p: the probability of inclusion of each size class of each source that wants a sample."""
    wants = plan.where(F.col("_want") > 0).select(F.col("source").alias("_s"), "_want")
    held = classes.where(F.col("words") > 0).join(small(wants, plan.count()), F.col("source").eqNullSafe(F.col("_s")))
    held = held.withColumns({"_cap": F.col("words").cast("double"), "_w": F.pow(F.lit(2.0), F.lit(power) * F.col("class")) * F.col("words")})
    shared = _shares(held, "_s", F.col("_want"), "_w", "_cap", "_share")
    return shared.select("_s", F.col("class").alias("_k"), (F.col("_share") / F.col("_cap")).alias("_p"))


def _edge(sums: DataFrame, slice_col: str, wanted: DataFrame) -> DataFrame:
    """Each source's slice that holds the boundary, with the words before it; ``wanted`` has _s, _want, _base."""
    run = Window.partitionBy("source").orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("_run", F.coalesce(F.sum("words").over(run), F.lit(0)))
    found = running.join(wanted, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_before", F.col("_base") + F.col("_run"))
    holds = (F.col("_before") <= F.col("_want")) & (F.col("_before") + F.col("words") > F.col("_want"))
    return found.where(holds).groupBy("source").agg(F.min(F.struct(slice_col, "_before", "_want")).alias("_e")).select("source", "_e.*")


def _ranked(rows: DataFrame, chances: DataFrame, fan: int, seed: int) -> DataFrame:
    """``rows`` with _rank = r / (1 + r) of r = odds(U) / odds(p), in [0, 1], and its _slice; null where nothing is drawn."""
    u, p = _uniform(F.col("doc_id"), seed), F.col("_p")
    near, far = F.col("_u") * (1 - p), p * (1 - F.col("_u"))
    joined = rows.join(small(chances, chances.count()), F.col("source").eqNullSafe(F.col("_s")) & (F.col("class") == F.col("_k")), "left")
    ranked = joined.withColumn("_u", u).withColumn("_rank", near / (near + far)).drop("_s", "_k", "_p", "_u")
    return ranked.withColumn("_slice", F.least(F.floor(F.col("_rank") * (fan * fan)), F.lit(fan * fan - 1)).cast("int"))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    power: float = POWER,
    seed: int = SEED,
    fan: int = FAN,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken; with ``carry`` also ``row``, the whole row.

    Only the rows of boundary slices are shuffled, beside sums.
    """
    # The class is the place of the size's highest bit.
    size = size_of(docs[text_col])
    named = [docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), size.alias("size")]
    classed = lambda df: df.withColumn("class", F.when(F.col("size") > 0, F.length(F.bin("size")) - 1))
    sizes = classed(stored(docs.select(*named), "mix-sizes"))
    read = classed(docs.select(*named, F.struct(*[docs[c] for c in docs.columns]).alias("row"))) if carry else sizes

    classes = stored(sizes.groupBy("source", "class").agg(F.sum("size").cast("long").alias("words")), "mix-classes")
    plan = targets(classes.select("source", F.col("words").alias("size")), weights, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    whole = F.least(F.floor(ratio), F.lit(max_copies)).cast("int")
    plan = plan.withColumn("_whole", whole).withColumn("_want", F.greatest(F.col("target") - F.col("_whole") * F.col("source_size"), F.lit(0.0)))
    plan = stored(plan, "mix-targets")
    chances = stored(_chances(classes, plan, power), "mix-chances")

    # The slice of each source where the running sum passes what is wanted: the coarse one, then the fine one in it.
    drawn = _ranked(sizes, chances, fan, seed).where(F.col("_slice").isNotNull())
    sums = stored(drawn.groupBy("source", "_slice").agg(F.sum("size").alias("words")), "mix-sums")
    sums = sums.withColumn("_coarse", F.floor(F.col("_slice") / fan).cast("int"))
    wanted = plan.where(F.col("_want") > 0).select(F.col("source").alias("_s"), "_want", F.lit(0).cast("long").alias("_base"))
    coarse = _edge(sums.groupBy("source", "_coarse").agg(F.sum("words").alias("words")), "_coarse", wanted)
    coarse = coarse.select(F.col("source").alias("_s"), F.col("_coarse").alias("_c"), "_want", F.col("_before").alias("_base"))
    inside = sums.join(coarse, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_coarse") == F.col("_c")))
    cut = _edge(inside.select("source", "_slice", "words"), "_slice", inside.select("_s", "_want", "_base").distinct())
    cut = cut.select("source", F.struct("_slice", "_before").alias("_cut"))
    plan = stored(
        plan.join(cut.select(F.col("source").alias("_s"), "_cut"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
            F.col("source").alias("_source"), "source_size", "target", "_whole", "_want", F.col("_cut._slice").alias("_at"), F.col("_cut._before").alias("_at_before")
        ),
        "mix-plan",
    )
    joined = _ranked(read, chances, fan, seed).join(small(plan, plan.count()), F.col("source").eqNullSafe(F.col("_source")))
    inside = F.coalesce(F.col("_slice") == F.col("_at"), F.lit(False))
    out = ["doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), *(["row"] if carry else [])]

    # Whole slices of lower rank are in.
    settled = joined.where(~inside).withColumn("copies", F.col("_whole") + F.coalesce(F.col("_slice") < F.col("_at"), F.lit(False)).cast("int"))
    ranked = Window.partitionBy("source").orderBy("_rank", F.col("doc_id").asc_nulls_last(), "size")
    edge = joined.where(inside).withColumn("_till", F.col("_at_before") + F.sum("size").over(ranked.rowsBetween(Window.unboundedPreceding, 0)))
    # Taken while the middle of the document's words lies within what is wanted.
    edge = edge.withColumn("copies", F.col("_whole") + (F.col("_till") - F.col("size") / 2.0 <= F.col("_want")).cast("int"))
    return settled.select(*out).unionAll(edge.select(*out))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = mix(docs, carry=True, **options).where(F.col("copies") > 0)
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
