"""PII: information-theoretic sanitisation, in DataFrame functions only.

Base spans are found by the patterns below: e-mail and IP addresses, card and phone numbers.  Their
values are the protected entities.  A term t reveals an entity e as far as seeing t tells about e:

    PMI(e; t) = log2(N * n(e, t) / (n(e) * n(t))),   IC(e) = log2(N / n(e)),

with n the number of documents (different doc_ids) that hold e, t, or t in the context of e, and N all
documents.  The context of a match is the ``near`` code points on either side of it, up to the next
match of its kind, without words that are cut off: a name above an address is in it.

A term whose share PMI / IC reaches ``generalise`` is generalised, and one that reaches ``remove`` is
removed, in every document that holds the entity.  Evidence is judged by an interval: the share must
reach ``generalise`` also where n(e, t) / n(t) is taken at the lower end of its Wilson interval of ``z``
standard errors, whose sample is the different contexts that hold both.  One context in a small corpus
is no evidence, nor are copies of it; in a large one, where a word of its own tells more, it is.
Documents without a base span are never changed.

Texts are matched once, and what they hold is stored.  n(t) is counted over all documents, by sums
before the shuffle; only documents whose doc_id occurs twice are made distinct first.

Patterns: positions come from splitting at the matches, so texts are read by Java's matcher in linear
time: runs are possessive, and guarded so that a failed run is not tried again from its middle.
Running sums over n matches are taken in blocks of the root of n.

Edge cases: a null or empty text has no span.  Very long texts are read whole, and their contexts
are as long as any.  Rows that share a doc_id count as one document and are each judged by their own
text; null doc_ids are one.  Repeated rows get equal results and count once.  A term at a threshold,
exactly, reaches it.  Columns of any other name are not read.  An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stored

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns; each finds the same leftmost, non-overlapping matches.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

TERM = r"\p{L}{4,}"
#: Code points of a match's context on either side.
NEAR = 100
#: Standard errors of the interval that judges evidence.
Z = 1.0
GENERALISE = 0.8
REMOVE = 0.95


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def value(k: Column) -> Column:
        v = F.substring(back, k, 1).cast("int") * (F.lit(2) - F.pmod(k, F.lit(2)))
        return v - F.when(v > 9, F.lit(9)).otherwise(F.lit(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, k: a + value(k))
    return F.pmod(total, F.lit(10)) == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        plain = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(match, r"\."), lambda p: (F.length(plain(p)) < 3) | (F.length(plain(p)) == 3) & (plain(p) <= "255"))
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda match: _valid(kind, match)


_SPAN = "array<struct<kind:string,begin:int,end:int,value:string>>"
_NEAR_SPAN = "array<struct<kind:string,begin:int,end:int,value:string,terms:array<string>,context:bigint>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, add) -> Column:
    """For each of an array of ints, all before it added up from 0; in blocks, so no long array is copied for each."""
    none = F.array().cast("array<int>")

    def run(items: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), none.alias("out"))
        step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(items, zero, step, lambda acc: acc["out"])

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int")), lambda k: F.slice(v, k * width + 1, width))

    def joined(b: Column) -> Column:
        sums = F.transform(b, lambda block: F.aggregate(block, F.lit(0), add))
        return F.flatten(F.zip_with(b, run(sums, F.lit(0)), run))

    return _let(values, lambda v: F.when(F.size(v) > 0, _let(blocks(v), joined)).otherwise(none))


def _located(text: Column, pattern: str, label: Column, valid, near: int | None = None) -> Column:
    """The valid matches of a pattern with their code points, with ``near`` also their context's terms; all matches move the position."""

    def span(x: Column, begin: Column) -> Column:
        begin = begin + F.length(x["gap"])
        fields = [label.alias("kind"), begin.alias("begin"), (begin + F.length(x["m"])).alias("end"), x["m"].alias("value")]
        if near:
            context = F.concat(_cut(x["gap"], near, True), F.lit("|"), _cut(x["next"], near, False))
            terms = F.array_distinct(F.regexp_extract_all(F.lower(context), F.lit(TERM), F.lit(0)))
            fields += [terms.alias("terms"), F.xxhash64(context).alias("context")]
        return F.struct(*fields)

    def spans(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda x: F.length(x["gap"]) + F.length(x["m"]))
        return F.zip_with(pieces, _before(sizes, lambda a, b: a + b), span)

    # One gap more than matches: each match with the gaps before and after it.
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = _let(gaps, lambda g: F.arrays_zip(F.slice(g, 1, F.size(g) - 1).alias("gap"), F.slice(g, 2, F.size(g) - 1).alias("next")))
    pieces = F.zip_with(both, hits, lambda g, m: F.struct(g["gap"].alias("gap"), g["next"].alias("next"), m.alias("m")))
    return F.filter(_let(pieces, spans), lambda s: valid(s["value"])).cast(_NEAR_SPAN if near else _SPAN)


def _cut(gap: Column, near: int, end: bool) -> Column:
    """The last or first ``near`` code points of a gap, without the word that the cut goes through."""
    part = F.regexp_replace(F.right(gap, F.lit(near)), r"\A\p{L}+", "") if end else F.regexp_replace(F.left(gap, F.lit(near)), r"\p{L}+\z", "")
    return F.when(F.length(gap) > near, part).otherwise(gap)


def base_spans(text: Column, near: int | None = None) -> Column:
    """Spans of all kinds, in the order of KINDS and then of begin."""
    none = F.array().cast(_NEAR_SPAN if near else _SPAN)
    found = []
    for kind in KINDS:
        needs = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(_NEEDS[kind])
        found.append(F.when(needs, _located(text, PATTERNS[kind], F.lit(kind), _validity(kind), near)).otherwise(none))
    return F.concat(*found)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def _like(a: str, b: str) -> Column:
    """Two names of a row are the same: doc_id and th against _id and _th."""
    return F.col(a).eqNullSafe(F.col("_id")) & (F.col(b) == F.col("_th"))


def _held(texts: DataFrame, near: int) -> DataFrame:
    """doc_id, th, spans of each different text with a base span."""
    any_kind = "@|" + "|".join(_NEEDS[k] for k in KINDS[1:])
    found = texts.where(F.col("text").rlike(any_kind)).select("doc_id", "th", base_spans(F.col("text"), near).alias("spans"))
    return stored(found.where(F.size("spans") > 0).dropDuplicates(["doc_id", "th"]), "pii-held")


def _weight(df: DataFrame, chars: Column) -> int:
    """The rows of a table; one with long values counts once more for each 64 code points of them."""
    return df.agg(F.sum(1 + F.floor(chars / 64))).first()[0] or 0


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["value"])


def _wilson_low(p: Column, n: Column, z: float) -> Column:
    zz = F.lit(z * z)
    return (p + zz / (2 * n) - F.lit(z) * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def _disclosing(texts: DataFrame, held: DataFrame, generalise: float, z: float) -> DataFrame:
    """entity, term, share (PMI / IC) of every term over the threshold."""
    spans = held.select("doc_id", F.explode("spans").alias("s")).select("doc_id", _entity(F.col("s")).alias("entity"), "s.terms", "s.context")
    each = spans.select("doc_id", "entity", "context", F.explode("terms").alias("term")).distinct()
    # A null doc_id is one document: it is counted apart from the others.
    several = lambda c: F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))
    n_both = each.groupBy("entity", "term").agg(several("doc_id").alias("n_both"), F.countDistinct("context").alias("contexts"))
    n_entity = spans.groupBy("entity").agg(several("doc_id").alias("n_entity"))
    # Summed before it is joined: every word of every document is counted once, on the map side.
    ids = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    again = stored(ids.where("rows > 1").select(F.col("doc_id").alias("_id")), "pii-ids")
    again = small(again, again.count())
    mine = F.col("doc_id").eqNullSafe(F.col("_id"))
    words = lambda df: df.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0)))).alias("term"))
    words = words(texts.join(again, mine, "left_anti")).select("term").unionAll(words(texts.join(again, mine, "left_semi")).distinct().select("term"))
    n_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n_all = F.lit(float(ids.count()))
    ic = F.log2(n_all / F.col("n_entity"))
    p = F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0))
    share = lambda part: F.when(ic > 0, F.log2(n_all * part / F.col("n_entity")) / ic)
    out = n_both.join(n_term, "term").join(n_entity, "entity")
    out = out.select("entity", "term", share(p).alias("share"), share(_wilson_low(p, F.col("contexts"), z)).alias("low"))
    return stored(out.where(F.col("low") >= generalise).drop("low"), "pii-terms")


def disclosing_terms(docs: DataFrame, *, near: int = NEAR, z: float = Z, generalise: float = GENERALISE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """entity, term, share (PMI / IC) of every term over the threshold."""
    texts = _texts(docs, id_col, text_col)
    return _disclosing(texts, _held(texts, near), generalise, z)


def _term_spans(texts: DataFrame, held: DataFrame, found: DataFrame, remove: float) -> DataFrame:
    """_id, _th, more: spans of the disclosing terms in each text that holds their entity.

    Words meet the terms as rows, so a text with many of both is no square.
    """
    entities = held.select("doc_id", "th", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
    told = small(found, _weight(found, F.length("entity") + F.length("term")))
    mine = entities.join(told, "entity").groupBy("doc_id", "th", "term").agg(F.max("share").alias("share"))
    mine = stored(mine.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "pii-mine")
    rows = stored(mine.select("_id", "_th").distinct(), "pii-rows")
    both = texts.join(small(rows, rows.count()), _like("doc_id", "th")).dropDuplicates(["doc_id", "th"])
    words = both.select("doc_id", "th", F.explode(_located(F.col("text"), r"\p{L}++", F.lit("term"), lambda m: F.length(m) >= 4)).alias("s"))
    words = words.join(mine, _like("doc_id", "th") & (F.lower("s.value") == F.col("term")))
    label = F.when(F.col("share") >= remove, F.lit("term_removed")).otherwise(F.lit("term"))
    place = F.struct("s.begin", "s.end", label.alias("kind"), "s.value")
    ordered = F.array_sort(F.collect_list(place))
    named = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["value"].alias("value")))
    return words.groupBy("_id", "_th").agg(named.cast(_SPAN).alias("more"))


def find(
    docs: DataFrame,
    *,
    near: int = NEAR,
    z: float = Z,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """doc_id, base, more (spans of terms), and with ``with_text`` the whole text, for every row."""
    texts = _texts(docs, id_col, text_col)
    held = _held(texts, near)
    more = _term_spans(texts, held, _disclosing(texts, held, generalise, z), remove)
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["value"].alias("value")))
    spans = held.join(more, _like("doc_id", "th"), "left").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), plain.alias("base"), "more")
    spans = stored(spans, "pii-spans")
    none = F.array().cast(_SPAN)
    # A row may hold any number of spans, so spans are what the bound of a broadcast counts.
    chars = F.aggregate(F.concat("base", F.coalesce("more", none)), F.lit(0).cast("long"), lambda n, s: n + 64 + F.length(s["value"]))
    joined = texts.join(small(spans, _weight(spans, chars)), _like("doc_id", "th"), "left")
    return joined.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("more", none).alias("more"), *(["text"] if with_text else []))


def digest(spans: Column) -> Column:
    """``kind:begin:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """doc_id and ``text`` with entities replaced by their kind, terms generalised to ``[TERM]`` or removed.

    Of overlapping spans the first replaces, and the others only extend it.
    """
    found = find(docs, with_text=True, **options)
    spans = F.array_sort(
        F.transform(F.concat("base", "more"), lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    found = found.select("doc_id", "text", spans.alias("spans"))
    # Where all spans before each one end, and what lies between, cut from an array of the characters.
    found = found.withColumn("till", _before(F.transform("spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b)))
    some = F.size("spans") > 0
    found = found.withColumn("chars", F.when(some, F.split("text", "")))
    name = lambda s: F.when(s["kind"] == "term_removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def piece(s: Column, till: Column) -> Column:
        before = F.array_join(F.slice("chars", till + 1, F.greatest(s["begin"] - till, F.lit(0))), "")
        return F.when(s["begin"] >= till, F.concat(before, name(s))).otherwise("")

    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    rest = F.array_join(F.slice("chars", end + 1, F.size("chars")), "")
    whole = F.concat(F.array_join(F.zip_with("spans", "till", piece), ""), rest)
    return found.select("doc_id", F.when(some, whole).otherwise(F.col("text")).alias("text"))
