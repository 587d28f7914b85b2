"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` reads every text once, takes all measurements, and stores one bit per failed rule.
Policies are versioned masks over these bits: ``apply_policy`` turns a ledger into verdicts, and
``ablation`` compares policies, without touching a text again.

Edge cases: a null or empty text has no words, so it fails ``too_few_words``.  Very long texts are measured
whole.  Of windows or lines that tie, the first counts as stated by each measure.  Repeated rows get
equal results, a null doc_id stays null.  An empty table gives an empty ledger.  Other columns are left
out, whatever their names; ``filter_documents`` passes them on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_PATTERN

#: Width of the window for repeated words.
REPEAT_WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


#: The position in this tuple is the bit.  Append only: stored ledgers keep their meaning.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_heavy", "n_words > 0 AND 5 * n_symbols > 2 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("long_words", "n_words > 0 AND word_chars > 20 * n_words"),
    Rule("too_many_words", "n_words > 100000"),
)
BIT = {rule.name: 1 << k for k, rule in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BIT["too_few_words"] | BIT["repeated_words"],
    "v1": BIT["too_few_words"] | BIT["repeated_words"] | BIT["symbol_heavy"] | BIT["repeated_lines"] | BIT["long_words"],
}
DEFAULT_POLICY = "v1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside any 8-word window that is found twice or more.

    Each step binds its array to a lambda variable, so it is computed once.  The usual text has no
    repeated window; it is done after one pass over its window hashes.
    """
    n = REPEAT_WINDOW

    def once(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = once(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(
                        p,
                        lambda x, k: F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))
        return F.aggregate(
            again,
            start,
            lambda acc, i: F.struct(
                (acc["total"] + F.lit(n) - F.greatest(F.lit(0), acc["end"] - i)).cast("long").alias("total"),
                (i + F.lit(n)).cast("int").alias("end"),
            ),
            lambda acc: acc["total"],
        )

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - F.lit(n - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(n))))

    found = once(
        once(F.transform(words, lambda w: F.xxhash64(w)), windows),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")),
    )
    return F.when(F.size(words) > n, found).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and MEASURES (long)."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    read = docs.select(docs[id_col].alias("doc_id"), text.alias("_text"))
    cut = read.select(
        "doc_id",
        F.filter(F.split("_text", SPACE_CLASS + "+"), lambda w: w != "").alias("_words"),
        F.transform(
            F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD_PATTERN)), lambda line: F.xxhash64(line, F.length(line))
        ).alias("_lines"),
        (F.octet_length("_text") - F.octet_length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
    )
    return cut.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``fail_bits``: bit k is set if rule k fails."""
    measured = measure(docs, id_col, text_col)
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def apply_policy(ledger_df: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Adds ``base_failed``, ``kept`` and the policy's name."""
    failed = lambda mask: F.col("fail_bits").bitwiseAND(F.lit(mask)) != 0
    return ledger_df.withColumns(
        {"base_failed": failed(POLICIES["base"]), "kept": ~failed(POLICIES["base"] | POLICIES[policy]), "policy": F.lit(policy)}
    )


def ablation(ledger_df: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """What each rule of a policy does: documents failing it, and documents that only it rejects.

    The documents are first counted by their bits, at most 2 ** len(RULES) groups.
    """
    mask = POLICIES[policy]
    by_bits = ledger_df.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit")) for r in RULES if BIT[r.name] & mask])
    each = by_bits.select("fail_bits", "n", F.explode(rules).alias("r")).select("fail_bits", "n", "r.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("fail_bits").bitwiseAND(F.lit(mask)) == F.col("bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(total(hit).alias("n_failed"), total(alone).alias("n_only_this")).withColumn("policy", F.lit(policy))


def filter_documents(docs: DataFrame, policy: str = DEFAULT_POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with the same columns; no shuffle."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text_col].alias("_text"))
    # A verdict that isn't deterministic by name keeps the filter above the ledger: pushed into it,
    # the filter would split each text again for every rule that reads a measurement.
    kept = F.when(F.monotonically_increasing_id() >= 0, F.col("kept"))
    return apply_policy(ledger(whole, "_row", "_text"), policy).withColumn("kept", kept).where("kept").select("doc_id.*")
