"""The thin ``opN_*`` queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ship
from . import decontam, htmltext, jaccard, linededup, mixing, pii, quality, substrdedup, tokenbin, urlfilter
from .sql import ORACLES

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabulary file lies; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base, more = pii.digest(F.col("base")), pii.digest(F.col("more"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in pii.KINDS]
    counts = [(F.size("base") - n).alias(f"n_{k}") for k, n in zip(pii.KINDS, counts, strict=True)]
    spans = F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(more, F.lit("")))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"), F.size("base").cast("long").alias("n_base"))


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs), with_text=False)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substrdedup.remove_spans(docs, substrdedup.repeated_spans(docs), with_text=False)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_pii,
            op2_token_binary,
            op3_line_dedup,
            op4_ngram_jaccard,
            op5_html_text,
            op6_quality_rules,
            op7_url_filter,
            op8_substring_dedup,
            op9_decontamination,
            op10_source_mix,
        )
    }


def oracle_sql() -> dict[str, str]:
    """All but op2 (the library's vocabulary) and op5 (the trained tree), which tests hold against plain Python."""
    return dict(ORACLES)
