"""Sources to their registered extractor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import detect_format, format_error


def dispatch(paths: DataFrame, extractors: DataFrame, path_col: str = "source") -> DataFrame:
    """Each path with its format, its one extractor, and what is wrong (null if nothing).

    ``extractors``: extractor, document_format.  Formats are few, so they are counted first; a
    format needs exactly one extractor.
    """
    per_format = extractors.groupBy("document_format").agg(F.count(F.lit(1)).alias("n"), F.min("extractor").alias("extractor"))
    named = paths.withColumns({"source_format": detect_format(F.col(path_col)), "_bad": format_error(F.col(path_col))})
    joined = named.join(per_format, named["source_format"] == per_format["document_format"], "left")
    error = (
        F.when(F.col("source_format").isNull(), F.col("_bad"))
        .when(F.col("n").isNull(), F.concat(F.lit("no layout extractor is registered for ."), "source_format"))
        .when(F.col("n") > 1, F.concat(F.lit("several layout extractors are registered for ."), "source_format"))
    )
    return joined.select(*paths.columns, "source_format", F.when(F.col("n") == 1, F.col("extractor")).alias("extractor"), error.alias("dispatch_error"))


def format_mismatches(results: DataFrame, extractors: DataFrame) -> DataFrame:
    """Extracted documents whose format isn't their extractor's.  results: extractor, source_format."""
    return results.join(extractors, "extractor").where(~F.col("source_format").eqNullSafe(F.col("document_format")))


def structural_format_mismatches(documents: DataFrame, regions: DataFrame) -> DataFrame:
    """Structural regions that refer to another format than their document's."""
    found = regions.where(F.col("location.type") == "structural").select("doc_key", "id", F.col("location.source_format").alias("region_format"))
    return found.join(documents.select("doc_key", "source_format"), "doc_key").where(F.col("region_format") != F.col("source_format"))
