"""Documents as they arrive: the batch pipeline for each micro-batch of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.naming import detect_format, document_key
from ..plans.pipeline import run_documents
from ..schemas import DEFAULT_DPI, SCHEMA_VERSION


def arriving(spark: SparkSession, folder: str, dpi: int = DEFAULT_DPI) -> DataFrame:
    """New files below ``folder`` as documents; their content is not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder).select("path")
    source = F.regexp_replace("path", "^file:/*", "/")
    return files.select(
        document_key(source).alias("doc_key"), source.alias("source"), detect_format(source).alias("source_format"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(dpi).alias("dpi")
    )


def start(documents: DataFrame, root: str, checkpoint: str, **options) -> StreamingQuery:
    """Runs the pipeline on each micro-batch.  Artifacts overwrite by key, so a repeated batch is harmless."""

    def batch(rows: DataFrame, number: int) -> None:
        run = run_documents(rows.where(F.col("source_format") == "pdf"), root, **options)
        run.exported.write.mode("overwrite").parquet(f"{checkpoint.rstrip('/')}-exported/batch={number}")

    return documents.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
