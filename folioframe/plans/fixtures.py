"""Layout tables derived from the driver's star schema: customer, orders, lineitem as document, page, box.

The SQL runs unchanged in Spark and DuckDB; its formulas only spread cases and carry no meaning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ship

FX_PAGES = """
select o_custkey as doc_id,
  cast(row_number() over (partition by o_custkey order by o_orderkey) as int) as page_number,
  o_orderkey as page_key,
  cast(1000 + o_orderkey % 7 * 100 as int) as page_width,
  cast(1400 + o_orderkey % 5 * 100 as int) as page_height,
  cast(o_orderkey % 4 * 90 as int) as rotation_degrees
from {orders} where o_custkey % 41 <> 0
"""

FX_RAW_BOXES = """
select l_orderkey as page_key,
  cast(row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as int) as box_idx,
  case when l_partkey % 132 = 11 then '  ' when l_partkey % 12 = 0 then ' Table '
    when l_partkey % 12 = 1 then 'TEXT' when l_partkey % 12 = 2 then 'paragraph_title'
    when l_partkey % 12 = 3 then 'chart' when l_partkey % 12 = 4 then 'seal'
    when l_partkey % 12 = 5 then 'header' when l_partkey % 12 = 6 then 'footer'
    when l_partkey % 12 = 7 then 'number' when l_partkey % 12 = 8 then 'formula'
    when l_partkey % 12 = 9 then 'header_image' when l_partkey % 12 = 10 then 'document_index'
    else 'text' end as label,
  case when l_partkey % 197 = 5 then cast(null as double) when l_partkey % 193 = 7 then cast(1.5 as double)
    else cast(1.0 as double) - l_tax - l_discount end as score,
  cast(l_partkey * 7 % 1000 as double) - 60 as x0,
  cast((l_suppkey * 137 + l_partkey * 3) % 1400 as double) - 40 as y0,
  cast(l_partkey * 7 % 1000 as double) - 60 + l_quantity * 12.5 - 12.5 as x1,
  cast((l_suppkey * 137 + l_partkey * 3) % 1400 as double) - 40 + l_linenumber * 40.5 as y1
from {lineitem}
"""

FX_PATHS = """
select doc_id, concat(source, '-', cast(doc_id as varchar(20)), case cast(doc_id % 6 as int) when 0 then '.pdf' when 1 then '.PDF'
  when 2 then '.docx' when 3 then '.xml' when 4 then '' else '.tar.pdf' end) as source
from {documents}
"""

FX_STRUCTURAL = """
select page_id as doc_id, case when page_id % 11 = 0 then ' ' else concat('#/tables/', cast(page_id as varchar(20))) end as item_ref,
  case when page_id % 3 = 0 then 'pdf' when page_id % 17 = 0 then 'odt' else 'docx' end as source_format,
  case when page_id % 4 = 0 then 'pdf' else 'docx' end as document_format
from {pages}
"""

#: Every 37th document fails when its detector is made.
FAILED = "doc_id % 37 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Fixture:
    """Engine tables, keyed by doc_key = doc_id as text."""

    documents: DataFrame
    pages: DataFrame
    raw_boxes: DataFrame
    failed: DataFrame


def derived(spark: SparkSession, sf_dir: str, sql: str, **tables: str) -> DataFrame:
    return spark.sql(sql, **{k: table(spark, sf_dir, v) for k, v in tables.items()})


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    key = F.col("doc_id").cast("string").alias("doc_key")
    fx_pages = derived(spark, sf_dir, FX_PAGES, orders="orders")
    boxes = derived(spark, sf_dir, FX_RAW_BOXES, lineitem="lineitem")
    documents = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_key"), F.concat(F.lit("/data/"), F.col("c_custkey"), F.lit(".pdf")).alias("source"))
    image = F.format_string("pages/page-%04d.png", "page_number").alias("image")
    pages = fx_pages.select(key, "page_number", image, "page_width", "page_height", "rotation_degrees")
    raw = boxes.join(fx_pages.select("page_key", "doc_id", "page_number"), "page_key").select(
        key,
        "page_number",
        "box_idx",
        F.lit(True).alias("is_mapping"),
        "label",
        F.lit(True).alias("label_ok"),
        "score",
        F.when(F.col("score").isNull(), "missing").alias("score_error"),
        F.lit(None).cast("string").alias("coord_error"),
        "x0",
        "y0",
        "x1",
        "y1",
        F.lit(None).cast("string").alias("exception_type"),
        F.lit(None).cast("string").alias("message"),
    )
    failed = table(spark, sf_dir, "customer").where("c_custkey % 37 = 0").select(F.col("c_custkey").cast("string").alias("doc_key"))
    return Fixture(documents.withColumn("source_format", F.lit("pdf")), pages, raw, failed)
