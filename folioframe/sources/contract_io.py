"""Contract JSON: layout documents and manifests out, layout documents in."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import document_error, region_error, structural_error, visual_error
from ..functions.labels import stripped
from ..functions.naming import check_dpi
from ..operators.manifests import manifest_pages, overlay_coverage, render_manifest_pages
from ..schemas import LOCATION, MANIFEST_VERSION, SCHEMA_VERSION
from .files import absolute, is_file, write_file

# ---- out -------------------------------------------------------------------------------------------


def location_json(location: Column) -> Column:
    """Only the arm that the type names, as a variant."""
    visual = F.struct(*[location[n].alias(n) for n in ("type", "page_number", "bbox", "page_width", "page_height", "coordinate_origin")])
    structural = F.struct(*[location[n].alias(n) for n in ("type", "source_format", "item_ref")])
    return F.when(location["type"] == "visual", F.to_variant_object(visual)).otherwise(F.to_variant_object(structural))


def layout_json(documents: DataFrame, regions: DataFrame, errors: DataFrame) -> DataFrame:
    """doc_key, layout: one JSON object a document.  A null confidence is written, the other arm is not."""
    where = F.coalesce(F.col("location.page_number"), F.lit(0))
    region = F.struct(where.alias("at"), "region_idx", F.struct("id", "kind", "role", "raw_label", "confidence", location_json(F.col("location")).alias("location")).alias("r"))
    by_doc = regions.groupBy("doc_key").agg(F.collect_list(region).alias("_r"))
    failed = errors.groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("page_number", "exception_type", "message"))).alias("errors"))
    order = F.expr("transform(array_sort(_r, (a, b) -> cast(sign(if(a.at = b.at, a.region_idx - b.region_idx, a.at - b.at)) as int)), x -> x.r)")
    joined = documents.join(by_doc, "doc_key", "left").join(failed, "doc_key", "left")
    body = F.struct(
        F.col("schema_version"),
        F.col("source"),
        F.col("source_format"),
        F.col("status"),
        F.coalesce(order, F.array()).alias("regions"),
        F.coalesce("errors", F.array().cast("array<struct<page_number:int,exception_type:string,message:string>>")).alias("errors"),
    )
    return joined.select("doc_key", F.to_json(body, {"ignoreNullFields": "false"}).alias("layout"))


def _location(at: dict) -> dict:
    names = ("type", "page_number", "bbox", "page_width", "page_height", "coordinate_origin") if at["type"] == "visual" else ("type", "source_format", "item_ref")
    return {n: at[n] for n in names}


def bundles(documents: DataFrame, pages: DataFrame, regions: DataFrame, errors: DataFrame, overlays: DataFrame | None = None) -> DataFrame:
    """One row a document with all its parts in order: what an exporter needs and no more."""
    # Regions in page order, then detector order; structural regions, without a page, first.
    where = F.coalesce(F.col("location.page_number"), F.lit(0))
    region = F.struct(where.alias("at"), "region_idx", "id", "kind", "role", "raw_label", "confidence", "location")
    parts = {
        "regions": regions.groupBy("doc_key").agg(F.array_sort(F.collect_list(region)).alias("regions")),
        "errors": errors.groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("page_number", "exception_type", "message"))).alias("errors")),
    }
    for name, table in (("pages", manifest_pages(pages, regions)), ("rendered", render_manifest_pages(pages, regions, overlays))):
        fields = [c for c in table.columns if c not in ("doc_key", "page_number")]
        parts[name] = table.groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("page_number", *fields))).alias(name))
    out = documents
    for part in parts.values():
        out = out.join(part, "doc_key", "left")
    return out


def files_of(row: dict) -> dict[str, str]:
    """The JSON files of one bundle, by name, in the order they are written: the manifest commits."""
    regions, errors, pages, rendered = (row[n] or [] for n in ("regions", "errors", "pages", "rendered"))
    layout = {
        "schema_version": row.get("schema_version") or SCHEMA_VERSION,
        "source": row["source"],
        "source_format": row["source_format"],
        "status": row["status"],
        "regions": [{n: r[n] for n in ("id", "kind", "role", "raw_label", "confidence")} | {"location": _location(r["location"])} for r in regions],
        "errors": errors,
    }
    for page in rendered:
        if page["bbox_image_name"] is None:
            del page["region_count"], page["region_ids"]
    render_manifest = {"schema_version": SCHEMA_VERSION, "source": row["source"], "dpi": int(row["dpi"]), "pages": rendered}
    manifest = {
        "manifest_version": MANIFEST_VERSION,
        "source": row["source"],
        "source_format": row["source_format"],
        "status": row["status"],
        "dpi": int(row["dpi"]),
        "layout": "layout.json",
        "page_count": len(pages),
        "region_count": len(regions),
        "error_count": len(errors),
        "pages": pages,
        "errors": errors,
    }
    ascii_sorted = lambda x: json.dumps(x, indent=2, sort_keys=True) + "\n"
    return {
        "render-manifest.json": ascii_sorted(render_manifest),
        "layout.json": json.dumps(layout, indent=2, ensure_ascii=False) + "\n",
        "manifest.json": ascii_sorted(manifest),
    }


def export(
    documents: DataFrame,
    pages: DataFrame,
    regions: DataFrame,
    errors: DataFrame,
    overlays: DataFrame,
    root: str,
    *,
    only_layout: bool = False,
    write: Callable[[str, bytes], None] = write_file,
) -> DataFrame:
    """Write each document's JSON below ``root``/doc_key; doc_key, output_dir, status, n_pages.

    ``documents`` has source, source_format, dpi and status.  Pages and overlays must be the same
    set.  ``only_layout`` leaves the manifest out, as the debug run does.  Reruns overwrite and never
    clear a folder: listings come from manifests.
    """
    for row in documents.select("dpi").distinct().take(1000):
        check_dpi(row["dpi"])
    if overlay_coverage(pages, overlays).take(1):
        raise ValueError("the overlays have to be those of the rendered pages")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for row in part.to_pylist():
                folder = f"{root}/{row['doc_key']}"
                for name, text in files_of(row).items():
                    if not (only_layout and name == "manifest.json"):
                        write(f"{folder}/{name}", text.encode())
                out.append({"doc_key": row["doc_key"], "output_dir": folder, "status": row["status"], "n_pages": len(row["pages"] or ())})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_key", pa.string()), ("output_dir", pa.string()), ("status", pa.string()), ("n_pages", pa.int32())]))

    return bundles(documents, pages, regions, errors, overlays).mapInArrow(run, "doc_key string, output_dir string, status string, n_pages int")


def checked_artifact(path: str, folder: str, exists: Callable[[str], bool] | None = None) -> str:
    """``path`` relative to ``folder``; it must exist and lie inside."""
    if not (exists or is_file)(path):
        raise FileNotFoundError(f"an artifact is missing: {path}")
    relative = posixpath.relpath(absolute(path), absolute(folder))
    if relative.split("/")[0] == "..":
        raise ValueError(f"an artifact lies outside the document's folder: {path}")
    return relative


# ---- in --------------------------------------------------------------------------------------------

FIELDS = {
    "document": ("schema_version", "source", "source_format", "status", "regions", "errors"),
    "region": ("id", "kind", "role", "raw_label", "confidence", "location"),
    "visual": ("type", "page_number", "bbox", "page_width", "page_height", "coordinate_origin"),
    "structural": ("type", "source_format", "item_ref"),
    "error": ("page_number", "exception_type", "message"),
}


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """path, body of every layout.json below ``path`` (a folder or a glob)."""
    return spark.read.option("pathGlobFilter", "layout.json").option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")
    )


def parsed(bodies: DataFrame) -> DataFrame:
    """Adds ``json``, null where the body is no JSON object."""
    found = bodies.withColumn("json", F.expr("try_parse_json(body)"))
    return found.withColumn("json", F.when(F.expr("schema_of_variant(json) LIKE 'OBJECT<%'"), F.col("json")))


def unknown_fields(docs: DataFrame, id_col: str = "path") -> DataFrame:
    """id, part, field of every key that the contract doesn't know; one pass, no shuffle.

    ``docs`` has the JSON text as ``body``.  Each level is read as a map of JSON texts, so any key shows.
    """
    keyed = lambda text: F.from_json(text, "map<string,string>")
    listed = lambda text: F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))

    def unknown(part: str, keys: Column, allowed: Column) -> Column:
        bad = F.array_except(F.coalesce(F.map_keys(keys), F.array().cast("array<string>")), allowed)
        return F.transform(bad, lambda k: F.struct(F.lit(part).alias("part"), k.alias("field")))

    names = {k: F.array(*map(F.lit, v)) for k, v in FIELDS.items()}
    arm = lambda at: F.when(at["type"] == "structural", names["structural"]).otherwise(names["visual"])
    each = lambda items, f: F.flatten(F.transform(items, f))
    level = docs.select(F.col(id_col).alias("id"), keyed(F.col("body")).alias("d"))
    level = level.select(
        "id",
        "d",
        F.transform(listed(F.col("d")["regions"]), keyed).alias("regions"),
        F.transform(listed(F.col("d")["errors"]), keyed).alias("errors"),
    )
    level = level.withColumn("locations", F.transform("regions", lambda r: keyed(r["location"])))
    found = F.concat(
        unknown("document", F.col("d"), names["document"]),
        each("regions", lambda r: unknown("region", r, names["region"])),
        each("errors", lambda e: unknown("error", e, names["error"])),
        each("locations", lambda at: unknown("location", at, arm(at))),
    )
    return level.select("id", F.explode(found).alias("f")).select("id", "f.part", "f.field")


#: A region as it is read from JSON, in one cast; numbers come as doubles.
_REGION = (
    "struct<id string, kind string, role string, raw_label string, confidence double, location struct<type string, page_number double, bbox array<double>,"
    " page_width double, page_height double, coordinate_origin string, source_format string, item_ref string>>"
)


def _get(value: str, path: str, kind: str) -> str:
    return f"try_variant_get({value}, '$.{path}', '{kind}')"


def _whole(value: str, path: str) -> str:
    """Numbers without a fraction, also from strings and booleans, as lax coercion allows."""
    number = _get(value, path, "double")
    return f"CASE WHEN {number} = floor({number}) THEN cast({number} AS int) END"


def loaded(docs: DataFrame, id_col: str = "path") -> tuple[DataFrame, DataFrame, DataFrame]:
    """documents, regions and errors of parsed layout JSON, keyed by ``id_col``; strings are stripped."""
    s = lambda e: stripped(F.expr(e))
    documents = docs.select(
        F.col(id_col).alias("doc_key"),
        F.coalesce(s(_get("json", "schema_version", "string")), F.lit(SCHEMA_VERSION)).alias("schema_version"),
        *[s(_get("json", n, "string")).alias(n) for n in ("source", "source_format", "status")],
    )
    listed = lambda n: docs.select(F.col(id_col).alias("doc_key"), F.posexplode(F.expr(_get("json", n, "array<variant>"))).alias("k", "v"))
    at = "try_variant_get(v, '$.location')"
    read = listed("regions").select("doc_key", "k", F.expr(f"try_variant_get(v, '$', '{_REGION}')").alias("r"), F.expr(f"{at} IS NOT NULL").alias("placed"))
    location = F.struct(
        F.coalesce(s("r.location.type"), F.lit("visual")).alias("type"),
        F.expr("CASE WHEN r.location.page_number = floor(r.location.page_number) THEN cast(r.location.page_number AS int) END").alias("page_number"),
        F.col("r.location.bbox").alias("bbox"),
        F.col("r.location.page_width").alias("page_width"),
        F.col("r.location.page_height").alias("page_height"),
        F.coalesce(s("r.location.coordinate_origin"), F.lit("top_left")).alias("coordinate_origin"),
        s("r.location.source_format").alias("source_format"),
        s("r.location.item_ref").alias("item_ref"),
    ).cast(LOCATION)
    regions = read.select(
        "doc_key",
        (F.col("k") + 1).alias("region_idx"),
        s("r.id").alias("id"),
        s("r.kind").alias("kind"),
        F.coalesce(s("r.role"), F.lit("body")).alias("role"),
        s("r.raw_label").alias("raw_label"),
        F.col("r.confidence").alias("confidence"),
        F.when(F.col("placed"), location).alias("location"),
    )
    errors = listed("errors").select(
        "doc_key",
        F.expr(_whole("v", "page_number")).alias("page_number"),
        s(_get("v", "exception_type", "string")).alias("exception_type"),
        F.lit(None).cast("string").alias("code"),
        s(_get("v", "message", "string")).alias("message"),
    )
    return documents, regions, errors


def violations(documents: DataFrame, regions: DataFrame, errors: DataFrame) -> DataFrame:
    """doc_key, part, name, violation: everything that breaks the contract; empty if nothing does."""
    at = F.col("location")
    visual = visual_error(at["page_number"], at["bbox"], at["page_width"], at["page_height"], at["coordinate_origin"])
    structural = structural_error(at["source_format"], at["item_ref"])
    located = F.when(at.isNull(), "location").when(at["type"] == "visual", visual).when(at["type"] == "structural", structural).otherwise("location_type")
    own = region_error(F.col("id"), F.col("kind"), F.col("role"), F.col("raw_label"), F.col("confidence"))
    bad_regions = regions.select("doc_key", F.lit("region").alias("part"), F.col("id").alias("name"), F.coalesce(own, located).alias("violation"))
    foreign = regions.where((at["type"] == "structural")).select("doc_key", "id", at["source_format"].alias("f"))
    mismatched = foreign.join(documents.select("doc_key", "source_format"), "doc_key").where(F.col("f") != F.col("source_format"))
    mismatched = mismatched.select("doc_key", F.lit("region").alias("part"), F.col("id").alias("name"), F.lit("foreign_format").alias("violation"))
    blank = lambda c: c.isNull() | (stripped(c) == "")
    failure = F.when(F.col("page_number").isNull() | (F.col("page_number") < 1), "page_number").when(blank(F.col("exception_type")), "exception_type").when(
        F.col("message").isNull(), "message"
    )
    bad_errors = errors.select("doc_key", F.lit("error").alias("part"), F.col("page_number").cast("string").alias("name"), failure.alias("violation"))
    counts = documents.join(regions.groupBy("doc_key").agg(F.count(F.lit(1)).alias("nr")), "doc_key", "left").join(
        errors.groupBy("doc_key").agg(F.count(F.lit(1)).alias("ne")), "doc_key", "left"
    )
    whole = document_error(*[F.col(c) for c in ("schema_version", "source", "source_format", "status")], F.coalesce("nr", F.lit(0)), F.coalesce("ne", F.lit(0)))
    bad_documents = counts.select("doc_key", F.lit("document").alias("part"), F.col("source").alias("name"), whole.alias("violation"))
    every = bad_documents.unionAll(bad_regions).unionAll(bad_errors).unionAll(mismatched)
    return every.where(F.col("violation").isNotNull())
