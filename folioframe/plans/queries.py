"""The registered queries of the layout engine, and the same as SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks, geometry, labels, naming
from ..operators import detection, dispatch, manifests
from ..sources import contract_io
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {name: PRELUDE + sql for name, sql in _sql.items()}


def _case(pairs: list[tuple[str, str]], default: str) -> str:
    return "case " + " ".join(f"when {a} then {b}" for a, b in pairs) + f" else {default} end"


_KEY = r"lower(regexp_replace(label, '^\s+|\s+$', '', 'g'))"
_KIND = _case([(f"{_KEY} = '{n}'", f"'{kind}'") for (kind, _), names in labels.LABELS.items() for n in names], "'other'")
_ROLE = _case([(f"{_KEY} = '{n}'", f"'{role}'") for (_, role), names in labels.LABELS.items() for n in names], "'body'")
_CX0, _CX1 = (f"least(greatest({v}, 0.0::double), page_width::double)" for v in ("x0", "x1"))
_CY0, _CY1 = (f"least(greatest({v}, 0.0::double), page_height::double)" for v in ("y0", "y1"))
_TYPE = _case([(f"code = '{c}'", "'" + t[0] + "'") for c, t in geometry.ERROR_CODES.items()], "null")

PRELUDE = f"""
with fx_pages as ({fx.FX_PAGES.format(orders="orders")}),
fx_raw as ({fx.FX_RAW_BOXES.format(lineitem="lineitem")}),
page as (select cast(doc_id as varchar) as doc_key, doc_id, page_number, page_key, page_width, page_height, rotation_degrees,
  printf('pages/page-%04d.png', page_number) as image from fx_pages),
checked as (select p.doc_key, p.doc_id, p.page_number, b.box_idx, b.label, b.score, b.x0, b.y0, b.x1, b.y1, p.page_width, p.page_height,
  case when trim(b.label) = '' then 'label_blank' when b.score is null then 'score_missing'
    when b.x0 >= b.x1 or b.y0 >= b.y1 then 'no_area'
    when {_CX0} >= {_CX1} or {_CY0} >= {_CY1} then 'off_page'
    when b.score < 0 or b.score > 1 then 'confidence_range' end as code
  from fx_raw b join page p using (page_key) where not p.{fx.FAILED}),
outcome as (select *, min(case when code is not null then box_idx end) over (partition by doc_key, page_number) as first_bad from checked),
region as (select doc_key, page_number, box_idx as region_idx, printf('p%04d-r%04d', page_number, box_idx) as id, {_KIND} as kind, {_ROLE} as role,
  regexp_replace(label, '^\\s+|\\s+$', '', 'g') as raw_label, score as confidence, {_CX0} as x0, {_CY0} as y0, {_CX1} as x1, {_CY1} as y1, page_width, page_height
  from outcome where first_bad is null),
failure as (select doc_key, page_number, code, {_TYPE} as exception_type from (
  select doc_key, page_number, code from outcome where box_idx = first_bad
  union all select doc_key, page_number, 'init_failure' from page where {fx.FAILED})),
document as (select cast(c_custkey as varchar) as doc_key, c_custkey as doc_id from customer),
counted as (select d.doc_key, coalesce(p.n, 0)::bigint as page_count, coalesce(r.n, 0)::bigint as region_count, coalesce(e.n, 0)::bigint as error_count
  from document d left join (select doc_key, count(*) n from page group by 1) p using (doc_key)
  left join (select doc_key, count(*) n from region group by 1) r using (doc_key)
  left join (select doc_key, count(*) n from failure group by 1) e using (doc_key)),
by_page as (select doc_key, page_number, count(*)::int as region_count, string_agg(id, ',' order by region_idx) as region_ids from region group by 1, 2),
source as ({fx.FX_PATHS.format(documents="documents")}),
structural as ({fx.FX_STRUCTURAL.format(pages="pages")}),
overlay as (select doc_key, page_number, replace(replace(image, 'pages/', 'bbox/'), '.png', '_bbox.png') as bbox_image, page_key from page)
"""


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[fx.Fixture, detection.Resolved]:
    f = fx.fixture(spark, sf_dir)
    return f, detection.resolve(f.pages, f.raw_boxes, f.failed)


def _joined(ids: str) -> Column:
    return F.array_join(ids, ",")


def _flat(regions: DataFrame) -> DataFrame:
    box = [F.get(F.col("location.bbox"), F.lit(k)).alias(n) for k, n in enumerate(geometry.EDGES)]
    return regions.select("doc_key", F.col("location.page_number").alias("page_number"), "region_idx", "id", "kind", "role", "raw_label", "confidence", *box)


# ---- detection -------------------------------------------------------------------------------------


@query("select doc_key, page_count, region_count, error_count, case when error_count = 0 then 'complete' when region_count > 0 then 'partial' else 'failed' end as status from counted")
def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, found = _resolved(spark, sf_dir)
    return detection.document_status(f.documents, f.pages, found.regions, found.errors)


@query("select * from counted")
def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, found = _resolved(spark, sf_dir)
    return detection.document_counts(f.documents, f.pages, found.regions, found.errors)


@query(f"select label, {_KIND} as kind, {_ROLE} as role, count(*)::bigint as n from fx_raw group by 1, 2, 3")
def normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = fx.derived(spark, sf_dir, fx.FX_RAW_BOXES, lineitem="lineitem")
    return boxes.select("label", labels.kind_role(F.col("label")).alias("_k")).groupBy("label", F.col("_k.kind").alias("kind"), F.col("_k.role").alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("select doc_key, page_number, box_idx, printf('p%04d-r%04d', page_number, box_idx) as id from checked")
def region_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    live = f.pages.join(f.failed, "doc_key", "left_anti")
    return detection.checked_boxes(live, f.raw_boxes).select("doc_key", "page_number", "box_idx", naming.region_id(F.col("page_number"), F.col("box_idx")).alias("id"))


@query("select doc_key, page_number, region_idx, id, kind, role, raw_label, confidence, x0, y0, x1, y1 from region")
def region_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_resolved(spark, sf_dir)[1].regions)


@query("select doc_key, id, row_number() over (partition by doc_key order by page_number, region_idx)::int as position from region")
def region_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("doc_key").orderBy("page_number", "region_idx")
    return _flat(_resolved(spark, sf_dir)[1].regions).select("doc_key", "id", F.row_number().over(order).alias("position"))


@query("select doc_key, page_number, box_idx, score as confidence, case when score is null then 'score_missing' when score < 0 or score > 1 then 'confidence_range' end as score_code from checked")
def confidence_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    live = f.pages.join(f.failed, "doc_key", "left_anti").select("doc_key", "page_number")
    code = F.when(F.col("score_error").isNotNull(), F.concat(F.lit("score_"), "score_error")).when(~F.col("score").between(0.0, 1.0), "confidence_range")
    return f.raw_boxes.join(live, ["doc_key", "page_number"]).select("doc_key", "page_number", "box_idx", F.col("score").alias("confidence"), code.alias("score_code"))


@query(f"select doc_key, page_number, box_idx, {_CX0} as x0, {_CY0} as y0, {_CX1} as x1, {_CY1} as y1, coalesce(code, '') as code from checked")
def clamp_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    checked = detection.checked_boxes(f.pages.join(f.failed, "doc_key", "left_anti"), f.raw_boxes)
    held = geometry.clamped_box(*(F.col(e) for e in geometry.EDGES), F.col("page_width"), F.col("page_height"))
    return checked.select("doc_key", "page_number", "box_idx", *[v.alias(k) for k, v in held.items()], F.coalesce("code", F.lit("")).alias("code"))


@query("select doc_key, page_number, code, exception_type from failure")
def page_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)[1].errors.select("doc_key", "page_number", "code", "exception_type")


@query("select doc_key, page_number, code, exception_type from failure where code = 'init_failure'")
def init_failure_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    return detection.init_errors(f.pages, f.failed).select("doc_key", "page_number", "code", "exception_type")


@query("select doc_key, page_number, page_width, page_height, rotation_degrees, image from page")
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fixture(spark, sf_dir).pages.select("doc_key", "page_number", "page_width", "page_height", "rotation_degrees", "image")


@query("select page.doc_key, page.page_number, box_idx, label, score, x0, y0, x1, y1 from fx_raw join page using (page_key)")
def raw_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fixture(spark, sf_dir).raw_boxes.select("doc_key", "page_number", "box_idx", "label", "score", *geometry.EDGES)


# ---- manifests -------------------------------------------------------------------------------------


@query("select doc_key, page_number, region_ids, region_count from by_page")
def region_ids_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.region_ids_by_page(_resolved(spark, sf_dir)[1].regions).withColumn("region_ids", _joined("region_ids"))


_MANIFEST = """select p.doc_key, p.page_number, rotation_degrees, page_width as pixel_width, page_height as pixel_height, image, o.bbox_image,
  coalesce(region_count, 0)::int as region_count, coalesce(region_ids, '') as region_ids
  from page p join overlay o using (doc_key, page_number) left join by_page using (doc_key, page_number)"""


@query(_MANIFEST)
def manifest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, found = _resolved(spark, sf_dir)
    return manifests.manifest_pages(f.pages, found.regions).withColumn("region_ids", _joined("region_ids"))


def _overlays(spark: SparkSession, sf_dir: str, f: fx.Fixture) -> DataFrame:
    """As if every 50th page's overlay were missing."""
    there = fx.derived(spark, sf_dir, fx.FX_PAGES, orders="orders").where("page_key % 50 <> 0").select(F.col("doc_id").cast("string").alias("doc_key"), "page_number")
    return f.pages.join(there, ["doc_key", "page_number"]).select("doc_key", "page_number", naming.overlay_image(F.col("image")).alias("bbox_image"))


@query("""select p.doc_key, p.page_number, rotation_degrees, page_width as pixel_width, page_height as pixel_height, image as image_name, o.bbox_image as bbox_image_name,
  case when o.bbox_image is not null then coalesce(region_count, 0)::int end as region_count, case when o.bbox_image is not null then coalesce(region_ids, '') end as region_ids
  from page p left join (select * from overlay where page_key % 50 <> 0) o using (doc_key, page_number) left join by_page using (doc_key, page_number)""")
def render_manifest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, found = _resolved(spark, sf_dir)
    return manifests.render_manifest_pages(f.pages, found.regions, _overlays(spark, sf_dir, f)).withColumn("region_ids", _joined("region_ids"))


@query("select doc_key, page_number, 'overlay' as missing from overlay where page_key % 50 = 0")
def overlay_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    return manifests.overlay_coverage(f.pages, _overlays(spark, sf_dir, f))


def _overlay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved images are taken to be 3/8 the declared size, so that halves occur."""
    f, found = _resolved(spark, sf_dir)
    sized = f.pages.withColumns({"image_width": F.floor(F.col("page_width") * 3 / 8).cast("int"), "image_height": F.floor(F.col("page_height") * 3 / 8).cast("int")})
    return manifests.overlay_boxes(sized, found.regions, 200, ("image_width", "image_height"))


_SCALED = [f"round_even({v} * (floor(page_{s} * 3 / 8)::int::double / page_{s}::double), 0)::int as {v}" for v, s in (("x0", "width"), ("y0", "height"), ("x1", "width"), ("y1", "height"))]


@query(f"select doc_key, page_number, id, {', '.join(_SCALED)} from region union all select doc_key, page_number, null, null, null, null, null from page p where not exists (select 1 from region r where r.doc_key = p.doc_key and r.page_number = p.page_number)")
def overlay_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlay_rows(spark, sf_dir).select("doc_key", "page_number", "id", *geometry.EDGES)


_RGB = _case([(f"kind = '{k}'", f"'{r},{g},{b}'") for k, (r, g, b) in manifests.COLORS.items()], "null")


@query(f"select doc_key, id, {_RGB} as color, 2::int as line_width, concat(kind, ':', id) as caption from region")
def overlay_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlay_rows(spark, sf_dir).where("id is not null").select("doc_key", "id", F.array_join(F.col("color").cast("array<string>"), ",").alias("color"), "line_width", "caption")


@query("select doc_key, page_number, image, bbox_image from page join overlay using (doc_key, page_number)")
def artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    return f.pages.select("doc_key", "page_number", naming.page_image("pages", F.col("page_number")).alias("image"), naming.overlay_image(F.col("image")).alias("bbox_image"))


@query("select o_orderkey, (72 + o_orderkey % 300)::int as dpi, (72 + o_orderkey % 300)::double / 72.0::double as scale, greatest(2, (72 + o_orderkey % 300) // 80)::int as line_width from orders")
def render_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    dpi = (F.lit(72) + F.col("o_orderkey") % 300).cast("int")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", dpi.alias("dpi"), geometry.render_scale(dpi).alias("scale"), geometry.outline_width(dpi).alias("line_width"))


# ---- names and dispatch ----------------------------------------------------------------------------

_FORMAT = "case when lower(source) like '%.pdf' then 'pdf' when lower(source) like '%.docx' then 'docx' end"


@query(f"select doc_id, source, {_FORMAT} as source_format, coalesce({_FORMAT} = 'pdf', false) as is_pdf from source")
def detect_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fx.derived(spark, sf_dir, fx.FX_PATHS, documents="documents")
    found = naming.detect_format(F.col("source"))
    return paths.select("doc_id", "source", found.alias("source_format"), F.coalesce(found == "pdf", F.lit(False)).alias("is_pdf"))


@query(f"""select doc_id, source_format, case when source_format = 'pdf' then 'pdf_a' end as extractor, case when source_format is null then 'format'
  when source_format = 'docx' then 'several' else 'none' end as problem from (select doc_id, {_FORMAT} as source_format from source)""")
def extractor_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fx.derived(spark, sf_dir, fx.FX_PATHS, documents="documents")
    registry = spark.createDataFrame([("pdf_a", "pdf"), ("docx_a", "docx"), ("docx_b", "docx")], "extractor string, document_format string")
    error = F.col("dispatch_error")
    problem = F.when(error.isNull(), "none").when(error.startswith("several"), "several").when(error.startswith("no layout format"), "format").otherwise("unregistered")
    return dispatch.dispatch(paths, registry).select("doc_id", "source_format", "extractor", problem.alias("problem"))


_NAMED = "concat('/in/ Ab(c)–', source)"
_STEM = r"case when regexp_matches(parse_filename(p), '^.+\.[^.]+$') then regexp_extract(parse_filename(p), '^(.+)\.[^.]+$', 1) else parse_filename(p) end"
_SLUG = rf"coalesce(nullif(trim(regexp_replace({_STEM}, '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''), 'document')"


@query(f"select doc_id, {_SLUG} as slug from (select doc_id, {_NAMED} as p from source)")
def document_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fx.derived(spark, sf_dir, fx.FX_PATHS, documents="documents")
    return paths.select("doc_id", naming.slug(F.concat(F.lit("/in/ Ab(c)–"), "source")).alias("slug"))


@query(f"select doc_id, concat({_SLUG}, '-', substr(sha256(lower(p)), 1, 12)) as doc_key from (select doc_id, concat('/in/', source) as p from source)")
def document_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fx.derived(spark, sf_dir, fx.FX_PATHS, documents="documents")
    return paths.select("doc_id", naming.document_key(F.concat(F.lit("/in/"), "source")).alias("doc_key"))


_DIR = "case cast(doc_id % 7 as int) when 0 then 'pages' when 1 then '../out' when 2 then '/abs' when 3 then 'BBOX/a' when 4 then 'a/b' when 5 then '' else 'a/../b' end"


@query(f"select doc_id, d as image_dir, case when d in ('../out', '/abs', '', 'a/../b') then 'not_relative' when d = 'BBOX/a' then 'reserved' end as problem from (select doc_id, {_DIR} as d from documents)")
def image_dir_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fx.table(spark, sf_dir, "documents").select("doc_id", F.expr(_DIR).alias("image_dir"))
    return named.withColumn("problem", naming.image_dir_error(F.col("image_dir")))


# ---- contract checks -------------------------------------------------------------------------------


@query("""select doc_key, page_number, box_idx, case when x0 < 0 or y0 < 0 then 'bbox_negative' when x0 >= x1 or y0 >= y1 then 'bbox_no_area'
  when x1 > page_width or y1 > page_height then 'bbox_off_page' end as violation from checked""")
def validate_visual(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.fixture(spark, sf_dir)
    boxes = detection.checked_boxes(f.pages.join(f.failed, "doc_key", "left_anti"), f.raw_boxes)
    size = [F.col(c).cast("double") for c in ("page_width", "page_height")]
    found = checks.visual_error(F.col("page_number"), F.array(*geometry.EDGES), *size, F.lit("top_left"))
    return boxes.select("doc_key", "page_number", "box_idx", found.alias("violation"))


@query("select doc_id, item_ref, case when source_format not in ('pdf', 'docx') then 'source_format' when trim(item_ref) = '' then 'item_ref' end as violation from structural")
def validate_structural(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.derived(spark, sf_dir, fx.FX_STRUCTURAL, pages="pages")
    return rows.select("doc_id", "item_ref", checks.structural_error(F.col("source_format"), F.col("item_ref")).alias("violation"))


@query(f"""select page.doc_key, page.page_number, box_idx, case when trim(label) = '' then 'raw_label' when score < 0 or score > 1 then 'confidence' end as violation
  from fx_raw join page using (page_key)""")
def validate_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = fx.fixture(spark, sf_dir).raw_boxes
    kind = labels.kind_role(F.col("label"))
    found = checks.region_error(naming.region_id(F.col("page_number"), F.col("box_idx")), kind["kind"], kind["role"], F.col("label"), F.col("score"))
    return boxes.select("doc_key", "page_number", "box_idx", found.alias("violation"))


@query("""select doc_key, case when status <> 'complete' and error_count = 0 or status <> 'partial' and error_count > 0 and region_count > 0
  or status <> 'failed' and error_count > 0 and region_count = 0 then 'status_mismatch' end as violation
  from (select *, case cast(doc_key as bigint) % 3 when 0 then 'complete' when 1 then 'partial' else 'failed' end as status from counted)""")
def validate_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, found = _resolved(spark, sf_dir)
    counts = detection.document_counts(f.documents, f.pages, found.regions, found.errors)
    stated = F.expr("case cast(doc_key as bigint) % 3 when 0 then 'complete' when 1 then 'partial' else 'failed' end")
    bad = checks.document_error(F.lit("1.0"), F.concat(F.lit("/data/"), "doc_key"), F.lit("pdf"), stated, F.col("region_count"), F.col("error_count"))
    return counts.select("doc_key", bad.alias("violation"))


@query("select cast(doc_id as varchar) as doc_key, item_ref as id, source_format as region_format, document_format as source_format from structural where source_format <> document_format")
def structural_format_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.derived(spark, sf_dir, fx.FX_STRUCTURAL, pages="pages").withColumn("doc_key", F.col("doc_id").cast("string"))
    documents = rows.select("doc_key", F.col("document_format").alias("source_format"))
    regions = rows.select("doc_key", F.col("item_ref").alias("id"), F.struct(F.lit("structural").alias("type"), "source_format").alias("location"))
    return dispatch.structural_format_mismatches(documents, regions)


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout JSON of every document of the fixture."""
    f = fx.fixture(spark, sf_dir)
    found = detection.resolve(f.pages, f.raw_boxes, f.failed, keep=True)
    status = detection.document_status(f.documents, f.pages, found.regions, found.errors).select("doc_key", "status")
    documents = f.documents.join(status, "doc_key").withColumn("schema_version", F.lit("1.0"))
    return contract_io.layout_json(documents, found.regions, found.errors).withColumnRenamed("layout", "body")


@query("""select 'document' as part, 'extra' as field, count(*)::bigint as n from document where doc_id % 5 = 0
  union all select 'region', 'note', count(*)::bigint from region where cast(doc_key as bigint) % 7 = 0""")
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 5th document gets a field of its own, and the regions of every 7th get one each."""
    number = F.col("doc_key").cast("long")
    body = F.when(number % 5 == 0, F.regexp_replace("body", r"^\{", '{"extra":1,')).otherwise(F.col("body"))
    body = F.when(number % 7 == 0, F.regexp_replace(body, r'\{"id":', '{"note":null,"id":')).otherwise(body)
    found = contract_io.unknown_fields(_bodies(spark, sf_dir).withColumn("body", body), "doc_key")
    return found.groupBy("part", "field").agg(F.count(F.lit(1)).alias("n"))


@query("select doc_key, page_number, id, kind, role, raw_label, confidence, x0, y0, x1, y1 from region")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions written as JSON and loaded again."""
    _, regions, _ = contract_io.loaded(contract_io.parsed(_bodies(spark, sf_dir)), "doc_key")
    return _flat(regions).drop("region_idx")
