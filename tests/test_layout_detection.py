"""Raw boxes to regions, errors and status, with injected detectors."""

import json

import pytest
from folioframe.operators import detection, dispatch, downstream, manifests
from folioframe.sources import contract_io, providers
from pyspark.sql import functions as F


class Result:
    def __init__(self, data):
        self.json = data


def box(label, score, *coordinate):
    return {"label": label, "score": score, "coordinate": list(coordinate)}


class Model:
    """``images`` maps an image to its predictions, or to an exception."""

    def __init__(self, images):
        self.images = images

    def predict(self, image, *, batch_size):
        assert batch_size == 1
        found = self.images[image]
        if isinstance(found, Exception):
            raise found
        yield from (Result(x) for x in found)


class Factory:
    def __init__(self, images=None, error=None):
        self.images, self.error = images, error

    def __call__(self, *, model_name, device):
        if self.error:
            raise self.error
        return Model(self.images)


def run(spark, pages, factory):
    rows = spark.createDataFrame([("d", n, f"{n}", w, h, 0) for n, w, h in pages], "doc_key string, page_number int, image string, page_width int, page_height int, rotation_degrees int")
    boxes = providers.detect(rows, factory).persist()
    found = detection.resolve(rows, boxes)
    documents = spark.createDataFrame([("d",)], "doc_key string")
    status = detection.document_status(documents, rows, found.regions, found.errors).first()["status"]
    regions = found.regions.orderBy("location.page_number", "region_idx").collect()
    errors = found.errors.orderBy("page_number").collect()
    boxes.unpersist()
    return status, regions, errors


def test_one_table(spark):
    status, regions, errors = run(spark, [(1, 100, 130)], Factory({"1": [{"res": {"boxes": [box(" table ", 0.91, 10, 20, 90, 120)]}}]}))
    r = regions[0]
    assert (status, errors) == ("complete", [])
    assert (r["id"], r["kind"], r["role"], r["raw_label"], r["confidence"], r["location"]["bbox"]) == ("p0001-r0001", "table", "body", "table", 0.91, [10, 20, 90, 120])


def test_a_page_that_raises(spark):
    good = [{"boxes": [box("text", 0.5, 1, 1, 5, 5)]}]
    status, regions, errors = run(spark, [(1, 9, 9), (2, 9, 9), (3, 9, 9)], Factory({"1": good, "2": RuntimeError("no luck"), "3": good}))
    assert status == "partial"
    assert [r["id"] for r in regions] == ["p0001-r0001", "p0003-r0001"]
    assert [(e["page_number"], e["exception_type"], e["message"]) for e in errors] == [(2, "RuntimeError", "no luck")]


def test_clamping_and_running_index(spark):
    predictions = [{"boxes": [box("chart", 0.8, -5, 10, 105, 80)]}, {"res": {"boxes": [box("seal", 0.7, 20, 20, 40, 40)]}}, {}]
    _, regions, _ = run(spark, [(4, 100, 90)], Factory({"4": predictions}))
    assert [(r["id"], r["kind"], r["location"]["bbox"]) for r in regions] == [("p0004-r0001", "picture", [0, 10, 100, 80]), ("p0004-r0002", "picture", [20, 20, 40, 40])]


def test_a_bad_box_drops_its_page(spark):
    good = box("text", 0.5, 1, 1, 5, 5)
    images = {"1": [{"boxes": [good]}], "2": [{"boxes": [good, {"label": "text", "score": 0.5, "coordinate": [1, 2, 3]}]}], "3": [{"boxes": [good]}]}
    status, regions, errors = run(spark, [(1, 100, 130), (2, 100, 130), (3, 100, 130)], Factory(images))
    assert status == "partial"
    assert [r["id"] for r in regions] == ["p0001-r0001", "p0003-r0001"]
    assert "four coordinates" in errors[0]["message"]


@pytest.mark.parametrize(
    ("bad", "code"),
    [
        (7, "box_not_mapping"),
        (box(" ", 0.5, 1, 1, 2, 2), "label_blank"),
        (box("text", "x", 1, 1, 2, 2), "score_value"),
        ({"label": "text", "coordinate": "x"}, "score_missing"),
        (box("text", 0.5, 1, 1, float("nan"), 2), "coord_not_finite"),
        (box("text", 0.5, 5, 1, 2, 2), "no_area"),
        (box("text", 0.5, 100, 0, 120, 10), "off_page"),
        (box("text", 0.5, -10, 0, 0, 10), "off_page"),
        (box("text", 1.5, 1, 1, 2, 2), "confidence_range"),
        (box("text", float("nan"), 1, 1, 2, 2), "confidence_range"),
        (box("text", 0.5, 0, 0, 100, 100), None),
    ],
)
def test_codes(spark, bad, code):
    status, _, errors = run(spark, [(1, 100, 100)], Factory({"1": [{"boxes": [bad]}]}))
    assert [e["code"] for e in errors] == ([code] if code else [])
    assert status == ("failed" if code else "complete")


def test_bad_page_size(spark):
    _, _, errors = run(spark, [(1, 0, 100)], Factory({"1": [{"boxes": [box("text", 0.5, 1, 1, 2, 2)]}]}))
    assert errors[0]["code"] == "page_size"


def test_model_failure_and_empty_documents(spark):
    status, regions, errors = run(spark, [(1, 9, 9), (2, 9, 9)], Factory(error=RuntimeError("no model")))
    assert (status, regions, [e["page_number"] for e in errors]) == ("failed", [], [1, 2])
    assert run(spark, [], Factory(error=RuntimeError("never made"))) == ("complete", [], [])


def test_an_error_and_an_empty_page_fail(spark):
    assert run(spark, [(1, 9, 9), (2, 9, 9)], Factory({"1": [], "2": ValueError("x")}))[0] == "failed"


def test_dispatch(spark):
    paths = spark.createDataFrame([("report.docx",), ("report.pdf",), ("x.xml",)], "source string")
    extractors = spark.createDataFrame([("p", "pdf"), ("d", "docx")], "extractor string, document_format string")
    found = {r["source"]: (r["extractor"], r["dispatch_error"]) for r in dispatch.dispatch(paths, extractors).collect()}
    assert found["report.docx"] == ("d", None)
    assert found["x.xml"][0] is None and ".pdf, .docx" in found["x.xml"][1]
    none = dispatch.dispatch(paths, extractors.where("document_format = 'docx'")).where("source = 'report.pdf'").first()
    assert "registered" in none["dispatch_error"]
    results = spark.createDataFrame([("p", "docx"), ("d", "docx")], "extractor string, source_format string")
    assert [r["extractor"] for r in dispatch.format_mismatches(results, extractors).collect()] == ["p"]


DOCUMENT = {
    "schema_version": "1.0",
    "source": " a.docx ",
    "source_format": "docx",
    "status": "complete",
    "regions": [
        {"id": "t1", "kind": "table", "raw_label": "table", "confidence": None, "location": {"type": "structural", "source_format": "docx", "item_ref": "#/tables/0"}},
        {"id": "p1", "kind": "text", "role": "title", "raw_label": "title", "confidence": 0.5, "location": {"type": "visual", "page_number": "1", "bbox": [10, 20, 90, 120], "page_width": 100, "page_height": 130}},
    ],
    "errors": [],
}


def load(spark, *documents):
    bodies = spark.createDataFrame([(str(k), json.dumps(d)) for k, d in enumerate(documents)], "path string, body string")
    return contract_io.loaded(contract_io.parsed(bodies))


def broken(spark, change):
    document = json.loads(json.dumps(DOCUMENT))
    change(document)
    return {r["violation"] for r in contract_io.violations(*load(spark, document)).collect()}


def test_a_valid_document_loads(spark):
    documents, regions, errors = load(spark, DOCUMENT)
    assert contract_io.violations(documents, regions, errors).collect() == []
    assert documents.first()["source"] == "a.docx"
    rows = regions.orderBy("region_idx").collect()
    assert rows[0]["location"]["item_ref"] == "#/tables/0" and rows[0]["confidence"] is None
    assert rows[1]["location"]["page_number"] == 1 and rows[1]["location"]["coordinate_origin"] == "top_left"


@pytest.mark.parametrize(
    ("change", "violation"),
    [
        (lambda d: d["regions"][1]["location"].update(bbox=[10, 20, 10, 120]), "bbox_no_area"),
        (lambda d: d["regions"][1]["location"].update(bbox=[10, 20, 90, 120, 130]), "bbox_count"),
        (lambda d: d["regions"][1]["location"].update(bbox=[-1, 20, 90, 120]), "bbox_negative"),
        (lambda d: d["regions"][1]["location"].update(bbox=[10, 20, 101, 120]), "bbox_off_page"),
        (lambda d: d["regions"][1]["location"].update(page_number=2.5), "page_number"),
        (lambda d: d["regions"][0]["location"].update(item_ref=" "), "item_ref"),
        (lambda d: d["regions"][0]["location"].update(source_format="pdf"), "foreign_format"),
        (lambda d: d["regions"][0].update(confidence=2), "confidence"),
        (lambda d: d["regions"][0].update(kind="chart"), "kind"),
        (lambda d: d.update(schema_version="1"), "schema_version"),
        (lambda d: d.update(status="partial"), "status_mismatch"),
        (lambda d: d.update(errors=[{"page_number": 0, "exception_type": "E", "message": ""}], status="partial"), "page_number"),
    ],
)
def test_violations(spark, change, violation):
    assert broken(spark, change) == {violation}


def test_unknown_fields(spark):
    document = json.loads(json.dumps(DOCUMENT))
    document["more"] = 1
    document["regions"][1]["location"]["item_ref"] = "x"
    bodies = spark.createDataFrame([("0", json.dumps(document))], "path string, body string")
    found = contract_io.unknown_fields(bodies).collect()
    assert {(r["part"], r["field"]) for r in found} == {("document", "more"), ("location", "item_ref")}


def test_layout_json_keeps_one_arm_and_the_null(spark):
    documents, regions, errors = load(spark, DOCUMENT)
    text = contract_io.layout_json(documents, regions, errors).first()["layout"]
    back = json.loads(text)
    by_id = {r["id"]: r for r in back["regions"]}
    assert by_id["t1"]["confidence"] is None
    assert by_id["t1"]["location"] == {"type": "structural", "source_format": "docx", "item_ref": "#/tables/0"}
    assert set(by_id["p1"]["location"]) == set(contract_io.FIELDS["visual"])


def test_downstream(spark):
    _, regions, _ = load(spark, DOCUMENT)
    ocr = spark.createDataFrame([("0", 1, 80.0, 100.0, 95.0, 125.0, "a"), ("0", 1, 90.0, 0.0, 99.0, 9.0, "b")], "doc_key string, page_number int, x0 double, y0 double, x1 double, y1 double, word string")
    assert [(r["word"], r["region_id"], r["overlap"]) for r in downstream.associate(regions, ocr).collect()] == [("a", "p1", 200.0)]
    crop = spark.createDataFrame([("0", 1, "p1", 1.0, 2.0, 3.0, 4.0)], "doc_key string, page_number int, id string, x0 double, y0 double, x1 double, y1 double")
    moved = downstream.from_crop(crop, regions).first()
    assert (moved["x0"], moved["y0"], moved["x1"], moved["y1"]) == (11, 22, 13, 24)
    pages = spark.createDataFrame([("0", 1, 300)], "doc_key string, page_number int, page_height int")
    flipped = downstream.from_points(crop, pages, 144, bottom_left=True).first()
    assert (flipped["x0"], flipped["y0"], flipped["y1"]) == (2, 292, 296)
    assert downstream.tables(regions).count() == 0
    assert downstream.attach(regions, crop.select("doc_key", "page_number", "id", F.lit("t").alias("t"))).first()["t"] == "t"


def test_box_rows_are_shuffled_once(spark):
    from folioframe.plans import fixtures

    f = fixtures.fixture(spark, "/root/testdata/sf0.001")
    boxes = spark.createDataFrame(f.raw_boxes.limit(500).collect(), f.raw_boxes.schema)
    outcome = detection.with_page_outcome(boxes.where("box_idx is not null").withColumns({"page_width": F.lit(900), "page_height": F.lit(900), "code": F.lit(None).cast("string")}))
    plan = detection.good_regions(outcome)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Pandas" not in plan


def test_manifest_counts_regions_of_known_pages_only(spark):
    _, regions, _ = load(spark, DOCUMENT)
    pages = spark.createDataFrame([("0", 2, "pages/page-0002.png", 9, 9, 0)], "doc_key string, page_number int, image string, page_width int, page_height int, rotation_degrees int")
    row = manifests.manifest_pages(pages, regions).first()
    assert (row["region_count"], row["region_ids"], row["bbox_image"]) == (0, [], "bbox/page-0002_bbox.png")


class Stopping(Model):
    """Gives its predictions, then raises."""

    def predict(self, image, *, batch_size):
        yield from super().predict(image, batch_size=batch_size)
        raise RuntimeError(" stopped ")


@pytest.mark.parametrize(
    ("boxes", "error"),
    [
        ([box("text", 0.5, 60, 20, 10, 120)], ("ValueError", "a bounding box needs a positive width and height")),
        ([box("text", 0.5, 1, 2, 3, 4), box("text", 0.5, 500, 20, 600, 120)], ("ValueError", "the bounding box lies outside the page")),
        ([box("text", 1.5, 1, 2, 3, 4)], ("ValidationError", "the confidence has to lie between 0 and 1")),
        ([box(" ", 0.5, 1, 2, 3, 4)], ("ValueError", "a detector box needs a label that is a nonblank string")),
        ([box("text", 0.5, 1, 2, 3, 4)], ("RuntimeError", "stopped")),
        ([], ("RuntimeError", "stopped")),
    ],
)
def test_the_first_error_counts(spark, boxes, error):
    """A detector that raises later doesn't hide a bad box before it."""
    factory = lambda *, model_name, device: Stopping({"1": [{"boxes": [b]} for b in boxes]})
    status, regions, errors = run(spark, [(1, 100, 130)], factory)
    assert (status, regions) == ("failed", []) and [(e["exception_type"], e["message"]) for e in errors] == [error]


def test_kept_boxes_give_the_same(spark):
    rows = spark.createDataFrame([("d", n, f"{n}", 100, 130, 0) for n in (1, 2)], "doc_key string, page_number int, image string, page_width int, page_height int, rotation_degrees int")
    boxes = providers.detect(rows, Factory({"1": [{"boxes": [box("text", 0.5, 1, 2, 3, 4)]}], "2": [{"boxes": [box("text", 0.5, 1, 2, 3, 4), {}]}]}))
    once, kept = detection.resolve(rows, boxes), detection.resolve(rows, boxes, keep=True)
    assert once.regions.collect() == kept.regions.collect() and once.errors.collect() == kept.errors.collect()
    assert "Window" not in kept.regions._jdf.queryExecution().optimizedPlan().toString()
