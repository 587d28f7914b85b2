"""Whole runs with injected renderers and detectors, files included."""

import json
import os

import numpy as np
import pytest
from folioframe.plans import cli, pipeline
from folioframe.sources import contract_io, files, overlay, png

from tests.test_layout_detection import Factory, Result, box


def two_pages(path, scale):
    assert scale == 200 / 72
    for _ in range(2):
        yield np.full((120, 100, 3), 255, np.uint8), 90


class AnyPage:
    def predict(self, image, *, batch_size):
        assert png.decode(open(image, "rb").read()).shape == (120, 100, 3)
        yield Result({"res": {"boxes": [box("table", 0.9, 10, 20, 40, 50)]}})


def any_page(*, model_name, device):
    assert device == "cpu"
    return AnyPage()


def source(tmp_path, name="quarterly report.pdf"):
    path = tmp_path / name
    path.write_bytes(b"%PDF")
    return str(path)


def test_pipeline(spark, tmp_path):
    out = tmp_path / "out"
    a = pipeline.run_pdf_layout(spark, source(tmp_path), output_dir=str(out), image_dir="source_pages", factory=any_page, opener=two_pages)
    assert a.status == "complete" and os.path.basename(a.output_dir).startswith("quarterly_report-")
    assert [os.path.relpath(p, a.output_dir) for p in a.page_images] == ["source_pages/page-0001.png", "source_pages/page-0002.png"]
    manifest = json.load(open(a.manifest_path))
    assert (manifest["page_count"], manifest["region_count"], manifest["dpi"], manifest["manifest_version"]) == (2, 2, 200, "1.0")
    page = manifest["pages"][0]
    assert page["image"] == "source_pages/page-0001.png" and page["bbox_image"] == "bbox/page-0001_bbox.png"
    assert (page["region_ids"], page["rotation_degrees"], page["pixel_width"]) == (["p0001-r0001"], 90, 100)
    layout = json.load(open(a.layout_path))
    assert list(layout) == ["schema_version", "source", "source_format", "status", "regions", "errors"]
    assert layout["regions"][0]["location"]["bbox"] == [10.0, 20.0, 40.0, 50.0]
    assert json.load(open(f"{a.output_dir}/render-manifest.json"))["pages"][1]["region_ids"] == ["p0002-r0001"]
    loaded = contract_io.loaded(contract_io.parsed(contract_io.read_layouts(spark, str(out))))
    assert contract_io.violations(*loaded).collect() == []
    assert [r["id"] for r in loaded[1].orderBy("region_idx").collect()] == ["p0001-r0001", "p0002-r0001"]
    assert contract_io.unknown_fields(contract_io.read_layouts(spark, str(out))).count() == 0
    picture = png.decode(open(a.bbox_images[0], "rb").read())
    assert tuple(picture[50, 40]) == (255, 48, 48) and tuple(picture[100, 80]) == (255, 255, 255)
    again = pipeline.run_pdf_layout(spark, source(tmp_path), output_dir=str(out), image_dir="source_pages", factory=any_page, opener=two_pages)
    other = pipeline.source_documents(spark, [source(tmp_path, "other.pdf")], 200).first()["doc_key"]
    assert again.output_dir == a.output_dir and other != os.path.basename(a.output_dir)


class Pixels:
    def predict(self, image, *, batch_size):
        assert image.shape == (120, 100, 3) and tuple(image[0, 0]) == (3, 2, 1)
        yield Result({"res": {"boxes": [box("table", 0.9, 10, 20, 40, 50), box("text", 0.8, 99.5, 0.4, 100, 120)]}})


def pixels(*, model_name, device):
    return Pixels()


def one_page(path, scale):
    assert files.read_file(path) == b"%PDF"
    image = np.tile(np.arange(120, dtype=np.uint8)[:, None, None], (1, 100, 3))
    image[0, 0] = (1, 2, 3)
    yield image, 0


def test_run_and_crops_by_uri(spark, tmp_path):
    """Sources and folders as URIs; the model gets pixels, and crops are cut from the clean image."""
    source(tmp_path)
    a = pipeline.run_pdf_layout(spark, f"file://{tmp_path}/quarterly report.pdf", output_dir=f"file://{tmp_path}/by uri/", factory=pixels, opener=one_page)
    local = f"{tmp_path}/by uri/{os.path.basename(a.output_dir)}"
    assert a.status == "complete" and a.output_dir.startswith("file://") and not a.output_dir.startswith(f"file://{tmp_path}/by uri//")
    assert sorted(os.listdir(local)) == ["bbox", "layout.json", "manifest.json", "pages", "render-manifest.json"]
    assert files.is_file(a.layout_path) and files.is_file(a.page_images[0]) and not files.is_file(f"{a.output_dir}/none")
    documents = pipeline.source_documents(spark, [f"file://{tmp_path}/quarterly report.pdf"], 200)
    run = pipeline.run_documents(documents, f"file://{tmp_path}/by uri", factory=pixels, opener=one_page)
    cut = {r["id"]: (r["x0"], r["y0"], png.decode(bytes(r["png"]))) for r in overlay.crops(run.pages, run.regions, f"file://{tmp_path}/by uri").collect()}
    x0, y0, table = cut["p0001-r0001"]
    assert (x0, y0, table.shape) == (10, 20, (30, 30, 3)) and [int(v) for v in table[:, 0, 0]] == list(range(20, 50))
    assert cut["p0001-r0002"][:2] == (99, 0) and cut["p0001-r0002"][2].shape == (120, 1, 3)
    assert overlay.crops(run.pages.limit(0), run.regions, "none").collect() == []


def test_failed_run_still_writes(spark, tmp_path):
    a = pipeline.run_pdf_layout(spark, source(tmp_path), output_dir=str(tmp_path / "o"), factory=Factory(error=RuntimeError("no ümlaut")), opener=two_pages)
    assert a.status == "failed" and all(map(os.path.isfile, (*a.page_images, *a.bbox_images)))
    assert "no ümlaut" in open(a.layout_path, encoding="utf-8").read()
    assert "no \\u00fcmlaut" in open(a.manifest_path, encoding="utf-8").read()


def test_debug_run_has_no_manifest(spark, tmp_path):
    path = pipeline.render_pdf_layout_debug(spark, source(tmp_path), output_dir=str(tmp_path / "d"), factory=any_page, opener=two_pages)
    assert os.path.isfile(path) and not os.path.exists(os.path.join(os.path.dirname(path), "manifest.json"))
    with pytest.raises(ValueError, match=r"requires a \.pdf source"):
        pipeline.render_pdf_layout_debug(spark, "report.docx")


def broken_pdf(path, scale):
    if "bad" in path:
        raise OSError("not a PDF")
    return two_pages(path, scale)


def test_many_documents_outlive_a_broken_one(spark, tmp_path):
    documents = pipeline.source_documents(spark, [source(tmp_path, f"{n}.pdf") for n in ("good", "bad", "fine")], 200)
    run = pipeline.run_documents(documents, str(tmp_path / "many"), factory=any_page, opener=broken_pdf)
    assert {r["status"] for r in run.exported.collect()} == {"complete"} and run.exported.count() == 2
    assert [r["exception_type"] for r in run.unrendered.collect()] == ["OSError"]


def test_checks_come_first(spark, tmp_path):
    with pytest.raises(pipeline.NotRegistered):
        pipeline.run_pdf_layout(spark, "report.docx")
    with pytest.raises(FileNotFoundError):
        pipeline.run_pdf_layout(spark, str(tmp_path / "none.pdf"))
    for options, words in (({"dpi": 0}, "positive integer"), ({"image_dir": "../outside"}, "relative subdirectory"), ({"device": " "}, "nonblank")):
        with pytest.raises(ValueError, match=words):
            pipeline.run_pdf_layout(spark, source(tmp_path), **options)


def test_extract(spark):
    give = lambda kind: lambda session, path: session.createDataFrame([(kind,)], "source_format string")
    assert pipeline.extract(spark, "a.docx", {"pdf": give("pdf"), "docx": give("docx")}).count() == 1
    with pytest.raises(pipeline.NotRegistered):
        pipeline.extract(spark, "a.pdf", {"docx": give("docx")})
    with pytest.raises(ValueError, match="several"):
        pipeline.extract(spark, "a.pdf", [("pdf", give("pdf")), ("pdf", give("pdf"))])
    with pytest.raises(ValueError, match="another source_format"):
        pipeline.extract(spark, "a.pdf", {"pdf": give("docx")})


def test_extractor_protocol(spark):
    one = pipeline.FormatExtractor("pdf", lambda session, path: session.createDataFrame([("pdf",)], "source_format string"))
    assert isinstance(one, pipeline.Extractor) and one.document_format == "pdf"
    assert [one.supports(x) for x in ("a.pdf", "/x/B.PDF", "a.docx", "a.txt", "a", "", None)] == [True, True] + [False] * 5
    assert pipeline.find_extractor("x.pdf", [one]) is one and pipeline.extract(spark, "x.pdf", [one]).count() == 1
    with pytest.raises(ValueError, match="several"):
        pipeline.extract(spark, "x.pdf", [one, one])
    with pytest.raises(ValueError, match="known format"):
        pipeline.FormatExtractor("txt", print)


def test_public_names():
    import folioframe

    assert len(folioframe.__all__) > 30 and all(getattr(folioframe, name) is not None for name in folioframe.__all__)
    assert folioframe.run_pdf_layout is pipeline.run_pdf_layout
    with pytest.raises(AttributeError):
        folioframe.nothing_of_this_name  # noqa: B018


def test_overlays_need_image_paths(spark, tmp_path):
    fields = "doc_key string, page_number int, image {}, region_idx int, id string, x0 int, y0 int, x1 int, y1 int, color array<int>, line_width int, caption string"
    row = ("d", 1, None, None, None, 0, 0, 0, 0, None, 2, None)
    with pytest.raises(TypeError, match="not as binary"):
        overlay.export(spark.createDataFrame([row], fields.format("binary")), str(tmp_path))
    with pytest.raises(Exception, match="without an image path"):
        overlay.export(spark.createDataFrame([row], fields.format("string")), str(tmp_path)).collect()


def test_dpi_option(spark, capsys):
    for bad in ("0", "-3", "x", "1.5", ""):
        with pytest.raises(SystemExit) as stop:
            cli.main(["debug", "a.pdf", "--dpi", bad], session=spark)
        assert stop.value.code == 2 and "positive integer" in capsys.readouterr().err


def test_command_line(spark, capsys):
    given = {}

    def run(session, path, **options):
        given.update(options, path=path)
        return pipeline.Artifacts("R/k", "R/k/manifest.json", "R/k/layout.json", (), (), given.pop("status", "complete"))

    cli.main(["layout", "report.pdf", "--output-dir", "R", "--image-dir", "rendered_pages", "--dpi", "300", "--device", "gpu:0"], run=run, session=spark)
    assert given == {"path": "report.pdf", "output_dir": "R", "image_dir": "rendered_pages", "dpi": 300, "device": "gpu:0"}
    shown = capsys.readouterr().out
    assert "Status: complete" in shown and "Page images (0): R/k/rendered_pages" in shown and "R/k/bbox" in shown
    given["status"] = "failed"
    with pytest.raises(SystemExit) as stop:
        cli.main(["layout", "a.pdf"], run=run, session=spark)
    assert stop.value.code == 1
    for argv in (["layout", "a.pdf", "--dpi", "0"], ["layout", "a.docx"]):
        with pytest.raises(SystemExit) as stop:
            cli.main(argv, session=spark)
        assert stop.value.code == 2
    cli.main([])
    assert "layout" in capsys.readouterr().out


def test_stream(spark, tmp_path):
    from folioframe.streaming import layout

    (tmp_path / "in").mkdir()
    source(tmp_path / "in", "one.pdf")
    source(tmp_path / "in", "two.txt")
    stream = layout.start(layout.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), factory=any_page, opener=two_pages)
    stream.awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/check-exported").collect()
    assert [(r["status"], r["n_pages"]) for r in rows] == [("complete", 2)]


def test_png_round_trip():
    image = np.random.default_rng(1).integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert (png.decode(png.encode(image)) == image).all()
    with pytest.raises(ValueError):
        png.decode(b"GIF")


def test_drawing_is_clipped():
    image = np.zeros((10, 10, 3), np.uint8)
    out = overlay.draw(image, [{"x0": 8, "y0": 8, "x1": 20, "y1": 20, "color": [1, 2, 3], "line_width": 2, "caption": "text:p1"}])
    assert out.shape == image.shape and not image.any() and out.any()
