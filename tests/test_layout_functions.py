"""Scalar functions against plain Python and hand-made vectors."""

import math

import pytest
from folioframe.functions import geometry, labels, naming
from folioframe.schemas import COLORS
from folioframe.sources.providers import decode_box
from pyspark.sql import functions as F


def column(spark, values, kind, f):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.orderBy("k").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("label", "kind", "role"),
    [
        ("text", "text", "body"),
        ("table", "table", "body"),
        ("image", "picture", "body"),
        ("chart", "picture", "body"),
        ("header", "text", "header"),
        ("footer", "text", "footer"),
        ("page_number", "text", "page_number"),
        ("paragraph_title", "text", "title"),
        ("unrecognized_label", "other", "body"),
        (" Table ", "table", "body"),
        ("\x1ctext", "text", "body"),
    ],
)
def test_label(spark, label, kind, role):
    assert [tuple(r) for r in column(spark, [label], "string", labels.kind_role)] == [(kind, role)]


def test_all_labels_are_known(spark):
    names = [n for group in labels.LABELS.values() for n in group]
    assert len(names) == 23
    assert [tuple(r) for r in column(spark, names, "string", labels.kind_role)] == [k for k, group in labels.LABELS.items() for _ in group]


def test_stored_strings_keep_separators(spark):
    assert column(spark, [" a ", "\x1ca "], "string", labels.stripped) == ["a", "\x1ca"]


def test_formats_follow_the_last_extension(spark):
    paths = ["report.PDF", "report.DOCX", "report.xml", ".pdf", "report.", "..pdf", "a.tar.PDF", "/x.pdf/name", "a.pdf/"]
    assert column(spark, paths, "string", naming.detect_format) == ["pdf", "docx", None, None, None, "pdf", "pdf", None, "pdf"]
    for path, found in zip(paths, column(spark, paths, "string", naming.detect_format), strict=True):
        if found:
            assert naming.detect_document_format(path) == found
        else:
            with pytest.raises(naming.UnsupportedFormat, match=r"\.pdf, \.docx"):
                naming.detect_document_format(path)


def test_slugs_and_keys(spark):
    paths = ["/a/quarterly report.pdf", "/a/...pdf", "/a/ß.pdf", "/a/b c/Über_x.pdf", "/a/.pdf", "/a/report."]
    assert column(spark, paths, "string", naming.slug) == ["quarterly_report", "document", "document", "ber_x", "pdf", "report"]
    assert column(spark, paths, "string", naming.document_key) == [naming.document_key_of(p) for p in paths]
    assert naming.document_key_of("/a/STRASSE.pdf")[-12:] == naming.document_key_of("/a/straße.pdf")[-12:]


def test_region_ids_widen(spark):
    rows = spark.createDataFrame([(1, 1), (10000, 12345)], "p int, r int")
    assert [r[0] for r in rows.select(naming.region_id(F.col("p"), F.col("r"))).collect()] == ["p0001-r0001", "p10000-r12345"]


def test_overlay_coordinates_round_half_to_even(spark):
    rows = spark.createDataFrame([(5.0, 1, 2), (3.0, 1, 2), (7.0, 1, 2)], "x double, image int, page int")
    assert [r[0] for r in rows.select(geometry.scaled(F.col("x"), F.col("image"), F.col("page"))).collect()] == [2, 2, 4]


def test_outline_and_scale(spark):
    assert column(spark, [72, 200, 300, 400], "int", geometry.outline_width) == [2, 2, 3, 5]
    assert column(spark, [300], "int", geometry.render_scale) == [300 / 72]
    assert COLORS["table"] == (255, 48, 48)


@pytest.mark.parametrize(("folder", "problem"), [("pages", None), ("a/b", None), ("../x", "not_relative"), ("/x", "not_relative"), ("", "not_relative"), ("BBox/a", "reserved")])
def test_image_dir(spark, folder, problem):
    assert column(spark, [folder], "string", naming.image_dir_error) == [problem]
    if problem:
        with pytest.raises(ValueError):
            naming.check_image_dir(folder)
    else:
        assert naming.check_image_dir(folder) == folder


@pytest.mark.parametrize("dpi", [0, -1, True, 2.0, "200", None])
def test_bad_dpi(dpi):
    with pytest.raises(ValueError):
        naming.check_dpi(dpi)


def test_device():
    assert naming.check_device(" gpu:0 ") == "gpu:0"
    for bad in ("", "  ", None):
        with pytest.raises(ValueError):
            naming.check_device(bad)


GOOD = {"label": "text", "score": 0.5, "coordinate": [1, 2, 3, 4]}


@pytest.mark.parametrize(
    ("box", "want"),
    [
        (GOOD, {"is_mapping": True, "label_ok": True, "score": 0.5, "x0": 1.0, "y1": 4.0}),
        ("box", {"is_mapping": False}),
        (GOOD | {"label": 3}, {"label_ok": False}),
        (GOOD | {"label": " \x1c"}, {"label_ok": False}),
        (GOOD | {"score": True}, {"score": 1.0, "score_error": None}),
        (GOOD | {"score": "0.5"}, {"score": 0.5, "score_error": None}),
        (GOOD | {"score": "x"}, {"score_error": "value"}),
        (GOOD | {"score": None}, {"score_error": "type"}),
        ({"label": "text"}, {"score_error": "missing", "coord_error": "count"}),
        (GOOD | {"coordinate": "1234"}, {"coord_error": "count"}),
        (GOOD | {"coordinate": [1, 2, 3]}, {"coord_error": "count"}),
        (GOOD | {"coordinate": [True, 2, 3, 4]}, {"coord_error": "not_real"}),
        (GOOD | {"coordinate": [math.nan, "x", 1, 2]}, {"coord_error": "not_finite"}),
        (GOOD | {"coordinate": ["x", math.nan, 1, 2]}, {"coord_error": "not_real"}),
        (GOOD | {"coordinate": (1, 2, 3, math.inf)}, {"coord_error": "not_finite"}),
    ],
)
def test_decode(box, want):
    found = decode_box(box)
    assert {k: found[k] for k in want} == want
