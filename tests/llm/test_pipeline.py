"""The pipeline against plain Python, stage by stage."""

import random
import zlib

import corpus_pipeline
import duckdb
import pytest
from folioframe.llm import queries

from tests.llm import brute
from tests.llm.conftest import words
from tests.test_queries import SF, database

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, doc long, body string, th string, row string, size int, copies int, real string"


def clean_rows(rows):
    """Rows (doc_id, text, source) that the quality stage keeps, by its SQL over one id a row."""
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(k, r[1]) for k, r in enumerate(rows)])
    kept = {k for k, good in con.sql(f"select doc_id, kept from ({queries.oracle_sql()['op6_quality_rules']})").fetchall() if good}
    return [r for k, r in enumerate(rows) if k in kept]


def first_rows(rows):
    """One row of each component: texts that link, directly or by others."""
    component = brute.jaccard_components(list(enumerate(r[1] for r in rows)))
    best = {}
    for k, r in enumerate(rows):
        if not brute.shingle_set(r[1]):
            best[("lone", k)] = r
            continue
        c = component[k][1]
        best[c] = min(best.get(c, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    return list(best.values())


def uncontaminated(rows, items):
    return [r for r in rows if not brute.decontaminate([r[:2]], items)[r[0]][4]]


def mixed(rows):
    copies = brute.mix(rows)
    return [r for r in rows for _ in range(copies[r[0]][1])]


def token_rows(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    out, start = [], 0
    for d, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


STEPS = [clean_rows, first_rows, uncontaminated, mixed]


def odd_corpus():
    r = random.Random(21)
    rows, item = [], words(1000, 40)
    for k in range(90):
        base = words(k, r.choice((25, 60, 200, 900)), 3000)
        if k % 9 == 0:
            base = base[:20] + item[:13] + base[20:30]
        rows.append((3 * k, " ".join(base), r.choice(("a", "b", "Z", None))))
        for _ in range(r.choice((0, 0, 1, 6))):
            copy = list(base)
            copy[r.randrange(len(copy))] = f"x{r.random()}"
            rows.append((1000 + len(rows), "  ".join(copy).upper(), r.choice(("a", "b"))))
    rows += [(5000, None, "a"), (5001, "", "b"), (None, None, None), (5002, "too few words", "a"), (5003, "the same again " * 50, "Z")]
    rows += [(None, " ".join(words(700, 80)), None), (5004, " ".join(words(701, 9000, 5000)), "b")]
    rows += [rows[0]] * 5 + [rows[-1]] * 3 + [rows[-2]] * 2 + [(6000, rows[4][1], "a")]
    r.shuffle(rows)
    return rows, [(1, " ".join(item)), (2, "Short item"), (3, None)]


def written(spark, folder, rows, items):
    full = [(d, t, None, s, None, 7, "x", "y", "z", 1, 2, "w") for d, t, s in rows]
    spark.createDataFrame(full, FIELDS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return f"file://{folder}"


@pytest.mark.parametrize("source", ["odd", "tables"])
def test_stages_are_plain_python(spark, tmp_path, source):
    if source == "odd":
        rows, items = odd_corpus()
        folder = written(spark, tmp_path, rows, items)
    else:
        rows, items, folder = database().sql("select doc_id, text, source from documents").fetchall(), database().sql("select item_id, text from benchmark").fetchall(), SF
    docs = queries.table(spark, folder, "documents")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, [*STEPS, None], strict=True):
        before, docs = docs, stage(spark, docs, folder).persist()
        if plain is None:
            got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in docs.collect())
            assert [(d, a, n, c) for a, d, n, c in got] == token_rows(rows)
            continue
        rows = plain(rows, items) if plain is uncontaminated else plain(rows)
        assert docs.columns == before.columns, name
        assert sorted(((r["doc_id"], r["text"], r["source"]) for r in docs.collect()), key=repr) == sorted(rows, key=repr), name
        assert rows


def test_run_is_the_stages(spark, tmp_path):
    rows, items = odd_corpus()
    folder = written(spark, tmp_path, rows, items)
    for plain in STEPS:
        rows = plain(rows, items) if plain is uncontaminated else plain(rows)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == token_rows(rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "source mix", "token output"]


def test_run_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [(1, "an item")])).collect() == []


def test_documents_without_a_number_of_their_own(spark, tmp_path):
    """Rows that share an id, or have none, but differ in text all come through."""
    rows = [(None, " ".join(words(k, 70, 5000)), "a") for k in range(4)] + [(8, " ".join(words(k, 70, 5000)), "a") for k in range(4, 7)]
    folder = written(spark, tmp_path, rows, [(1, "an item")])
    docs = queries.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in docs.collect()), key=repr) == sorted(rows, key=repr)
