"""Each operator against the plain Python of brute.py, on odd rows and on the smallest tables."""

import random

import numpy as np
import pytest
from folioframe.llm import decontam, htmltext, jaccard, linededup, mixing, pii, quality, queries, substrdedup, tokenbin, urlfilter
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import LONG, ODD, words
from tests.test_queries import SF, canonical, database

#: Rows with distinct ids, as brute.py wants them.
ONCE = [r[:2] for r in dict((r[0], r) for r in ODD if r[0] is not None).values()]


def by_id(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def documents(folder=SF):
    return database(folder).sql("select doc_id, text from documents").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    found = queries.queries()[name](spark, SF).toPandas()
    want = database().sql(queries.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(want.columns)
    assert canonical(found.convert_dtypes()) == canonical(want.convert_dtypes())


def test_all_ten_are_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 11)]


@pytest.mark.parametrize("operator", ["pii", "tokens", "lines", "jaccard", "quality", "substrings", "decontamination", "mix", "urls", "html"])
def test_empty_tables(spark, make_docs, operator, tmp_path):
    none = make_docs([(1, "x")]).limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string, host string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    run = {
        "pii": lambda: pii.find(none),
        "tokens": lambda: tokenbin.tokenize(none, queries.tokenizer_path()),
        "lines": lambda: linededup.apply_bitmaps(none, linededup.keep_bitmaps(none)),
        "jaccard": lambda: jaccard.join(none),
        "quality": lambda: quality.apply_policy(quality.ledger(none)),
        "substrings": lambda: substrdedup.remove_spans(none, substrdedup.repeated_spans(none)),
        "decontamination": lambda: decontam.scan(none, items),
        "mix": lambda: mixing.mix(none),
        "urls": lambda: urlfilter.judge(pages),
        "html": lambda: htmltext.extract(pages),
    }
    assert run[operator]().collect() == []


# ---- 1 PII -----------------------------------------------------------------------------------------

PERSONAL = [
    (20, "a@b.cc_d@e.ff x.y+z%@sub-1.example.org. @no.no u@v"),
    (21, "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.255 001.002.003.0004 9999999999999999999999.1.1.1"),
    (22, "4111 1111 1111 1111, 4111-1111-1111-1112; 4111111111111111 4111  1111 1111 1111"),
    (23, "+1 (555) 010-9999 call +49.30.1234567. +1 2 +(1) 23 +123456789012345678"),
    (24, "é ß \U0001f600 mail\u00e9@x.yy +1 555 010 9999\n+1 555 010 9999"),
    (25, "+4111 1111 1111 1111 and 12.34.56.78@host.tld"),
]


def test_pii_base(spark, make_docs):
    rows = [r[:2] for r in ODD if r[0] is not None] + PERSONAL
    found = pii.find(make_docs(rows)).select("doc_id", pii.digest(F.col("base")).alias("d"))
    got = {r["doc_id"]: r["d"] for r in found.collect()}
    for doc_id, text in rows:
        assert brute.sha(got[doc_id]) == brute.pii(text)[4], text[:80] if text else text


def test_pii_terms_that_reveal(spark, make_docs):
    rows = [(k, f"note {k}: Zanzibaria wrote from zz@top.org about item {k}\nclosing zanzibaria line") for k in range(4)]
    rows += [(k, f"wrote from about item {k} note closing line") for k in range(10, 40)]
    rows += [(50, "zz@top.org"), (51, "plain zanzibar")]
    found = {r["doc_id"]: r for r in pii.find(make_docs(rows)).select("doc_id", pii.digest(F.col("more")).alias("more")).collect()}
    assert found[0]["more"].split(",")[0].startswith("term_removed:8:18") and found[0]["more"].count("term") == 2
    assert all(not found[k]["more"] for k in (*range(10, 40), 50, 51))
    text = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(rows)).collect()}
    assert text[1] == "note 1:  wrote from [EMAIL] about item 1\nclosing  line"
    assert text[12] == rows[6][1] and text[50] == "[EMAIL]"


def test_copies_of_one_line_reveal_nothing(spark, make_docs):
    rows = [(k, "Zanzibaria wrote from zz@top.org") for k in range(9)] + [(k, "other words") for k in range(20, 60)]
    assert all(r["n"] == 0 for r in pii.find(make_docs(rows)).select(F.size("more").alias("n")).collect())


def test_repeats_change_no_disclosure(spark, make_docs):
    """Counts are of documents: a row repeated 30 times discloses as much as once, as the SQL has it."""
    import duckdb

    rows = [(k, f"note {k}: Zanzibaria\nwrote from zz@top.org about item {k}") for k in range(4)] + [(k, f"wrote about note {k} of this item") for k in range(10, 40)]
    rows += [(None, "zanzi from q@r.st"), (60, "Mail: the only-one@of.its kind\n" + "x " * 300 + "+1 555 010 9999 phone")]
    spans = lambda given: {r["doc_id"]: (r["b"], r["m"]) for r in pii.find(make_docs(given)).select("doc_id", pii.digest(F.col("base")).alias("b"), pii.digest(F.col("more")).alias("m")).collect()}
    once, often = spans(rows), spans(rows + [rows[0]] * 30 + [rows[10]] * 9 + [rows[-2]] * 5)
    assert once == often and sum("term" in m for _, m in once.values()) >= 4
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r for r in rows if r[0] is not None])
    want = con.sql(queries.oracle_sql()["op1_pii"]).fetchall()
    got = spans([r for r in rows if r[0] is not None])
    assert {r[0]: r[6] for r in want} == {d: ",".join(x for x in both if x) for d, both in got.items()}


def test_many_spans_in_one_text(spark, make_docs):
    text = " ".join(f"ab{k}é@x{k}.org 10.0.{k % 256}.{k % 99}" for k in range(4000)) + " +4111 1111 1111 1111"
    row = pii.find(make_docs([(1, text), (2, "none")])).where("doc_id = 1").select(pii.digest(F.col("base")).alias("d"), "base").first()
    assert brute.sha(row["d"]) == brute.pii(text)[4]
    clean = pii.sanitise(make_docs([(1, text), (2, "none")]), generalise=2.0).where("doc_id = 1").first()["text"]
    want, at = [], 0
    for b, e, kind in sorted((s["begin"], s["end"], s["kind"]) for s in row["base"]):
        if b >= at:
            want += [text[at:b], f"[{kind.upper()}]"]
        at = max(at, e)
    assert clean == "".join([*want, text[at:]])


def test_native_operators_run_no_python(spark, make_docs):
    docs = make_docs(ODD)
    for df in (pii.find(docs), quality.apply_policy(quality.ledger(docs)), mixing.mix(docs), quality.filter_documents(docs), mixing.mixed_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


# ---- 2 token binary --------------------------------------------------------------------------------


def encode(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_tokens(spark, make_docs):
    rows = [*ONCE, (30, "x² ½ <|endoftext|> don't  stop\x1c \n\n"), (31, "日本語 Ⅷ a  "), (32, "it's\u00a0\u00a0so \x85 z\u0301")]
    got = by_id(tokenbin.tokenize(make_docs(rows), queries.tokenizer_path(), shard_ids=5000), "start", "n_tokens", "ids_crc32")
    assert got == brute.token_rows(rows, encode)


def test_encoder_is_the_library_on_random_texts():
    from tokenizers import Tokenizer

    whole, encoder = Tokenizer.from_file(queries.tokenizer_path()), tokenbin.Encoder(queries.tokenizer_path())
    assert encoder.plain and encoder.model is not encoder.whole.model
    r = random.Random(11)
    ranges = [(32, 127), (32, 127), (9, 14), (0, 32), (127, 256), (256, 592), (0x300, 0x370), (0x370, 0x800), (0x2000, 0x2100), (0x4E00, 0x4F00), (0x1F300, 0x1F700)]
    for k in range(4000):
        some = ranges[: 1 + k % len(ranges)]
        text = "".join(chr(r.randrange(*r.choice(some))) for _ in range(r.randrange(60)))
        text = r.choice(("", "don't we'll I'VE ", "  two  spaces ", "12 3,4.5 ")) + text
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)


def test_repeated_and_null_ids_are_all_written(spark, make_docs):
    got = tokenbin.tokenize(make_docs([(1, "a"), (1, "a"), (None, "b"), (1, None)]), queries.tokenizer_path()).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [1, 1, 1, None]
    assert [r["start"] for r in got] == [0, *[sum(r["n_tokens"] for r in got[:k]) for k in (1, 2, 3)]]


def test_ids_come_back(spark, make_docs, tmp_path):
    tokenbin.write(make_docs(ONCE), queries.tokenizer_path(), f"file://{tmp_path}/t")
    got = {r["doc_id"]: r["ids"] for r in tokenbin.read(spark, f"file://{tmp_path}/t", with_ids=True).collect()}
    assert all(got[d] == encode(t or "") + [0] for d, t in ONCE)


# ---- 3 line dedup ----------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 40])
def test_lines(spark, make_docs, parts):
    r = random.Random(5)
    pool = [f"line number {k} with enough characters" for k in range(12)] + ["short", "", "ein Satz mit genau zwanzig ü"]
    rows = ONCE + [(100 + k, "\n".join(r.choice(pool) for _ in range(r.randrange(9)))) for k in range(120)]
    rows += [(300 + k, "The very common line of this corpus\nown line %d which is long enough" % (k % 50)) for k in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = make_docs(rows)
        got = by_id(linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)), "n_lines", "n_dropped", "kept_sha256")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == brute.line_dedup(rows)


def test_lines_of_repeated_rows(spark, make_docs):
    docs = make_docs(ODD)
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).collect()
    assert len(out) == len(ODD)
    assert len({(r["n_dropped"], r["text"]) for r in out if r["doc_id"] == 5}) == 1
    null = next(r for r in out if r["doc_id"] is None)
    assert null["n_dropped"] == 0  # ranks as the largest id
    assert {r["n_dropped"] for r in out if r["doc_id"] in (7, 8)} == {1}


# ---- 4 Jaccard join --------------------------------------------------------------------------------


def near_copies(seed):
    """Random documents with copies at all distances around the threshold, short ones among them."""
    r = random.Random(seed)
    rows, k = [], 0
    for size in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 18, 20, 24, 30, 60, 150):
        for _ in range(4):
            base = words(r.random(), size, 60)
            for _ in range(5):
                copy = list(base)
                for _ in range(r.randrange(4)):
                    at = r.randrange(len(copy))
                    copy[at : at + r.randrange(2)] = words(r.random(), r.randrange(3), 60)
                    copy = copy or ["x"]
                rows.append((k, " ".join(copy).upper() if r.random() < 0.2 else "  ".join(copy)))
                k += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [None, 0, 9])
def test_components(spark, make_docs, seed, limit):
    rows = near_copies(seed)
    got = by_id(jaccard.join(make_docs(rows), limit=limit), "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows)


def test_components_of_small_sets_in_one_subset_list(spark, make_docs):
    """Two larger sets don't link with each other but with the smaller one, whatever the order of ids; a set of 6 has 6 such lists."""
    rows = [(1, "a b c d e f g h i x"), (2, "a b c d e f g h i y"), (3, "a b c d e f g h i")]
    # A cycle of 6 words has 6 different shingles, and each 9 words of it have 5 of them: six sets of 5 in one of 6.
    cycle = "p q r s t u".split() * 3
    rows += [(10 + k, " ".join(cycle[k : k + 9])) for k in range(6)] + [(20, " ".join(cycle[:10]))]
    got = by_id(jaccard.join(make_docs(rows)), "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows)
    assert [got[k][1] for k in (1, 2, 3, 10, 15, 20)] == [1, 1, 1, 10, 10, 10]


def end_variants(seed, groups=250):
    """Short texts in groups that differ at their ends, so that many are prefixes or suffixes of others."""
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = words(r.random(), r.randrange(5, 15), 90)
        for _ in range(6):
            copy = base[r.randrange(2) : len(base) - r.randrange(2)]
            copy = words(r.random(), r.randrange(2), 90) + copy + words(r.random(), r.randrange(2), 90)
            rows.append(" ".join(copy))
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("seed", "limit", "hot"), [(1, None, 10_000), (2, None, 2), (3, 0, 3), (4, 3, 10_000), (5, 6, 2), (6, 9, 4)])
def test_components_of_short_texts(spark, make_docs, seed, limit, hot):
    rows = end_variants(seed)
    got = by_id(jaccard.join(make_docs(rows), limit=limit, hot=hot), "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows)


def test_components_are_those_of_the_links(spark, make_docs):
    rows = end_variants(7, 60) + [(1000 + d, t) for d, t in near_copies(8)]
    found, members = jaccard.links(make_docs(rows), hot=3)
    up = {r["doc"]: r["rep"] for r in members.collect()}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in found.collect():
        a, b = root(r["a"]), root(r["b"])
        up[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(make_docs(rows)).collect()}
    assert got == {d: root(d) for d in up}


def test_small_sets_in_any_order_of_ids(spark, make_docs):
    from itertools import permutations

    texts = ("a b c d e f g x", "a b c d e f g y", "a b c d e f g")
    rows = [(10 * k + d, " ".join(f"{w}{k}" for w in t.split())) for k, order in enumerate(permutations((1, 2, 3))) for d, t in zip(order, texts, strict=True)]
    assert {r["component_id"] for r in jaccard.join(make_docs(rows)).collect()} == {10 * k + 1 for k in range(6)}
    assert sorted(r["doc_id"] for r in jaccard.keep_first(make_docs(rows)).collect()) == [10 * k + 1 for k in range(6)]


@pytest.mark.parametrize("hot", [10_000, 20])
def test_pages_of_one_template(spark, make_docs, hot):
    """A shingle in every document, sets that share two thirds with all others, and copies of some."""
    template = words(4, 60)
    rows = [(k, " ".join([*words(k % 280 + 100, 22 + k % 5, 10**6), *template, *words(k, k % 2)])) for k in range(300)]
    assert by_id(jaccard.join(make_docs(rows), hot=hot), "n_shingles", "component_id") == brute.jaccard_components(rows)


def test_texts_are_compared_once_however_often_repeated(spark, make_docs):
    rows = [(k % 4, " ".join(words(1, 60)[k % 4 :])) for k in range(200)]
    got = jaccard.join(make_docs(rows)).collect()
    assert len(got) == 200 and {r["component_id"] for r in got} == {0}


def test_only_texts_that_link_are_merged(spark, make_docs):
    """Null and repeated ids don't make documents one in the filter."""
    one, two, three = (" ".join(words(k, 30)) for k in (1, 2, 3))
    rows = [(None, one), (None, two), (None, two), (7, one), (7, three), (7, three), (9, three), (3, "")]
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_first(make_docs(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(7, one), (None, two), (7, three), (3, "")], key=repr)


def test_components_of_a_large_group(spark, make_docs):
    base = words(3, 120)
    rows = [(k, " ".join([*base[: k % 100], f"x{k}", *base[k % 100 + 1 :]])) for k in range(150)] + [(1000 + k, " ".join(words(k, 40))) for k in range(50)]
    assert by_id(jaccard.join(make_docs(rows)), "n_shingles", "component_id") == brute.jaccard_components(rows)


def test_components_of_odd_rows(spark, make_docs):
    rows = jaccard.join(make_docs(ODD)).collect()
    assert len(rows) == len(ODD)
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert (got[1], got[2], got[3], got[5], got[10], got[None]) == (1, 2, 3, 4, 9, 8)
    kept = jaccard.keep_first(make_docs(ODD))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 11, 12]
    assert kept.columns == make_docs(ODD).columns


def test_rows_that_share_an_id_are_one_document(spark, make_docs):
    rows = near_copies(5)[:200]
    shared = [(d // 2, t) for d, t in rows]
    alone = brute.jaccard_components(rows)
    up = {d: d for d, _ in shared}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    first = {}
    for d, t in rows:
        key = alone[d][1] if brute.shingle_set(t) else ("none", d)
        a, b = root(d // 2), root(first.setdefault(key, d // 2))
        up[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(make_docs(shared)).collect()}
    assert got == {d: root(d) for d in up}


def test_boundary_by_cost():
    assert jaccard.boundary(list_cost=1000) > jaccard.boundary() > jaccard.boundary(list_cost=0.1)


# ---- 5 HTML ----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p>b{{}}</style></head><body class="has-sidebar"><header><h1>Site name</h1></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>{before}
{open}<h1>The title &amp; more</h1><p>First <b>paragraph</b> of
 the text,<br>with a break &mdash; and <a href="x>y">a link</a>.<p>Short.<p>A third paragraph that is a good deal longer than the second one was.{inner}{close}
<aside class="sidebar"><p>Something else to read on this site, at some length too</p></aside>
<div class="cookie-notice">We use cookies to make this site better for you.</div><form><label>Your mail</label><input name=a></form>
<script>var a = "<p>not text</p>";</script><section id="comments"><p>I liked this article very much, thank you for it.</p></section><footer>&copy; 2020 nobody at all</footer></body></html>"""
TEXT = "The title & more First paragraph of the text, with a break — and a link. Short. A third paragraph that is a good deal longer than the second one was."


@pytest.mark.parametrize(("open_", "close"), [("<article>", "</article>"), ("<main>", "</main>"), ('<div id="article">', "</div>"), ("<ARTICLE class='post'><header>", "</header></ARTICLE>")])
def test_main_text(open_, close):
    assert htmltext.main_text(PAGE.format(open=open_, close=close, before="<div class='ad'>Buy this now</div><!-- <p>old</p> -->", inner="")) == TEXT
    assert htmltext.main_text(PAGE.format(open=open_, close=close, before="", inner="<div class=share><a>Tweet</a></div>")) == TEXT


def test_plain_page_and_broken_pages():
    flat = htmltext.main_text(PAGE.format(open="<div>", close="</div>", before="", inner=""))
    assert "A third paragraph" in flat and "cookies" not in flat and "liked" not in flat and "Home" not in flat
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<html><script>x") == ""
    assert htmltext.main_text("<article><p>cut off in the middle of a tag <a hre") == "cut off in the middle of a tag"
    assert htmltext.main_text("<article><p>a &lt; b &#8364; &amp") == "a < b € &"
    assert htmltext.main_text("<article>" + "<div>" * 3000 + "deep text that goes on" + "</div>" * 10) == "deep text that goes on"


@pytest.mark.parametrize(
    "skipped",
    [
        "<script>for(var i=0;i<n;i++){x[i]=1}</script>",
        "<script>if(a<b)c='it';</SCRIPT >",
        "<script><!-- var a = '<script>no</script>' --></script>",
        "<script><!--> no </script>",
        "<script><!-- no </script>",
        "<style>a<b{}</style>",
        "<svg><!-- </svg> --><script>a<b</script><text x='</svg>'>no</text></svg>",
        "<button title='a>b'>1<2</button>",
        "<template><script>'</template>'</script>no</template>",
    ],
)
def test_elements_without_text_end_at_their_own_end_tag(skipped):
    assert htmltext.main_text(f"<body>{skipped}<article><p>the whole article is here</article></body>") == "the whole article is here"
    assert htmltext.main_text(f"<article><p>the whole {skipped} article is here</article>") == "the whole article is here"


@pytest.mark.parametrize("start", ["<body>", "<article>", "<p>"])
def test_a_head_needs_no_end_tag(start):
    page = f"<html><head><meta charset=utf-8><title>No</title><script>a<b</script>{start}<article><p>the whole article is here</article>"
    assert htmltext.main_text(page) == "the whole article is here"


@pytest.mark.parametrize("name", ["share-price", "post-banner", "widget-theory", "menu-planning", "search-results-text"])
def test_a_name_alone_drops_no_text(name):
    text = "a long paragraph of the article that has no link and that is as long as any other text on the page so that it stays"
    page = f"<body><article><h1>The title of it</h1><div class='{name}'>{text}</div><p>More of the same article is here, too, and it goes on.</p></article></body>"
    assert text in htmltext.main_text(page)


@pytest.mark.parametrize("kept", ["<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "<object><p>inner text</p></object>", "<video>moving text</video>"])
def test_text_of_embedded_elements_stays(kept):
    import re

    want = " ".join(re.sub(r"<[^>]*>", " ", kept).split())
    got = htmltext.main_text(f"<article><p>this is the first paragraph of it</p>{kept}<p>and this is the last paragraph of it</p></article>")
    assert want.replace(" ", "") in got.replace(" ", "") and got.startswith("this is") and got.endswith("of it")


def test_an_open_button_ends_at_the_next_block():
    article = "<article><p>the whole article is here</p><button>more</button></article>"
    assert htmltext.main_text(f"<body><button>press {article}") == "the whole article is here"
    assert htmltext.main_text(f"<body><form><select><option>a<option>b</form>{article}") == "the whole article is here"
    assert htmltext.main_text(f"<body><button>one<button>two</button>{article}") == "the whole article is here"


def test_tree_learns_its_pages():
    x, y = htmltext.labelled()
    assert ((htmltext.trained().predict(x) >= 0.5) == y).mean() > 0.995
    splits = htmltext.trained().splits()
    assert {"words", "words_before", "words_after", "links", "links_before", "links_after"} <= set(splits)


@pytest.mark.parametrize(("layout", "exact"), [("article", 0.95), ("named", 0.9), ("plain", 0.9)])
def test_held_out_labelled_pages(layout, exact):
    """Pages of another seed: words of the article found, words found that are of it, and pages found exactly."""
    from folioframe.llm import htmlpages

    found = of_it = all_of_it = same = 0
    for html in htmlpages.pages(200, 99, layout):
        got = htmltext.main_text(html).split()
        want = [w for b in htmltext.blocks_of(html) for w in b.text.split() if w.startswith(htmlpages.MARK)]
        hit = sum(w.startswith(htmlpages.MARK) for w in got)
        found, of_it, all_of_it, same = found + len(got), of_it + hit, all_of_it + len(want), same + (got == want)
    assert of_it >= 0.99 * found and of_it >= 0.99 * all_of_it and same >= exact * 200


def test_held_out_pages(spark):
    """The tables' pages wrap known articles: their text, tags taken out by a plain rule, must be found."""
    import re
    from html import unescape

    rows = htmltext.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    html = dict(database().sql("select page_id, html from pages").fetchall())
    good = 0
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", html[r["page_id"]])[1]
        good += r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r["n_chars"] == len(r["text"])
    assert good >= 0.98 * len(rows)


# ---- 6 quality -------------------------------------------------------------------------------------


def test_quality(spark, make_docs):
    rows = ONCE + [(40, "a b c d e f g h " * 2 + "x"), (41, "a b c d e f g h x a b c d e f g h"), (42, "# $ | <>&%*" * 9), (43, "l\nl\n\nl \n l")]
    got = by_id(quality.apply_policy(quality.ledger(make_docs(rows))), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for doc_id, text in rows:
        assert list(got[doc_id]) == brute.quality(text), doc_id


def test_policies_and_ablation(spark, make_docs):
    clean = " ".join(words(8, 100))
    rows = [(1, clean), (2, "few words"), (3, " ".join(w + "#$" for w in clean.split())), (4, "a b c d e f g h i j k " * 9), (5, "\n".join(["the same line here", "x"] * 30))]
    led = quality.ledger(make_docs(rows))
    kept = lambda policy: {r["doc_id"] for r in quality.apply_policy(led, policy).where("kept").collect()}
    assert kept("base") == {1, 3} and kept("v1") == {1}
    table = {r["rule"]: (r["n_failed"], r["n_only_this"]) for r in quality.ablation(led).collect()}
    for name in table:
        bit = quality.BIT[name]
        bits = [r["fail_bits"] for r in led.collect()]
        assert table[name] == (sum(b & bit > 0 for b in bits), sum(b & quality.POLICIES["v1"] == bit for b in bits))
    out = quality.filter_documents(make_docs(rows))
    assert out.columns == make_docs(rows).columns and [r["doc_id"] for r in out.collect()] == [1]


def test_the_filter_measures_once(make_docs):
    plan = quality.filter_documents(make_docs([(1, "x")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2


# ---- 7 URLs ----------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.EXAMPLE.COM/en/x", "http://example.com/en/", "http://xexample.com/en/a", "http://a.example.com/en",
    "http://www.example.com/EN/a", "http://sub.www.example.com/en/a?b://c.net/fr/", "ftp://a.net/fr/x#y", "http://net/es/", "http://a.net?x=/es/", "http://casino.org/",
    "http://a.org/casino/", "http://free-bets.example.org", "http://a.b.xxx", "http://É.COM/x", "x://com/", "http://com", "http://a.com//en/", "http://evil.org/x.com/", "http:///en/",
]


def test_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("verdict", F.lit("x"))
    rows = {r["page_id"]: r for r in urlfilter.judge(pages).collect()}
    for k, u in enumerate(URLS):
        host, path, rule, verdict = brute.url(u)
        assert (rows[k]["host"], rows[k]["path"], rows[k]["rule"]) == (host, path, rule), u
        assert rows[k]["verdict"] == (verdict or rows[k]["verdict"])
    assert [URLS[k] for k, r in rows.items() if r["by"] == "glob"] == ["http://casino.org/", "http://free-bets.example.org", "http://a.b.xxx"]


def as_pattern(glob):
    import re

    return re.compile("".join(".*" if x.startswith("**") else "[^/?]*" if x == "*" else re.escape(x) for x in re.findall(r"\*+|[^*]+", glob)), re.DOTALL)


def test_automaton_is_the_globs():
    r = random.Random(3)
    globs = ["".join(r.choice("ab*/?*") for _ in range(r.randrange(1, 9))) + "a" for _ in range(3000)]
    urls = ["".join(r.choice("ab/?") for _ in range(r.randrange(0, 14))).encode() for _ in range(300)]
    found = urlfilter.GlobAutomaton(globs).match(urls)
    for j, glob in enumerate(globs):
        pattern = as_pattern(glob)
        assert [bool(x) for x in found[:, j]] == [pattern.match(u.decode()) is not None for u in urls], glob


def test_given_globs_judge_whole_urls(spark):
    """Each glob of the table, filled in at random, blocks; the verdicts are those of plain patterns."""
    import re

    globs = urlfilter.given_globs()
    assert len(globs) > 150 and len(set(globs)) == len(globs)
    r = random.Random(4)
    fill = lambda m: "".join(r.choice("abc-.") for _ in range(r.randrange(4))) if m[0] == "*" else "".join(r.choice("abc/?=.") for _ in range(r.randrange(6)))
    urls = []
    for glob in globs:
        for _ in range(4):
            whole = re.sub(r"\*+", fill, glob)
            whole = whole if whole.startswith(".") and "/" in whole else "." + whole
            host, rest = re.match(r"([^/?]*)(.*)", whole[1:]).groups()
            urls.append(f"http://{host or 'a.org'}{rest.upper() if r.random() < 0.3 else rest}#f")
    urls += ["http://a.org/p?x=/login", "http://a.org/login?x", "http://a.org/logi", "http://a.org?adurl=1", "http://a.org/a;JSESSIONID=1", "http://poker.org/", "http://a.poker"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    patterns = [as_pattern(g) for g in globs]
    blocked = 0
    for row in urlfilter.judge(pages, rules=[urlfilter.SiteRule("allow", "none.such", "/")]).collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)((?:\?[^#]*)?)", urls[row["page_id"]])
        whole = "." + (m[1] + (m[2] or "/") + m[3]).translate(brute.UPPER)
        bad = any(p.match(whole) for p in patterns)
        assert (row["verdict"], row["by"]) == (("block", "glob") if bad else ("allow", "default")), whole
        blocked += bad
    assert blocked > 0.6 * len(urls)


def test_odd_urls_and_repeated_rows(spark):
    long = "http://a.org/" + "x/" * 40_000 + "login"
    pages = spark.createDataFrame([(None, long), (1, long), (1, long), (2, None)], "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("_whole", F.lit("y"))
    rows = urlfilter.judge(pages).collect()
    assert sorted((r["page_id"] or 0, r["verdict"], r["by"]) for r in rows) == [(0, "block", "glob"), (1, "block", "glob"), (1, "block", "glob"), (2, "allow", "default")]


# ---- 8 substrings ----------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [substrdedup.BUCKET_WORDS, 300, 1])
def test_substrings(spark, make_docs, bucket):
    r = random.Random(7)
    passages = [words(100 + k, 50 + 7 * k) for k in range(8)]
    rows = [*ONCE, (60, " ".join(["same"] * 200)), (61, " ".join(["same"] * 120)), (62, " ".join(passages[0])), (63, " ".join(passages[0][:49]))]
    for k in range(120):
        parts = words(k, r.randrange(80))
        for _ in range(r.randrange(3)):
            p = r.choice(passages)
            cut = r.randrange(5)
            parts += p[cut : len(p) - r.randrange(4)] + words(k + 500, r.randrange(30))
        rows.append((200 + (k * 37) % 120, "\n".join(parts)))
    docs = make_docs(rows)
    got = by_id(substrdedup.remove_spans(docs, substrdedup.repeated_spans(docs, bucket_words=bucket)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring_dedup(rows)


def test_substrings_of_repeated_rows(spark, make_docs):
    docs = make_docs(ODD)
    out = substrdedup.remove_spans(docs, substrdedup.repeated_spans(docs)).collect()
    assert len(out) == len(ODD) and [r["n_removed"] for r in out if r["doc_id"] == 5] == [12000, 12000]
    assert [r["n_removed"] for r in out if r["doc_id"] == 4] == [0]


def test_pieces_are_whole_buckets(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substrdedup, "CHUNK", 20)
    keys = [(1, -1)] * 3 + [(1, 0)] * 2 + [(2, -1), (3, -1)] + [(4, -1)] * 9 + [(5, -1)]
    batch = pa.RecordBatch.from_pydict({"mini": [k[0] for k in keys], "part": [k[1] for k in keys], "words": [b"x" * (1 + 30 * (k[0] == 3)) for k in keys]})
    cut = [list(zip(p["mini"].to_pylist(), p["part"].to_pylist(), strict=True)) for p in substrdedup._pieces(batch)]
    assert [k for piece in cut for k in piece] == keys and len(cut) > 1
    assert all(a[-1] != b[0] for a, b in zip(cut, cut[1:], strict=False))


def test_packed_strings_do_not_grow_with_copies(spark, make_docs, monkeypatch):
    text = " ".join(words(31, 200))
    sent = []
    packed = substrdedup._packed
    monkeypatch.setattr(substrdedup, "_packed", lambda *a: sent.append(packed(*a)) or sent[-1])
    for copies in (2, 40):
        rows = [(1, text)] * copies + [(2, "x " + text)] * copies + [(k, text) for k in range(3, 3 + copies)] + [(90, text + " y")]
        docs = make_docs(rows)
        out = substrdedup.remove_spans(docs, substrdedup.repeated_spans(docs)).collect()
        assert {(r["doc_id"], r["n_words"] - r["n_removed"]) for r in out if r["doc_id"] in (1, 2, 3, 90)} == {(1, 200), (2, 1), (3, 0), (90, 1)}
    few, many = (df.count() for df in sent)
    assert few == many > 0


def test_long_documents_of_one_word(spark, make_docs):
    rows = [(k, " ".join(["same"] * (3000 + 7 * k))) for k in range(12)] + [(20, " ".join(["same"] * 49))]
    docs = make_docs(rows)
    got = by_id(substrdedup.remove_spans(docs, substrdedup.repeated_spans(docs, bucket_words=5000)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring_dedup(rows)


# ---- 9 decontamination -----------------------------------------------------------------------------

ITEMS = [(1, " ".join(words(70, 30))), (10, " ".join(words(70, 13))), (2, "Short Item here!"), (3, None), (4, "..."), (5, "Short item HERE"), (None, "une  été-chaude"), (2, "Short Item here!")]


@pytest.mark.parametrize("block", [decontam.BLOCK_WINDOWS, 4])
def test_decontamination(spark, make_docs, block):
    rows = [*ONCE, (50, "so this short, item - HERE it is"), (51, "x " * 30 + " ".join(words(70, 30)[5:]) + " y" * 900), (52, "une été chaude")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.scan(make_docs(rows), items, block_windows=block)
    got = by_id(out.withColumn("d", F.sha2(F.concat_ws(",", "items"), 256)), "n_words", "n_hit", "n_items", "d", "contaminated")
    assert got == brute.decontaminate(rows, [("null" if i is None else i, t) for i, t in ITEMS])


def test_a_window_of_many_items_is_dealt_over_blocks(spark, make_docs):
    """No broadcast holds more rows than a block, also where all items share one window."""
    items = [(k, "the very same words in all of the items") for k in range(9)] + [(20, "others of it")]
    table = spark.createDataFrame(items, "item_id long, text string")
    windows, blocks = decontam._blocks(decontam.item_windows(table), 4)
    assert sorted(r["count"] for r in windows.groupBy("bucket", "part").count().collect())[-1] <= 4 and len(blocks) >= 3
    rows = [(1, "see the very same words in all of the items here"), (2, "no others"), (3, "others of it")]
    got = by_id(decontam.scan(make_docs(rows), table, block_windows=4).withColumn("d", F.sha2(F.concat_ws(",", "items"), 256)), "n_words", "n_hit", "n_items", "d", "contaminated")
    assert got == brute.decontaminate(rows, items)
    none = decontam.scan(make_docs(rows), table.limit(0)).collect()
    assert {(r["n_hit"], r["contaminated"]) for r in none} == {(0, False)}


def test_clean_documents_stay(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(1, "short item here"), (2, "keep me"), (3, None), (2, "keep me")]
    out = decontam.remove_documents(make_docs(rows), items)
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 2, 3] and out.columns == make_docs(rows).columns
    text = decontam.scan(make_docs([(1, "see: short, item here; end")]), items, clean_text=True).first()["text"]
    assert text == "see: ; end"


# ---- 10 mixing -------------------------------------------------------------------------------------


def test_mix(spark, make_docs):
    r = random.Random(9)
    sources = ["a", "b", "Z", "é", None, "tiny", "empty"]
    rows = [(k, " ".join(["w"] * r.randrange(1, 60)), r.choice(sources[:5])) for k in range(3000)] + [(5000, "w w w", "tiny"), (5001, None, "empty"), (5001, "", "empty")]
    docs = make_docs(rows)
    out = mixing.mix(docs).collect()
    size = lambda t: len(brute.WORD.findall(t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = brute.mix_targets(sizes)
    by_source = {}
    source = {d: s for d, _, s in rows}
    for x in out:
        s = source[x["doc_id"]]
        assert x["source_size"] == sizes[s] and abs(x["target"] - target[s]) < 1e-6 * max(1, target[s])
        assert x["taken"] <= 3 * x["size"] and (not x["size"] or x["taken"] % x["size"] == 0)
        by_source[s] = by_source.get(s, 0) + x["taken"]
    assert len(out) == len(rows) and all(abs(by_source[s] - target[s]) <= 30 for s in sizes)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns
    assert whole.count() == sum(x["copies"] for x in out)


def test_inclusion_follows_the_odds_of_sizes(spark, make_docs):
    """Within one source each size class is taken at its own probability, and the words are those wanted."""
    sizes = {1: 6000, 4: 3000, 16: 2000, 64: 800, 1000: 6}
    rows = [(10_000 * n + k, "w " * n, "a") for n, many in sizes.items() for k in range(many)] + [(9 * 10**8 + k, "w " * 500, "b") for k in range(170)]
    total = sum(n * many for n, many in sizes.items())
    want = (total + 170 * 500) / 3
    chance = brute.mix_chances({n.bit_length() - 1: n * many for n, many in sizes.items()}, want)
    assert chance[9] == 1 and chance[0] < chance[2] < chance[4] < chance[6] < 1
    taken = {}
    for r in mixing.mix(make_docs(rows)).where("doc_id < 900000000").collect():
        assert r["copies"] in (0, 1) and abs(r["target"] - want) < 1e-6
        taken[r["size"]] = taken.get(r["size"], 0) + r["copies"]
    assert abs(sum(n * k for n, k in taken.items()) - want) <= 500
    for n, many in sizes.items():
        p = chance[n.bit_length() - 1]
        assert abs(taken[n] - many * p) <= 4 * (many * p * (1 - p)) ** 0.5 + 2, (n, taken[n], many * p)
    equal = {r["size"]: r["n"] / sizes[r["size"]] for r in mixing.mix(make_docs(rows), power=0).where("doc_id < 900000000").groupBy("size").agg(F.sum("copies").alias("n")).collect()}
    assert all(abs(equal[n] - want / total) < 0.05 for n in (1, 4, 16, 64))


def test_the_rank_decides(spark, make_docs):
    """A plain ranking of the whole table, by the same odds, takes the same documents."""
    r = random.Random(13)
    rows = [(k, " ".join(["w"] * int(2 ** r.uniform(0, 9))), r.choice(["a", "b", None])) for k in range(900)] + [(2000, "", "a"), (2001, None, "b"), (None, "x y z", "b")]
    for fan in (1024, 2):
        got = {x["doc_id"]: (x["size"], x["copies"]) for x in mixing.mix(make_docs(rows), fan=fan).collect()}
        assert got == brute.mix(rows)


def test_mix_of_odd_rows(spark, make_docs):
    out = mixing.mix(make_docs(ODD)).collect()
    assert len(out) == len(ODD) and all(x["taken"] == x["copies"] * x["size"] and 0 <= x["copies"] <= 3 for x in out)
    assert len({x["copies"] for x in out if x["doc_id"] in (1, 3)}) == 1  # without words, of one source: the certain copies
    taken, target = {}, {}
    source = {d: s for d, _, s in ODD}
    for x in out:
        s = source[x["doc_id"]]
        taken[s], target[s] = taken.get(s, 0) + x["taken"], x["target"]
    assert all(abs(taken[s] - target[s]) <= 6000 for s in taken)
    whole = mixing.mixed_documents(make_docs(ODD))
    assert whole.columns == make_docs(ODD).columns and whole.count() == sum(x["copies"] for x in out)


def test_links_between_classes(spark, make_docs):
    rows = near_copies(3)
    found, members = jaccard.links(make_docs(rows))
    rep = {r["doc"]: r["rep"] for r in members.collect()}
    sets = {d: brute.shingle_set(t) for d, t in rows}
    first = {}
    for d in sorted(sets):
        first.setdefault(frozenset(sets[d]), d)
    assert rep == {d: first[frozenset(s)] for d, s in sets.items()}
    reps = sorted(set(rep.values()))
    want = {(a, b) for a in reps for b in reps if a > b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in found.collect()} == want
