import pytest
#: Columns named like the operators' own, beside those of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc long, body string, th string, row string, size int, kind string, copies int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows, parts=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 7, "x", "y", "z", 1, "k", 2) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


def words(seed, n, vocabulary=400):
    import random

    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


LONG = " ".join(words(1, 12000))
#: Nulls, empty and very long texts, ties, repeated rows, odd white space and non-ASCII.
ODD = [
    (1, None, "a"),
    (2, "", None),
    (3, " \t\n\x0b\x0c\r ", "a"),
    (4, LONG, "b"),
    (5, LONG, "b"),
    (5, LONG, "b"),
    (6, "Été ß İ \u2028 naïve\u00a0x\n\n" + "Die gleiche Zeile steht hier mehrfach.\n" * 3, "é"),
    (7, "\tDIE gleiche Zeile steht hier mehrfach. \r\nmore", "é"),
    (8, "die gleiche Zeile steht hier mehrfach.", "Z"),
    (9, "one two three", "a"),
    (10, "One two THREE", "a"),
    (None, "die gleiche Zeile steht hier mehrfach.", None),
    (11, "a " * 3000, "b"),
    (12, "0" * 5000 + " 1.2.3.4 " + "1 " * 4000, "b"),
]
