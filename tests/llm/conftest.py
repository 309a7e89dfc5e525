import pytest

#: Column names that the operators use inside, as extra columns of the input.
CLASHING = "row int, size int, key int, fp int, pos int, tie int, at int, kept int, `drop` int, label int, score double, ids binary, part int, copies int"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    words = " ".join(f"word{i % 97}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "b"), (4, "One two", "en", None),
        (5, "one TWO", "en", None), (6, "Über straße, l'été; déjà-vu 漢字 é <|endoftext|> 'Ll", "de", "ü"),
        (7, "x" * 70_000, "en", "b"), (8, words, "en", "b"), (9, words, "en", "c"),
        (10, "a line that repeats in some documents\nown 10\nshort", "en", "a"),
        (11, "  A LINE that repeats in some documents\t\nown 11\nshort", "en", "a"),
        (12, "a line that repeats in some documents\na line that repeats in some documents\nshort", "en", "a"),
        (None, "a line that repeats in some documents\nno id", "en", "a"), (None, None, None, None),
        (13, "last line without end\n", "en", "c"), (14, "b\xa0c\x1cd e", "en", "c"),
    ]
    return rows + [rows[9], rows[9], rows[0]]


@pytest.fixture(scope="session")
def odd(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    extra = len(CLASHING.split(","))
    rows = [(*r, len(r[1] or ""), *[None] * extra) for r in odd_rows()]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
