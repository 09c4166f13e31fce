import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: One document per edge: nulls in every column, empty and very long texts, white space only, copies, repeated rows.
BASE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon."


def documents():
    near = BASE.replace("omicron", "OMEGA")
    return [
        (0, BASE, "en", "a", 1), (1, BASE.replace(" ", "  "), "en", "a", 1), (2, near, "en", "b", 1),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \t\n ", "de", "b", 3), (6, "x", "de", "c", 1),
        (7, "der die das und ist nicht ein eine mit von", "de", "c", 1), (7, "der die das und ist nicht ein eine mit von", "de", "c", 1),
        (8, "le la les des une est dans pour que qui", "fr", None, 1), (None, BASE, "en", "a", 1), (None, None, None, None, None),
        (9, "word " * 3000, "en", "b", 1), (10, "a" * 5000, "en", "b", 1), (11, "  leading and   trailing  ", "en", "b", 1),
        (12, "<|endoftext|> special<|endoftext|>string <|startoftext|>", "en", "c", 1), (13, "éèü ñ 漢字 😀 é  x  y\x1cz", "fr", "c", 1),
        (14, "line one\nline one\nline two\n\n" + "### $$$ %%%\n" * 4, "en", "c", 1), (15, "one two three", "en", "a", 1),
        (16, "ONE two\tthree", "en", "a", 1), (17, "two three", "en", "a", 1), (18, BASE + " " + "More words follow here. " * 40, "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns that carry names used inside the operators."""
    from pyspark.sql import functions as F

    names = ["key", "sha", "row", "size", "h", "tie", "range", "rank", "zone", "start", "n", "digest", "split", "again", "ids",
             "target", "taken", "copies", "position", "node", "component", "kept", "text_hash", "a", "b", "salt"]
    return docs.select("*", *[F.lit("x").alias(c) for c in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
