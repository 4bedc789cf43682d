import duckdb
import pytest
from pyspark.sql import functions as F


@pytest.fixture
def edge_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns that clash with the operators' own names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(words[(i * i + i // 7) % 20] for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a"),
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a"),
        (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "b"),
        (3, None, None, None), (4, "", "en", None), (5, "   \n\t ", None, "a"), (6, long, "en", "a"), (7, long, "en", "b"),
        (None, "a text without an id that is long enough to be compared with the others here", "en", "a"),
        (None, None, None, None), (8, "été 12 km #*$", "fr", "b"), (9, "\U0001f600", "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ["words", "host", "fp", "block", "key", "id", "row", "hash", "length", "kept", "spaced", "label", "rank", "part"]
    return df.withColumns({"n_chars": F.length("text").cast("long"), **{c: F.lit(c) for c in clash}})


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.where("1 = 0")


@pytest.fixture
def db():
    return duckdb.connect()
