import pyarrow.dataset as ds
import pytest

SF = "/root/testdata/sf0.01"

#: Nulls, empty, blank and very long texts, ties, repeated rows.
LONG = "long text of many words and lines\n" * 3000
EDGE = [(1, "alpha beta gamma delta epsilon zeta", "a"), (2, "alpha beta gamma delta epsilon zeta", "a"),
        (2, "alpha beta gamma delta epsilon zeta", "a"), (3, None, None), (4, "", "b"), (5, " \t\n ", "b"),
        (6, "x", None), (7, LONG, "a"), (8, LONG, "b"), (None, "no id at all here", "a"), (9, "42 17", "c")]


@pytest.fixture(scope="session")
def edge(spark):
    """The awkward rows, with extra columns named like the operators' own."""
    return spark.createDataFrame(
        [(i, t, s, "x", 1, "y", 2, True) for i, t, s in EDGE],
        "doc_id long, text string, source string, _id string, size long, _text string, key long, kept boolean")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.filter("doc_id = -1")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pdocs():
    return ds.dataset(f"{SF}/documents.parquet").to_table().to_pandas()
