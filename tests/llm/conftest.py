import pytest
from pyspark.sql import types as T

from footfall.llm.common import importable

# Every kind of row an operator has to bear: nulls in any column, empty and blank texts, a
# repeated row, a repeated id with another text, and columns named like the operators' own.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog today", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog today", "en", "a"),
    (3, "The quick  brown\tfox jumps over the lazy dog today", "en", "b"),
    (4, "", "en", "a"),
    (5, None, "en", "a"),
    (6, " \n\t ", None, "b"),
    (7, "12345 !!!", "de", None),
    (None, "a row without an id", "en", "a"),
    (None, "a row without an id", "en", "a"),
    (8, "zwei Zeilen\nLicensed under the Apache License, Version 2.0.", "de", "b"),
    (8, "zwei Zeilen\nLicensed under the Apache License, Version 2.0.", "de", "b"),
    (9, "same id, first text", "en", "a"),
    (9, "same id, other text", "en", "a"),
    (10, "wort " * 30_000, "de", "b"),
    (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = (
    "row row_number first id node label bucket spans ids starts packed decoded keep_id kept "
    "group_size shard slot lang_pred n_tokens license line epoch block start key normal_text"
).split()


@pytest.fixture(scope="session", autouse=True)
def on_path(spark):
    importable(spark)


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """The rows above as a table of two files, so that they are read in one order."""
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    frame = spark.createDataFrame(DOCS, SCHEMA).repartition(2, "source")
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'own' AS {name}")
    frame.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "empty")
    docs.filter("false").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


@pytest.fixture
def saved(spark, tmp_path):
    """Rows as a written table."""
    count = iter(range(100))

    def write(rows, schema=SCHEMA, files=3):
        path = str(tmp_path / f"table{next(count)}")
        spark.createDataFrame(rows, T._parse_datatype_string(schema)).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


SF_DIR = "/root/testdata/sf0.001"
