import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """A documents frame from ``(doc_id, text)`` or longer rows."""

    def make(rows, partitions=3):
        full = [(*row, *("en", "s0")[len(row) - 2 :], len(row[1]) if row[1] is not None else None)[:5] for row in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def written(spark, tmp_path_factory):
    """A folder of tables; the large ones replaced by given frames."""

    def make(**frames):
        folder = tmp_path_factory.mktemp("tables")
        for name, frame in frames.items():
            frame.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return make
