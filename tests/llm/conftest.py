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


@pytest.fixture()
def docs(spark):
    """``docs([(id, text[, lang]), ...])`` as a documents table with clashing extra columns."""

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            names = "id fp digest keep_id kept text_sha256 score bucket batch words node root n rank shard label".split()
            df = df.withColumns({c: F.lit("x") for c in names})
        return df

    return make
