import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, in several partitions."""

    def make(pairs, **extra):
        schema = T._parse_datatype_string(DOCS)
        rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs]
        df = spark.createDataFrame(rows, schema).repartition(3)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


@pytest.fixture(scope="session")
def sf(request):
    return "/root/testdata/sf0.001"
