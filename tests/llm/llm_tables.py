"""Tables for the corpus operators' tests."""

import pytest
from pyspark.sql import functions as F

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, over three partitions."""

    def make(rows, extra=None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        for name in extra or ():
            df = df.withColumn(name, F.lit("x"))
        return df

    return make
