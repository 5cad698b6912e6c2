import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sp(spark):
    """The shared session with the package shipped to its Python workers."""
    from seatmeter.llm.ship import ship
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(sp):
    return sp.read.parquet(os.path.join(SMALL, "documents.parquet"))


@pytest.fixture
def frame(sp):
    """frame(rows, schema): a DataFrame of several partitions, with clashing extra columns."""
    def make(rows, schema):
        df = sp.createDataFrame(rows, schema).repartition(3)
        from pyspark.sql import functions as F
        return df.withColumns({"component": F.lit(1), "node": F.lit("x"), "row": F.lit(None).cast("int"),
                               "digest": F.lit("y"), "start": F.lit(5), "kept": F.lit("no")})
    return make
