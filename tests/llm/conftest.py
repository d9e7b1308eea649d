import pytest

from tidemark.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """The package on the workers' path, as the registered queries have it."""
    ship_package(spark)
    return spark


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) pairs, over several partitions, with extra columns
    whose names the operators use themselves."""

    def build(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("*", "'x' AS h", "1 AS component", "2 AS band", "3 AS part", "'y' AS score").repartition(3)

    return build


SF = "/root/testdata/sf0.001"


@pytest.fixture
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
