import pytest

from llm.brute import ODD_ROWS, SCHEMA


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with further columns that have the operators' own column names."""
    from pyspark.sql import functions as F

    names = "size text_sha256 n_tokens component_id own same set body copies score kept n_words _sha _own _id unit key"
    return odd.withColumns({n: F.lit(n) for n in names.split()})


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
