import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
