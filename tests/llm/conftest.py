import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    """The rows of a given table's columns, for the brute-force versions."""

    def rows(name, *columns, sf=SF):
        return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]

    return rows
