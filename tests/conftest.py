import pytest

from cdrmill.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from cdrmill.queries.base import Tables

    return Tables(spark, SF)


@pytest.fixture
def frame(spark):
    """DataFrame of text columns from a column list and rows."""

    def make(columns, rows):
        schema = ", ".join(f"`{c}` string" for c in columns.split())
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
