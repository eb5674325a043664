import pytest
from pyspark.sql import DataFrame, SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(schema: str, *rows: tuple) -> DataFrame:
        return spark.createDataFrame(list(rows), schema)

    return make


def got(df: DataFrame, *cols: str) -> list[tuple]:
    """The rows as sorted tuples, NULL first."""
    data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(data, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()
