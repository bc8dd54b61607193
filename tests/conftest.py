import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def save(spark, tmp_path_factory):
    """save(table=rows, ...) -> folder with one Parquet table each; rows is (rows, schema)."""

    def make(**tables):
        d = tmp_path_factory.mktemp("tables")
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return make
