import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Evaluate a one-argument expression over a list of values."""
    def run(expr, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expr(df["v"])).collect()]
    return run
