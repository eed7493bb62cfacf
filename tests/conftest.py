import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from millrace.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millrace-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="millrace-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"


HOT = ("user_id", "o_custkey", "l_partkey", "l_suppkey", "c_nationkey")
NEVER_NULL = ("event_id", "ts", "o_orderkey", "c_custkey", "doc_id", "n_nationkey")


@pytest.fixture(scope="session")
def harsh_dir(spark, tmp_path_factory):
    """The smallest tables as folders of files, with one key in a third of the rows and NULLs all over."""
    from pyspark.sql import functions as F

    out = tmp_path_factory.mktemp("harsh")
    for name in ("customer", "nation", "orders", "lineitem", "events", "documents"):
        df = spark.read.parquet(f"{TESTDATA}/sf0.001/{name}.parquet")
        columns = []
        for at, (column, kind) in enumerate(df.dtypes):
            value, lot = F.col(column), F.hash(*df.columns[:4], F.lit(at))
            if column in HOT:
                value = F.when(F.pmod(lot, F.lit(3)) == 0, F.lit(7).cast(kind)).otherwise(value)
            if column not in NEVER_NULL:
                value = F.when(F.pmod(lot, F.lit(11)) == 0, F.lit(None)).otherwise(value)
            columns.append(value.alias(column))
        df.select(columns).repartition(3).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.fixture
def plan():
    """Physical plan of a frame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
