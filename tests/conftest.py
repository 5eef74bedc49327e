import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("sample tables not found")
    return SF_DIR


@pytest.fixture(scope="session")
def make_daily(spark):
    """Daily rows from (ticker, date, close) or (ticker, date, open, high, low, close, adj, volume)."""

    def make(rows, ingested_at="2024-01-01 00:00:00"):
        full = []
        for r in rows:
            ticker, day, *rest = r
            if len(rest) == 1:
                rest = [rest[0]] * 5 + [100]
            full.append((ticker, f"{ticker} Inc", day, *rest, ingested_at, "b", "s"))
        names = "ticker short_name date open high low close adj_close volume ingested_at batch_id source"
        kinds = "string string string double double double double double bigint string string string"
        schema = ", ".join(f"{n} {k}" for n, k in zip(names.split(), kinds.split()))
        df = spark.createDataFrame(full, schema)
        return df.withColumn("date", df.date.cast("date")).withColumn(
            "ingested_at", df.ingested_at.cast("timestamp")
        )

    return make
