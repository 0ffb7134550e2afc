import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortlink.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
        # Many short queries: quick compilation counts for more than fast code.
        spark_driver_extraJavaOptions="-XX:TieredStopAtLevel=1 -XX:+UseParallelGC",
        spark_sql_warehouse_dir=str(warehouse),
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])
