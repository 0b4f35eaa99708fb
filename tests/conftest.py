import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    tmp = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp}/checkpoints").config("spark.sql.warehouse.dir", f"{tmp}/warehouse").config("spark.driver.memory", "3g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _plain(frame):
    import pandas as pd

    frame = frame[sorted(frame.columns)]
    value = lambda x: None if x is None or pd.isna(x) else (float(f"{float(x):.9g}") if isinstance(x, float) and not float(x).is_integer() else int(x) if isinstance(x, float) else x)
    return sorted(str(tuple(value(x) for x in r)) for r in frame.astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def same():
    """Compare a Spark result with DuckDB's over the smallest tables."""
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.sql("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")

    def check(df, sql):
        got, want = df.toPandas(), db.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _plain(got) == _plain(want)

    return check
