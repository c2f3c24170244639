import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tallymark.session import local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, memory="4g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    """Missing values alike, whole floats as integers (a null turns pandas' integers into floats), other floats rounded."""
    import pandas as pd

    if pd.isna(v):
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else f"{v:.6g}"
    return str(v)


def same(query, sql, spark, folder, duck):
    """Both sides' rows, sorted, with columns by name."""
    a = query(spark, folder).toPandas()
    b = duck.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    names = sorted(a.columns)
    rows = [sorted([plain(v) for v in r] for r in x[names].astype(object).values.tolist()) for x in (a, b)]
    assert rows[0] == rows[1]
