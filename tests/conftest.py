import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cellweave.session import build_session

    s = build_session(
        app="tests", master="local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g", spark_ui_showConsoleProgress="false",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def same_rows():
    from verify import norm

    def check(df, con, sql):
        cols = sorted(df.columns)
        mine = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        theirs = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
        assert mine == theirs

    return check
