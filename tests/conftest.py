import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{home}/shared").config("spark.sql.warehouse.dir", f"file://{home}/warehouse").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same(spark, duck):
    """Checks a query against its SQL: columns and rows, in any order."""

    def check(query, sql):
        df = query(spark, SF)
        cols = sorted(df.columns)
        rel = duck.execute(sql)
        names = [d[0] for d in rel.description]
        assert cols == sorted(names)
        at = [names.index(c) for c in cols]
        key = lambda r: tuple((x is None, str(x)) for x in r)
        got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=key)
        assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=key)

    return check
