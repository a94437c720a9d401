"""Rows of one time: the first counts, as in DuckDB on one thread."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.operators import book
from tidelake.plans import registry

M = 60_000


def near(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-8, abs_tol=1e-8))


def test_first_of_one_time_counts(spark):
    rows = [(k % 2 * 1000, 10 - k, float(k)) for k in range(6)]
    df = spark.createDataFrame(rows, "ts long, seq long, weighted_mid_price double").select("*", *[F.col("weighted_mid_price").alias(n) for n in book.FEATURES if n != "weighted_mid_price"])
    for interval in ("5m", "1h"):
        one = book.aggregate(df, interval).where(F.col("window_end") == 5 * M).first()
        assert (one["wmp_first"], one["wmp_last"]) == (4.0, 5.0)
        assert book.aggregate(df, interval, only=["wmp_last"], lasts=["spread"]).where(F.col("window_end") == 5 * M).first()[1:] == (5.0, 5.0)


@pytest.mark.parametrize("name", ["labels_simple", "derive_funding"])
def test_rows_of_one_time_against_duckdb(spark, sf, tmp_path, name):
    """Every event twice, under another id: DuckDB on one thread keeps the first row it reads, that of the lesser id."""
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"copy (select event_id + k * 1000000 as event_id, ts, user_id, event_type, value, props from '{sf}/events.parquet', range(2) r(k) order by k, event_id) to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    theirs = {r[names.index("window_end")]: r for r in cur.fetchall()}
    ours = {r["window_end"]: [r[n] for n in names] for r in df.select(*[S.q(n) for n in names]).collect()}
    assert ours.keys() == theirs.keys() and all(near(a, b) for k in ours for a, b in zip(ours[k], theirs[k], strict=True))


@pytest.mark.parametrize("name", ["derive_kaufman_ext", "derive_vwap_ext", "derive_logret_long", "derive_momentum_long", "derive_orderflow_ext_long", "diamond_nonnull", "labels_cat", "labels_multi", "labels_optimal"])
def test_more_rows_of_one_time_against_duckdb(spark, sf, tmp_path, name):
    test_rows_of_one_time_against_duckdb(spark, sf, tmp_path, name)
