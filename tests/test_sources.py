"""Lake, archives, history and live feeds against small files."""

import io
import json
import tarfile
import zipfile

from pyspark.sql import functions as F

from tidelake.operators import book, trades
from tidelake.plans import fixtures
from tidelake.sources import archives, lake, rest
from tidelake.streaming import live

DAY = 86_400_000


def rows(spark, times, price=1.0):
    return spark.createDataFrame([("X", i, "buy", price, 1.0, t) for i, t in enumerate(times)], lake.SCHEMAS["trades"]).withColumn("symbol", F.lit("X"))


def test_upsert_is_idempotent_and_touches_only_its_dates(spark, tmp_path):
    root = str(tmp_path)
    lake.upsert(rows(spark, [0, DAY, DAY + 5]), root, "trades")
    lake.upsert(rows(spark, [0], 7.0), root, "trades")
    lake.upsert(rows(spark, [0], 7.0), root, "trades")
    got = lake.read(spark, root, "trades")
    assert got.count() == 3 and got.where("price = 7").count() == 1
    assert lake.read(spark, root, "trades", start="1970-01-02").count() == 2
    assert lake.present_dates(spark, root, "trades").count() == 2


def test_rearrange_keeps_all_rows(spark, tmp_path):
    wrong = rows(spark, [0, DAY, DAY + 5]).withColumn("dt", F.lit("1970-01-01").cast("date"))
    wrong.write.partitionBy("symbol", "dt").parquet(lake.path(str(tmp_path / "a"), "bronze", "trades"))
    moved = lake.rearrange(spark, str(tmp_path / "a"), "trades", str(tmp_path / "b")).first()
    got = lake.read(spark, str(tmp_path / "b"), "trades")
    assert (moved["moved"], moved["total"], got.count(), got.select("dt").distinct().count()) == (2, 3, 3, 2)


def test_zipped_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("t.csv", "instrument_name,trade_id,side,price,size,created_time\nX,1,buy,1.5,2,10\nX,bad,buy,1,1,11\n")
    got = archives.zipped_csv(spark, str(tmp_path), "trades").collect()
    assert len(got) == 1 and got[0]["price"] == 1.5


def test_book_archives(spark, tmp_path):
    level = [["1.5", "2", "0"]] * 60
    lines = "\n".join([json.dumps({"instId": "X", "action": "snapshot", "ts": "5", "asks": level, "bids": level}), "{broken", json.dumps({"ts": "6", "asks": [], "bids": level})])
    table = "ts,bids,asks\n7,\"[[\"\"1\"\",\"\"2\"\"],[\"\"0.5\"\",\"\"1\"\"]]\",\"[[\"\"3\"\",\"\"4\"\"]]\"\n"
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as tar:
        for name, text in (("b.data", lines), ("c.csv", table)):
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    got = {r["ts"]: r for r in archives.book_archives(spark, str(tmp_path), "X").collect()}
    assert sorted(got) == [5, 7] and len(json.loads(got[5]["asks"])) == 50 and json.loads(got[7]["bids"])[1] == ["0.5", "1"]
    assert book.features(archives.book_archives(spark, str(tmp_path), "X")).count() == 2


def pages(feed, symbol, interval, after):
    """A transport for tests: one trade a millisecond, newest first."""
    return [{"tradeId": str(t), "side": "buy", "px": "1", "sz": "2", "ts": str(t)} for t in range(after - 1, max(-1, after - 1 - rest.PAGE), -1)]


def test_backfill(monkeypatch):
    r = rest.HistoryReader({"feed": "trades", "symbol": "X", "transport": "tests_transport.pages", "gaps": "[[10, 250], [400, 401]]"})
    import sys
    import types

    module = types.ModuleType("tests_transport")
    module.pages = pages
    monkeypatch.setitem(sys.modules, "tests_transport", module)
    got = [[x[5] for x in r.read(p)] for p in r.partitions()]
    assert sorted(got[0]) == list(range(10, 251)) and sorted(got[1]) == [400, 401]
    assert rest.normalise("trades", "X", {"tradeId": "x"}) is None


def message(i, ts):
    return json.dumps({"arg": {"channel": "trades", "instId": "X"}, "data": [{"tradeId": str(i), "side": "buy", "px": "1.5", "sz": "2", "ts": str(ts)}]})


def test_live_equals_batch(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "lake")
    src.mkdir()
    sent = [message(i, 1_704_067_200_000 + i * 60_000) for i in range(30)]  # a watermark begins at 0, so not there
    (src / "a.txt").write_text("\n".join([*sent[:20], "garbage"]))
    (src / "b.txt").write_text("\n".join(sent[10:]))
    stream = live.parse(spark.readStream.format("text").load(str(src)), "trades")
    live.to_bronze(stream, root, "trades", str(tmp_path / "c1"), symbol="X", available_now=True).awaitTermination()
    got = lake.read(spark, root, "trades")
    assert got.count() == 30
    w = live.windows(live.once(live.parse(spark.readStream.format("text").load(str(src)), "trades"), "trades"), "15m")
    q = w.writeStream.format("memory").queryName("live_windows").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = {r["window_end"]: r["trade_count"] for r in spark.table("live_windows").collect()}
    batch = {r["window_end"]: r["trade_count"] for r in trades.aggregate(got, "15m", ["flow"]).collect()}
    assert seen and all(batch[k] == n for k, n in seen.items() if k in batch)


def test_candles_end_with_their_last_values(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k, close in enumerate(("1", "2")):
        (src / f"{k}.txt").write_text(json.dumps({"arg": {"channel": "mark-price-candle1m", "instId": "X"}, "data": [["60000", "1", "3", "0.5", close]]}))
        stream = live.parse(spark.readStream.format("text").load(str(src)), "markPriceKlines")
        live.to_bronze(stream, str(tmp_path / "l"), "markPriceKlines", str(tmp_path / "c"), symbol="X", interval="1m", available_now=True).awaitTermination()
    assert [r["close"] for r in lake.read(spark, str(tmp_path / "l"), "markPriceKlines").collect()] == [2.0]


def test_fixtures_have_both_sides(spark, sf):
    assert fixtures.book_feed(spark, sf).where("action = 'update'").count() > 0


def test_unreadable_files_are_left_out_and_told(spark, tmp_path):
    root = str(tmp_path)
    lake.write(rows(spark, [0, DAY]), root, "trades")
    bad = tmp_path / "bronze" / "trades" / "symbol=X" / "dt=1970-01-02"
    (bad / "bad.parquet").write_bytes(b"no parquet at all")
    (bad / "empty.parquet").write_bytes(b"")
    assert lake.read(spark, root, "trades", skip_unreadable=True).count() == 2
    assert [r["path"].rsplit("/", 1)[1] for r in lake.unreadable(spark, root, "trades").collect()] == ["bad.parquet"]


def test_repair_with_backup_and_clean_source(spark, tmp_path):
    root, target = str(tmp_path / "a"), str(tmp_path / "b")
    wrong = rows(spark, [DAY, DAY, DAY + 5]).withColumn("trade_id", F.lit(1).cast("long")).unionByName(rows(spark, [0, DAY + 9])).withColumn("dt", F.when(F.col("created_time") == DAY + 9, F.lit("1970-01-02").cast("date")).otherwise(F.lit("1970-01-01").cast("date")))
    wrong = wrong.withColumn("dt", F.when(F.col("created_time") == 0, F.lit("1970-01-05").cast("date")).otherwise(F.col("dt")))
    wrong.write.partitionBy("symbol", "dt").parquet(lake.path(root, "bronze", "trades"))
    got = lake.repair(spark, root, target, version="v1", clean=True).collect()
    assert [tuple(r) for r in got] == [("trades", 5, 4, 1, 3, 2)]
    assert lake.read(spark, target, "trades").groupBy("trade_id").count().where("count > 1").isEmpty()
    assert lake.read(spark, root, "trades", "_backup/v1").count() == 5
    assert {str(r["dt"]) for r in lake.read(spark, root, "trades").select("dt").distinct().collect()} == {"1970-01-02"}


TRANSPORT = """
import json

def pages(feed, symbol, interval, after):
    # ten trades a millisecond, newest first; some pages hold a record that doesn't parse
    out = []
    t = after - 1
    while t >= 0 and len(out) < 100:
        for k in range(9, -1, -1):
            if len(out) < 100:
                out.append({"tradeId": str(t * 10 + k), "side": "buy", "px": "bad" if (t, k) == (30, 3) else "1", "sz": "2", "ts": str(t)})
        t -= 1
    return out

def broken(feed, symbol, interval, after):
    return [{"tradeId": "x"}] * 100

def exists(date):
    if date.endswith("05"):
        raise OSError("gone")
    return date != "2024-01-02"

SENT = [json.dumps({"arg": {"channel": "trades", "instId": "X"}, "data": [{"tradeId": str(i), "side": "buy", "px": "1.5", "sz": "2", "ts": str(1704067200000 + i * 60000)}]}) for i in range(30)]
failures = [2]

def receive(subscription, offset):
    assert json.loads(subscription)["args"] == [{"channel": "trades", "instId": "X"}]
    if failures[0]:
        failures[0] -= 1
        raise OSError("lost")
    part = SENT[offset : offset + 7]
    return part, offset + len(part)
"""


def transport(spark, tmp_path, monkeypatch):
    import os
    import sys

    (tmp_path / "exchange_transport.py").write_text(TRANSPORT)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "exchange_transport.py"))
    monkeypatch.setitem(spark.sparkContext.environment, "PYTHONPATH", os.pathsep.join([str(tmp_path), *(p for p in sys.path if p)]))


def test_backfill_through_spark_with_many_rows_a_millisecond(spark, tmp_path, monkeypatch):
    transport(spark, tmp_path, monkeypatch)
    got = [r["trade_id"] for r in rest.backfill(spark, "trades", [(5, 45), (60, 61)], "exchange_transport.pages", "X").collect()]
    want = [t * 10 + k for t in [*range(5, 46), 60, 61] for k in range(10) if (t, k) != (30, 3)]
    assert sorted(got) == want
    reader = rest.HistoryReader({"feed": "trades", "transport": "exchange_transport.broken", "gaps": "[[0, 10]]"})
    import pytest

    with pytest.raises(ValueError, match="without a time"):
        list(reader.read(reader.partitions()[0]))


def test_what_is_fetched(spark, tmp_path, monkeypatch):
    transport(spark, tmp_path, monkeypatch)
    root = str(tmp_path / "lake")
    days = lambda df: sorted(str(r["dt"]) for r in df.collect())
    assert len(days(rest.wanted(spark, root, "trades", "2024-01-01", "2024-01-06"))) == 6
    lake.write(rows(spark, [1_704_067_200_000, 1_704_067_200_000 + 2 * DAY]), root, "trades")
    want = rest.wanted(spark, root, "trades", "2024-01-01", "2024-01-06")
    assert days(want) == ["2024-01-02", "2024-01-04", "2024-01-05", "2024-01-06"]
    assert days(rest.available(spark, want, "exchange_transport.exists")) == ["2024-01-04", "2024-01-06"]
    book = spark.createDataFrame([("X", "snapshot", 1_704_067_200_000, "[]", "[]")], lake.SCHEMAS["orderBook"]).withColumn("symbol", F.lit("X"))
    lake.write(book, root, "orderBook")
    assert days(rest.wanted(spark, root, "orderBook", "2024-01-01", "2024-01-01")) == ["2024-01-01"]  # too small to be whole
    calls, pauses = [], []

    def once_failing():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("down")

    assert rest.monitor(once_failing, 3, pauses.append) == 1 and pauses == [rest.POLL, rest.POLL_FAILED]


def test_live_source_reconnects(spark, tmp_path, monkeypatch):
    transport(spark, tmp_path, monkeypatch)
    monkeypatch.setattr(live, "BACKOFF", 0.01)
    reader = live.LiveReader({"feed": "trades", "symbol": "X", "transport": "exchange_transport.receive"})
    got, at = [], reader.initialOffset()
    while True:
        part, after = reader.read(at)
        got += [m for (m,) in part]
        if after == at:
            break
        at = after
    assert len(got) == 30 and [m for (m,) in reader.readBetweenOffsets({"at": 7}, {"at": 20})] == got[7:20]
    root = str(tmp_path / "lake")
    q = live.to_bronze(live.parse(live.subscribe(spark, "trades", "exchange_transport.receive", "X"), "trades"), root, "trades", str(tmp_path / "c"), symbol="X")
    live.finish(q)
    assert lake.read(spark, root, "trades").count() == 30 and not q.isActive
    assert len(json.loads(live.subscription("markPriceKlines", "X"))["args"]) == 6


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "lake")
    src.mkdir()
    base = 1_704_067_200_000
    (src / "a.txt").write_text("\n".join(message(i, base + i * 60_000) for i in (0, 100, 101)))
    stream = live.parse(spark.readStream.format("text").load(str(src)), "trades")
    live.to_bronze(stream, root, "trades", str(tmp_path / "c"), symbol="X", available_now=True, late_ms=600_000).awaitTermination()
    assert lake.read(spark, root, "trades").count() == 2 and lake.read(spark, root, "trades", "late").count() == 1
    assert live.merge_late(spark, root, "trades") == 1 and lake.read(spark, root, "trades").count() == 3


def test_inter_arrival_on_a_stream_is_that_of_the_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    base = 1_704_067_200_000
    times = [base + i * 7_001 + (i % 5) * 900 for i in range(400)]
    (src / "a.txt").write_text("\n".join(message(i, t) for i, t in enumerate(times)))
    (src / "b.txt").write_text(message(9999, base + 7_200_000))
    stream = live.once(live.parse(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(src)), "trades"), "trades")
    q = live.inter_arrival(stream).writeStream.format("memory").queryName("gaps_live").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    names = ["window_end", "rate_mean_ms_trade", "rate_std_ms_trade", "rate_max_ms_trade", "rate_min_ms_trade"]
    got = {r["window_end"]: tuple(r) for r in spark.table("gaps_live").select(*names).collect()}
    batch = trades.aggregate(rows(spark, times), "5m", ["rate"]).select(*names)
    want = {r["window_end"]: tuple(r) for r in batch.collect()}
    assert got and all(abs(a - b) < 1e-6 for k in got for a, b in zip(got[k], want[k], strict=True))
