"""The lake: Parquet under layer/dataset, partitioned by symbol, interval and UTC date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidelake.operators.bronze import dedupe, duplicate_report, event_date, merge_rows

#: Bronze columns, event time and key of each feed.  Fixed values.
SCHEMAS = {
    "trades": "instrument_name string, trade_id bigint, side string, price double, size double, created_time bigint",
    "orderBook": "instId string, action string, ts bigint, asks string, bids string",
    "indexPriceKlines": "open_time bigint, open double, high double, low double, close double",
    "markPriceKlines": "open_time bigint, open double, high double, low double, close double",
    "fundingRate": "instrument_name string, funding_rate double, funding_time bigint",
}
TIMES = {"trades": "created_time", "orderBook": "ts", "indexPriceKlines": "open_time", "markPriceKlines": "open_time", "fundingRate": "funding_time"}
KEYS = {"trades": ["trade_id"], "orderBook": ["ts"], "indexPriceKlines": ["open_time"], "markPriceKlines": ["open_time"], "fundingRate": ["funding_time"]}
#: The partition columns that each feed has besides the date.
PARTS = {"trades": ["symbol"], "orderBook": ["symbol"], "indexPriceKlines": ["symbol", "interval"], "markPriceKlines": ["symbol", "interval"], "fundingRate": ["symbol"]}


def conform(df: DataFrame, feed: str) -> DataFrame:
    """The feed's columns in their declared types and order, partition columns after them; a value that doesn't fit becomes null."""
    want = T._parse_datatype_string(SCHEMAS[feed])
    extra = [c for c in df.columns if c in (*PARTS[feed], "dt")]
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in want.fields], *extra)


def path(root: str, layer: str, feed: str) -> str:
    return f"{root}/{layer}/{feed}"


def read(spark: SparkSession, root: str, feed: str, layer: str = "bronze", start: str | None = None, end: str | None = None, skip_unreadable: bool = False) -> DataFrame:
    """A feed, pruned to dates from start to end (inclusive) where given.

    A file that can't be read fails the job; with ``skip_unreadable`` (bronze only, whose columns are
    declared) it is left out, and unreadable() tells which files that are.
    """
    if skip_unreadable:
        kinds = ", ".join([SCHEMAS[feed], *(f"{p} string" for p in PARTS[feed]), "dt date"])
        df = spark.read.schema(kinds).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(path(root, layer, feed))
    else:
        df = spark.read.parquet(path(root, layer, feed))
    if start:
        df = df.where(F.col("dt") >= F.lit(start).cast("date"))
    return df.where(F.col("dt") <= F.lit(end).cast("date")) if end else df


def write(df: DataFrame, root: str, feed: str, layer: str = "bronze", mode: str = "append", time: str | None = None, parts: Sequence[str] | None = None) -> None:
    """Rows into the partitions that their own times name, one set of files for each."""
    parts = [*(PARTS[feed] if parts is None else parts), "dt"]
    placed = df.withColumn("dt", event_date(F.col(time or TIMES[feed])))
    placed.repartition(*parts).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path(root, layer, feed))


def upsert(new: DataFrame, root: str, feed: str, layer: str = "bronze", keep: str = "last") -> None:
    """Merge rows by key into the partitions they belong to; other partitions aren't read or written.

    The merged partitions go to a staging folder first, since a path can't be read and
    overwritten by one job; writing the same rows twice changes nothing.
    """
    spark = new.sparkSession
    parts = [*PARTS[feed], "dt"]
    rows = conform(new, feed).withColumn("dt", event_date(F.col(TIMES[feed])))
    touched = rows.select(*parts).distinct()
    try:
        old = spark.read.parquet(path(root, layer, feed)).join(touched, parts, "left_semi").select(*rows.columns)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = None
    staging = path(root, "_staging", feed)
    merge_rows(old, rows, [*KEYS[feed], *parts], keep).write.mode("overwrite").parquet(staging)
    done = spark.read.schema(rows.schema).parquet(staging)
    done.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path(root, layer, feed))


def files(spark: SparkSession, root: str, feed: str, layer: str = "bronze") -> DataFrame:
    """path, bytes and the last eight bytes of each Parquet file on file."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path(root, layer, feed))
    return raw.select("path", F.col("length").alias("bytes"), F.expr("right(hex(substring(content, -8)), 16)").alias("tail"))


def unreadable(spark: SparkSession, root: str, feed: str, layer: str = "bronze") -> DataFrame:
    """path and bytes of files that don't end as Parquet files do; files of no bytes hold no rows and are passed over."""
    return files(spark, root, feed, layer).where(~F.col("tail").endswith("50415231")).select("path", "bytes")


def rearrange(spark: SparkSession, root: str, feed: str, target: str, layer: str = "bronze", clean: bool = False) -> DataFrame:
    """Rewrite a feed into a new root with every row under its own date; moved, total: what it did.

    With ``clean``, dates of the source that held no row of their own are deleted once the new root is written
    and holds as many rows.
    """
    df = spark.read.parquet(path(root, layer, feed))
    own = event_date(F.col(TIMES[feed]))
    moved = df.agg(F.count_if(F.col("dt") != own).alias("moved"), F.count(F.lit(1)).alias("total")).first()
    write(df.drop("dt"), target, feed, layer, "overwrite")
    if clean:
        if read(spark, target, feed, layer).count() != moved["total"]:
            raise RuntimeError("the new root holds another number of rows; nothing is deleted")
        parts = [*PARTS[feed], "dt"]
        strangers = df.groupBy(*parts).agg(F.count_if(own == F.col("dt")).alias("n")).where("n = 0").select(*parts)
        for r in strangers.toLocalIterator():  # one row a partition folder
            _delete(spark, "/".join([path(root, layer, feed), *(f"{p}={r[p]}" for p in parts)]))
    return spark.createDataFrame([(moved["moved"], moved["total"])], "moved long, total long")


def _delete(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def backup(spark: SparkSession, root: str, feed: str, version: str, layer: str = "bronze") -> str:
    """Copies a feed, partitions and all, to a folder named by the version; the folder."""
    to = path(root, f"_backup/{version}", feed)
    spark.read.parquet(path(root, layer, feed)).write.mode("errorifexists").partitionBy(*PARTS[feed], "dt").parquet(to)
    return to


def repair(spark: SparkSession, root: str, target: str, feeds: Sequence[str] = tuple(SCHEMAS), keep: str = "first", version: str | None = None, clean: bool = False) -> DataFrame:
    """Repairs each feed on file, in order: backup (if a version is given), rows under their own dates, duplicates out.

    feed, total, moved, duplicate_keys, duplicate_rows, kept: one row a feed that is on file.
    """
    out = []
    for feed in feeds:
        try:
            spark.read.parquet(path(root, "bronze", feed))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            continue
        if version is not None:
            backup(spark, root, feed, version)
        done = rearrange(spark, root, feed, f"{target}/_staging", clean=clean).first()
        staged = read(spark, f"{target}/_staging", feed)
        key = [*KEYS[feed], *PARTS[feed]]
        twice = duplicate_report(staged, key).first()
        write(dedupe(staged, key, [TIMES[feed]], keep).drop("dt"), target, feed, mode="overwrite")
        out.append((feed, done["total"], done["moved"], twice["duplicate_keys"], twice["duplicate_rows"], read(spark, target, feed).count()))
        _delete(spark, path(f"{target}/_staging", "bronze", feed))
    return spark.createDataFrame(out, "feed string, total long, moved long, duplicate_keys long, duplicate_rows long, kept long")


def present_dates(spark: SparkSession, root: str, feed: str, layer: str = "bronze") -> DataFrame:
    """Dates on file with their bytes, from file metadata."""
    df = spark.read.parquet(path(root, layer, feed))
    return df.select("dt", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct().groupBy("dt").agg(F.sum("b").alias("bytes"))
