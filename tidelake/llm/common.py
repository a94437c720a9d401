"""What the operators share: tables, shared folder, Python path of the workers, word rule."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of rows that a Python worker gets at once, where the session leaves Spark's default (64 MB) alone.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


#: What makes idle Python workers give memory back: large arrays are mapped apart, and Arrow's come from the same allocator.
GIVE_BACK = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package (clusters ship it with --py-files), bound their batches in
    bytes, and have them give back what they no longer use."""
    for k, v in GIVE_BACK.items():
        spark.sparkContext.environment.setdefault(k, v)
    if spark.conf.get(BATCH[0]) == BATCH[1]:
        spark.conf.set(BATCH[0], BATCH[2])
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or where unset a folder of our own, if the master is local (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='tidelake-')}"
        spark.sparkContext.setCheckpointDir(at)
    return at


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors, and
    drops this job's shuffle files, which nothing reads again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of materialize() that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    base = shared_dir(spark)
    for f in df.inputFiles():
        if "/tables/" in f:
            p = jvm.org.apache.hadoop.fs.Path(f).getParent()
            if str(p.toString()).startswith(base.replace("file://", "file:")) or base in str(p.toString()):
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                return


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def attach(docs: DataFrame, keys: dict[str, Column], found: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``found`` (one row for each key at most) that are no keys; null where there is none.

    ``keys`` says what of ``docs`` each key column of ``found`` must equal.  Columns of ``docs`` that bear an added
    column's name are replaced; any other names may clash.
    """
    added = [c for c in found.columns if c not in keys]
    keep = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    left = docs.select(*[F.col(f"`{c}`").alias(f"_l{i}") for i, c in enumerate(keep)], *[k.alias(f"_k{i}") for i, k in enumerate(keys.values())])
    right = found.select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)], *[F.col(f"`{a}`").alias(f"_a{i}") for i, a in enumerate(added)])
    out = left.join(right, [F.col(f"_k{i}") == F.col(f"_f{i}") for i in range(len(keys))], "left")
    return out.select(*[F.col(f"_l{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"_a{i}").alias(a) for i, a in enumerate(added)])


#: Slots by which rows are counted to find hot keys; a slot is hot if it holds this many times an even share, and rows enough.
SLOTS, HOT, HOT_ROWS = 4096, 8, 2048


def hot_parts(rows: DataFrame, key: str) -> dict[int, int]:
    """Into how many parts the rows of each hot slot of ``key`` go; at most SLOTS / HOT of them.

    Counts are by hashed slot, so what reaches the driver is bounded however many keys there are.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    counts = {r[0]: r[1] for r in rows.groupBy(slot.alias("s")).agg(F.count("*")).collect()}
    even = max(HOT_ROWS, HOT * sum(counts.values()) // SLOTS)
    return {s: -(-2 * n // even) for s, n in counts.items() if n > even}


def salted(rows: DataFrame, key: str, spread: str, parts: dict[int, int]) -> DataFrame:
    """``rows`` with _salt, which spreads the rows of hot slots by a hash of ``spread``, and _hot."""
    if not parts:
        return rows.withColumn("_salt", F.lit(0)).withColumn("_hot", F.lit(False))
    told = F.broadcast(rows.sparkSession.createDataFrame(sorted(parts.items()), "_slot int, _parts int"))
    slotted = rows.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")).join(told, "_slot", "left")
    salt = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread, F.lit(3)), F.col("_parts")).cast("int"))
    return slotted.withColumn("_salt", salt).withColumn("_hot", F.col("_parts").isNotNull()).drop("_slot", "_parts")


def skew_join(rows: DataFrame, single: DataFrame, key: str, spread: str) -> DataFrame:
    """Inner join on ``key`` where ``single`` has one row a key and ``rows`` (a written table) may have any number.

    Rows of hot keys are spread by ``spread`` and meet copies of the single row, so no task gets them all.
    """
    parts = hot_parts(rows, key)
    if not parts:
        return rows.join(single, key)
    told = F.broadcast(rows.sparkSession.createDataFrame(sorted(parts.items()), "_slot int, _parts int"))
    copies = single.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")).join(told, "_slot", "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))).drop("_slot", "_parts")
    return salted(rows, key, spread, parts).drop("_hot").join(copies, [key, "_salt"]).drop("_salt")
