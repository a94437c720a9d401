"""Daily and monthly archives: zipped CSV of trades and funding, tarred books as JSON lines or CSV."""

from __future__ import annotations

import csv
import io
import json
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.book import LEVELS

from .lake import SCHEMAS

#: Rows that a task holds at once while it unpacks an archive.
CHUNK = 20_000


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")


def zipped_csv(spark: SparkSession, path: str, feed: str, glob: str = "*.zip") -> DataFrame:
    """Rows of all CSV files with a header in zip archives; names are matched, values cast, rows that don't fit dropped."""
    names = [f.split()[0] for f in SCHEMAS[feed].split(", ")]

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for entry in z.namelist():
                        if entry.endswith(".csv"):
                            with z.open(entry) as raw:
                                for part in pd.read_csv(raw, dtype=str, chunksize=CHUNK):
                                    yield part.reindex(columns=names)

    raw = _files(spark, path, glob).mapInPandas(unpack, ", ".join(f"{n} string" for n in names))
    typed = raw.select(*[F.col(n).try_cast(t).alias(n) for n, t in (f.split() for f in SCHEMAS[feed].split(", "))])
    return typed.dropna(subset=[n for n, t in (f.split() for f in SCHEMAS[feed].split(", ")) if t == "bigint"])


def book_archives(spark: SparkSession, path: str, instrument: str, glob: str = "*.tar.gz", levels: int = LEVELS) -> DataFrame:
    """Snapshots from tarred books: members of JSON lines, or CSV of ts, bids, asks (quoted JSON).

    Sides are cut to the first ``levels``; rows with an empty side or that don't parse are dropped.
    """

    def rows(member: io.BufferedIOBase, name: str) -> Iterator[tuple]:
        text = io.TextIOWrapper(member, "utf-8", errors="replace")
        if name.endswith(".csv"):
            for r in csv.reader(text):
                if len(r) == 3 and r[0] != "ts":
                    yield instrument, "snapshot", r[0], r[2], r[1]
            return
        for line in text:
            try:
                d = json.loads(line)
            except ValueError:
                continue
            yield d.get("instId", instrument), d.get("action", "snapshot"), str(d.get("ts")), json.dumps(d.get("asks") or []), json.dumps(d.get("bids") or [])

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["instId", "action", "ts", "asks", "bids"]
        for frame in frames:
            for content in frame["content"]:
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    for m in tar:
                        if not m.isfile():
                            continue
                        held: list[tuple] = []
                        for r in rows(tar.extractfile(m), m.name):
                            held.append(r)
                            if len(held) >= CHUNK:
                                yield pd.DataFrame(held, columns=columns)
                                held = []
                        if held:
                            yield pd.DataFrame(held, columns=columns)

    raw = _files(spark, path, glob).mapInPandas(unpack, "instId string, action string, ts string, asks string, bids string")
    sides = {s: F.slice(F.from_json(s, "array<array<string>>"), 1, levels) for s in ("asks", "bids")}
    out = raw.select("instId", "action", F.col("ts").try_cast("bigint").alias("ts"), *[x.alias(s) for s, x in sides.items()])
    full = out.where((F.size("asks") > 0) & (F.size("bids") > 0) & F.col("ts").isNotNull())
    return full.select("instId", "action", "ts", F.to_json("asks").alias("asks"), F.to_json("bids").alias("bids"))
