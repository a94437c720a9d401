"""Mixing sources to target weights by a time-varying curriculum, with DataFrame functions alone.

Each source has a weight schedule over training time 0..1 (piecewise linear).
Its integral, scaled to the source's target, is the source's cumulative demand;
the demand's inverse tells when the words at some place of the source's stream
are due.  A source's stream is its documents in hashed order, once or more
often until the target is met; the document in which the target falls is taken
in part.  The mix is the documents of all streams, range-sorted by the time at
which their middle is due.

Places in a stream are prefix sums in two levels (hashed buckets of a source,
then rows of a bucket), so a source with any share of the rows is spread over
many tasks.  All of that is done on ids, sizes and hashes, which are written
once; texts are read for their sizes, and once more where they are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import GAP, WORD, materialize, table

CYCLE = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2.0
#: (time, weight) points of each class of the cycle; only the shape counts, not the height.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)))
#: Hashed buckets of a source are 2 to this power at least, and so many that a bucket holds this many rows, about; each is ordered for itself.
BUCKET_BITS, BUCKET_ROWS = 12, 16384


def size_of(text: Column) -> Column:
    """Words in a text: gaps inside it and one more; null, empty and blank texts have none."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{GAP}|{GAP}$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.regexp_count(t, F.lit(GAP)) + 1).cast("long")


def targets(sizes: DataFrame, cycle: Sequence[float] = CYCLE, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``sizes`` (source, source_size, rows: one row a source) with rank, class and target.

    Sources in code-point order, null last, weigh as the cycle says.  They share
    ``share`` of all words by weight; a source stops at ``limit`` times its own
    and the excess goes to the others by weight: water filling, whose level is
    found in closed form by ordering sources by ``limit * size / weight``.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    classes = F.array(*[F.lit(float(w)) for w in cycle])
    w = ranked.withColumn("class", (F.col("rank") % len(cycle)).cast("int")).withColumn("_w", F.get(classes, F.col("class")))
    w = w.withColumn("_cap", F.lit(float(limit)) * F.col("source_size"))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), "rank")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (
        w.withColumn("_all", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing)))
    )
    # a source is capped if, with all before it capped, an even level would lift it above its cap
    w = w.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_open"))
    w = w.withColumn("_over", F.col("_level") * F.col("_w") >= F.col("_cap"))
    w = w.withColumn("_final", F.min(F.when(~F.col("_over"), F.struct(F.col("_cap") / F.col("_w"), "rank", "_level"))).over(every)["_level"])
    return w.withColumn("target", F.when(F.col("_over") | F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_final") * F.col("_w")))).select(
        "source", "source_size", "rows", "rank", "class", "target"
    )


def due(part: Column, points: Sequence[tuple[float, float]]) -> Column:
    """When the given part (0..1) of a schedule's whole demand has come due: the inverse of its integral."""
    if len(points) < 2 or points[0][0] != 0 or points[-1][0] != 1 or any(w < 0 for _, w in points) or any(b[0] <= a[0] for a, b in zip(points, points[1:], strict=False)):
        raise ValueError("a schedule runs from time 0 to 1 with weights of 0 or more")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False)]
    total, at, out, later = sum(areas), 0.0, None, 1.0
    if total <= 0:
        raise ValueError("a schedule needs some weight")
    for (t0, w0), (t1, w1), area in reversed(list(zip(points, points[1:], areas, strict=False))):
        at += area
        start = (total - at) / total
        if area == 0:
            continue
        d = F.greatest(part - F.lit(start), F.lit(0.0)) * F.lit(total)  # weight-time since t0
        slope = (w1 - w0) / (t1 - t0)
        x = d / F.lit(w0) if slope == 0 else F.lit(2.0) * d / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * d, F.lit(1e-300))))
        here = F.least(F.lit(t0) + x, F.lit(t1))
        out = here if out is None else F.when(part >= F.lit(later), out).otherwise(here)
        later = start
    return out


def _key(docs: DataFrame, text: str, source: str) -> tuple[Column, Column, Column, Column, Column]:
    """Of each row: doc_id, source, size, a hash of the text, and a string that says all four."""
    body = F.col(f"`{text}`").cast("string")
    doc, src, size, h = F.col("doc_id").cast("long"), F.col(f"`{source}`").cast("string"), size_of(body), F.xxhash64(body)
    name = F.concat_ws("|", F.coalesce(doc.cast("string"), F.lit("-")), size.cast("string"), h.cast("string"), F.concat(F.when(src.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(src, F.lit(""))))
    return doc, src, size, h, name


def entries(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    cycle: Sequence[float] = CYCLE,
    share: float = SHARE,
    limit: float = LIMIT,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    seed: int = 0,
) -> DataFrame:
    """key, doc_id, source, size, copies, source_size, target, takes: one row for all rows of ``docs`` that agree in the
    first four; ``takes`` has a list for each of them, as told in mix()."""
    doc, src, size, h, name = _key(docs, text, source)
    slim = docs.select(doc.alias("doc_id"), src.alias("source"), size.alias("size"), h.alias("_t"), name.alias("key"))
    slim = slim.groupBy(*slim.columns).agg(F.count("*").alias("copies"))
    order = F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), F.lit(16))
    slim = materialize(slim.withColumn("_h", order), "mix")
    bits = max(BUCKET_BITS, (slim.count() // BUCKET_ROWS).bit_length())
    # first level: a source's hashed buckets
    rows = slim.withColumn("_c", F.shiftright(F.conv(F.left("_h", F.lit(8)), 16, 10).cast("long"), 32 - bits).cast("int"))
    fine = materialize(rows.groupBy("source", "_c").agg(F.sum(F.col("size") * F.col("copies")).alias("_s"), F.sum("copies").alias("_n")), "mix")
    sizes = fine.groupBy("source").agg(F.sum("_s").alias("source_size"), F.sum("_n").alias("rows"))
    goal = targets(sizes, cycle, share, limit).select(F.col("source").alias("_g"), "source_size", "class", "target")
    ahead = F.coalesce(F.sum("_s").over(Window.partitionBy("source").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead")
    edges = fine.select(F.col("source").alias("_s2"), F.col("_c").alias("_c2"), ahead)
    edges = edges.join(goal, F.col("_s2").eqNullSafe(F.col("_g"))).drop("_g")
    within = Window.partitionBy("source", "_c").orderBy("_h", "doc_id", "size", "_t")
    words = F.col("size") * F.col("copies")
    placed = rows.withColumn("_in", F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, 0)) - words)
    placed = placed.join(edges, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_c") == F.col("_c2")))
    goal_words = F.round("target").cast("long")

    def takes(copy: Column) -> Column:
        out = []
        for k in range(-(-int(limit * 1000) // 1000)):
            begin = F.col("_ahead") + F.col("_in") + copy * F.col("size") + F.col("source_size") * k
            n = F.greatest(F.least(F.col("size"), goal_words - begin), F.lit(0))
            middle = (begin + n / 2) / F.greatest(goal_words, F.lit(1))
            when = F.coalesce(*[F.when(F.col("class") == i, due(middle, p)) for i, p in ((j, schedules[j % len(schedules)]) for j in range(len(cycle)))])
            out.append(F.struct(n.alias("words"), when.alias("position")))
        return F.filter(F.array(*out), lambda x: x["words"] > 0)

    return placed.select("key", "doc_id", "source", "size", "copies", "source_size", "target", F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), takes).alias("takes"))


def _taken(takes: str) -> Column:
    return F.aggregate(takes, F.lit(0).cast("long"), lambda s, x: s + x["words"])


def mix(docs: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """All columns of ``docs`` and size, source_size, target, taken, takes; ``options`` are those of entries().

    ``takes`` lists, for each time the mix comes to the document, the words it takes
    (all, but for the one document in which a source's target falls) and the position
    (0..1) at which they are trained on.  ``taken`` is the sum.  A document of no words
    (null, empty and blank texts) takes no part; null is a source like any other, the last.  Rows are ordered by
    a hash of doc_id, then by doc_id, size and the text's hash, so runs agree; rows that agree in all of them and
    the source swap nothing that shows.  Whole texts count, however long.  An empty table gives no rows.
    Columns of ``docs`` that bear a result's name are replaced; any other names may occur.
    """
    listed = materialize(entries(docs, text, source, **options), "mix")
    made = ["size", "source_size", "target", "taken", "takes"]
    keep = [c for c in docs.columns if c.lower() not in made]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_l{i}") for i, c in enumerate(keep)], _key(docs, text, source)[4].alias("_key"))
    out = rows.join(listed.select(F.col("key"), "size", "source_size", "target", F.col("takes").alias("_all")), F.col("_key") == F.col("key"))
    # rows of one key already lie together after the join
    nth = F.lit(1) if listed.where("copies > 1").isEmpty() else F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    out = out.withColumn("takes", F.element_at("_all", nth))
    return out.select(*[F.col(f"_l{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target", _taken("takes").alias("taken"), "takes")


def stream(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: one row for each take, range-sorted by position, texts cut where a take is in part.

    Columns of ``mix()`` but ``takes``, and words, position; columns of these names are replaced.  Rows that take
    nothing (null and empty texts among them) give none; equal positions are ordered by doc_id and words.
    """
    out = mixed.withColumn("takes", F.explode("takes")).withColumn("words", F.col("takes.words")).withColumn("position", F.col("takes.position"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"(?:^{GAP})?{WORD}(?:{GAP})?"), F.lit(0)), F.lit(1), F.col("words").cast("int")), "")
    out = out.withColumn(text, F.when(F.col("words") < F.col("size"), part).otherwise(F.col(f"`{text}`")))
    return out.drop("takes").orderBy("position", "doc_id", "words")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entries(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).withColumn("takes", F.explode("takes"))
    first = F.get("takes", F.lit(0))["position"]
    return mixed.select("doc_id", "size", "source_size", "target", _taken("takes").alias("taken"), first.alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    left(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 16) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, k % 3 AS class, CAST([5, 2, 1][k % 3 + 1] AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS cap FROM r),
l AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
    sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w),
f AS (SELECT min_by(free / open, {'a': cap / w, 'b': k}) AS level FROM l WHERE free / open * w < cap),
t AS (
  SELECT source, source_size, class, CASE WHEN free / open * w >= cap OR level IS NULL THEN cap ELSE least(cap, level * w) END AS target
  FROM l CROSS JOIN f),
p AS (
  SELECT d.doc_id, size, source_size, target, class, CAST(round(target) AS BIGINT) AS goal,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (
  SELECT *, greatest(least(size, goal - pos), 0) AS n0, greatest(least(size, goal - pos - source_size), 0) AS n1 FROM p),
m AS (SELECT *, (pos + CAST(n0 AS DOUBLE) / 2) / CAST(greatest(goal, 1) AS DOUBLE) AS x FROM n)
SELECT doc_id, size, source_size, target, CAST(n0 + n1 AS BIGINT) AS taken,
  CASE WHEN n0 = 0 THEN NULL
    WHEN class = 0 THEN least(2 * x / (CAST(1.5 AS DOUBLE) + sqrt(greatest(CAST(2.25 AS DOUBLE) - 2 * x, CAST(1e-300 AS DOUBLE)))), 1)
    WHEN class = 1 THEN least(x, 1)
    WHEN x >= CAST(0.25 AS DOUBLE) THEN least(CAST(0.5 AS DOUBLE) + 2 * (x - CAST(0.25 AS DOUBLE)) / (CAST(0.5 AS DOUBLE) + sqrt(CAST(0.25 AS DOUBLE) + 8 * (x - CAST(0.25 AS DOUBLE)))), 1)
    ELSE least(x / CAST(0.5 AS DOUBLE), CAST(0.5 AS DOUBLE)) END AS position
FROM m
"""
