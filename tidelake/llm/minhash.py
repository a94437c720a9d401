"""Document fingerprints: one-permutation MinHash with DataFrame functions alone.

Each five-word shingle is hashed once.  The top bits of a hash choose its bin,
and each bin keeps its least hash.  Empty bins are filled by optimal
densification: bin j asks bins h(j, 1), h(j, 2), ... in turn and takes the first
that isn't empty, so two texts with the same bins fill them alike; what it takes
is hashed with j, so that one value borrowed by many bins is another one in each.
Of every bin only the lowest bits are stored, packed into longs; their chance
agreement is taken out of the estimate.

Bins come from one sort: a mark for every bin (the largest value that falls into
it) joins the hashes, and the first value of each bin is its least hash, or the
mark if the bin is empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, words_of

SHINGLE = 5
#: Bins are 2 to this power; a bin keeps this many bits (a divisor of 64 bits in a power of two).
BIN_BITS, KEEP_BITS = 8, 4
BINS = 1 << BIN_BITS
_PER_LONG = 64 // KEEP_BITS
#: Rows in order that one task holds, about.
BUCKET_ROWS = 1024
#: Quantiles of doc_id that guide the buckets; between two of them ids are split evenly.
GUIDES = 256
#: Ranges whose order one task finds, and bytes of text that one task holds, about.
GROUP, TASK_BYTES = 1024, 32 << 20


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, also where f uses it inside a lambda."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_REST = (1 << (64 - BIN_BITS)) - 1
_MARKS = [_signed((b << (64 - BIN_BITS)) | _REST) for b in range(BINS)]
_LOW = (1 << KEEP_BITS) - 1
#: One bit for each stored value: 0x1111... for four bits.
_ONES = sum(1 << (KEEP_BITS * i) for i in range(_PER_LONG))


def _probe(j: Column, t: Column) -> Column:
    """The bin that empty bin j asks at attempt t, for all texts the same."""
    return F.pmod(F.xxhash64(j, t), F.lit(BINS)).cast("int")


def signature(text: Column, shingle: int = SHINGLE) -> Column:
    """array<long>: the packed low bits of all bins; empty for texts without words.

    The whole text counts, however long; a text of fewer words than a shingle is one shingle.
    """

    def of_words(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(1), F.greatest(n - (shingle - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(shingle))))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
            let(F.sort_array(F.concat(hashes, F.array(*[F.lit(m) for m in _MARKS]))), of_sorted)
        )

    def of_sorted(s: Column) -> Column:
        firsts = F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 64 - BIN_BITS) != F.shiftright(F.get(s, i - 1), 64 - BIN_BITS)))
        return let(firsts, of_bins)

    def full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_REST)) != F.lit(_REST)

    def of_bins(v: Column) -> Column:
        def ask(j: Column, a: int, b: int) -> Column:
            return F.get(F.filter(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda t: F.get(v, _probe(j, t))), full), F.lit(0))

        # few attempts nearly always do; after 512 hashed ones the bins are asked in order, so one is found
        def fill(x: Column, j: Column) -> Column:
            taken = F.coalesce(ask(j, 1, 8), ask(j, 9, 64), ask(j, 65, 512), F.get(F.filter(v, full), F.lit(0)))
            return F.when(full(x), x).otherwise(F.xxhash64(taken, j))

        return let(F.transform(v, fill), pack)

    def pack(v: Column) -> Column:
        def one(g: Column) -> Column:
            return F.aggregate(F.slice(v, g * _PER_LONG + 1, F.lit(_PER_LONG)), F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, KEEP_BITS).bitwiseOR(x.bitwiseAND(F.lit(_LOW))))

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), one)

    return let(words_of(text), of_words)


def as_text(sig: Column) -> Column:
    """The signature as lowercase hex; an empty string for texts without words."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two signatures, chance agreement of the low bits taken out.

    Two texts without words are alike (1); one without words is like no other (0).
    """

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for s in (1, 2, 4, 8, 16, 32):
            if s < KEEP_BITS:
                d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        return F.bit_count(d.bitwiseAND(F.lit(_ONES)))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << KEEP_BITS)
    match = F.greatest(F.lit(0.0), (F.lit(1.0) - differ / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1.0 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(match)


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "signature") -> DataFrame:
    """All columns of ``docs`` and the packed signature; null texts count as empty.

    Row by row: repeated rows and equal texts get equal signatures, an empty table gives none, a column
    named like the result is replaced, and other names may clash with nothing.
    """
    return docs.withColumn(name, signature(F.col(f"`{text}`"), shingle))


def _after(keys: DataFrame, key: str) -> DataFrame:
    """(key, then): each key and the next one by order, after the last the first; in two levels, so
    that no task orders more than a group of GROUP numbers, or one row a group."""
    group = F.floor(F.col(key) / GROUP)
    within = Window.partitionBy("_g").orderBy(key)
    rows = keys.select(key, group.alias("_g")).withColumn("_then", F.lead(key).over(within))
    firsts = keys.select(key, group.alias("_g")).groupBy("_g").agg(F.min(key).alias("_first"))
    over = Window.orderBy("_g")
    tops = firsts.select(F.col("_g").alias("_of"), F.coalesce(F.lead("_first").over(over), F.min("_first").over(Window.partitionBy())).alias("_next"))
    return rows.join(tops, F.col("_g") == F.col("_of")).select(key, F.coalesce("_then", "_next").alias("then"))


def with_next(docs: DataFrame, key: str, ties: str, carry: list[str], add: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``add(docs)`` and ``next``: a struct of the ``carry`` columns of the row after it by (key, ties); after the last comes the first.

    ``key`` is a number, nulls first; ``ties`` is a hash (long) that orders rows of one key, and the null ones.
    Of rows equal in both either may come first.  ``add`` makes costly columns row by row; for the first rows of
    ranges, which are read apart, it runs on those alone.  Rows are cut into even ranges of the key, null ones
    into even ranges of ``ties``, so that the text of each row is shuffled once, no task holds more than a few
    ranges, and their number grows with rows and bytes.  Columns named next or _b... must not occur in ``docs``.
    """
    k = F.col(key).cast("double")
    size = sum((F.octet_length(F.col(c)) for c, t in docs.dtypes if t == "string" and c in carry), F.lit(16))
    stats = docs.agg(F.count("*"), F.count(k), F.sum(size.cast("long")), F.percentile_approx(k, [i / GUIDES for i in range(GUIDES + 1)], 4 * GUIDES)).first()
    rows, keyed, held, guides = stats[0], stats[1], stats[2] or 0, sorted(set(stats[3] or [])) or [0.0]
    if not rows:
        return add(docs).withColumn("next", F.struct(*carry))
    parts = max(1, -(-rows // (GUIDES * BUCKET_ROWS)))
    edges = F.array(*[F.lit(g) for g in guides])
    span = let(F.size(F.filter(edges, lambda g: g <= k)), lambda i: i * parts + F.when(
        (i > 0) & (i < len(guides)),
        F.least(F.lit(parts - 1), F.floor((k - F.get(edges, i - 1)) / F.greatest(F.get(edges, i) - F.get(edges, i - 1), F.lit(1e-300)) * parts)),
    ).otherwise(F.lit(0)))
    nulls = max(1, -(-(rows - keyed) // BUCKET_ROWS))
    place = F.floor((F.col(ties).cast("double") / F.lit(2.0**64) + F.lit(0.5)) * nulls)
    bucket = F.when(k.isNull(), F.least(place, F.lit(nulls - 1)) - nulls).otherwise(span).cast("long")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // TASK_BYTES))
    in_order = Window.partitionBy("_bucket").orderBy(key, ties)
    dealt = add(docs).withColumn("_bucket", bucket).repartition(tasks, "_bucket")
    seen = dealt.withColumn("_next", F.lead(F.struct(*carry)).over(in_order))
    bare = docs.withColumn("_bucket", bucket)
    heads = add(bare.withColumn("_brank", F.row_number().over(in_order)).where("_brank = 1")).select(F.col("_bucket").alias("_bhead"), F.struct(*carry).alias("_bfirst"))
    after = _after(bare.select("_bucket").distinct(), "_bucket").select(F.col("_bucket").alias("_bof"), F.col("then").alias("_bthen"))
    nexts = heads.join(after, F.col("_bhead") == F.col("_bthen")).select("_bof", "_bfirst")
    return seen.join(nexts, F.col("_bucket") == F.col("_bof")).withColumn("next", F.coalesce("_next", "_bfirst")).drop("_bucket", "_next", "_bof", "_bfirst")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = with_next(docs.withColumn("h", F.xxhash64("text")), "doc_id", "h", ["text", "signature"], fingerprints)
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2)
    edited = F.concat(F.substr("text", F.lit(1), (n - half).cast("int")), F.substr("next.text", F.lit(1), half.cast("int")))
    out = placed.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "signature", F.col("next.signature").alias("after"))
    out = out.withColumn("changed", signature(F.col("edited")))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("changed")).alias("near_edited"),
        likeness(F.col("signature"), F.col("after")).alias("near_next"),
    )
