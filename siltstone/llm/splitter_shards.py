"""Shards of near equal bytes by sampled splitters (operator 3), in DataFrame operations only.

Records are ordered by (hash of the text, doc_id, a number given once), so that equal texts stand together.
A sample, in which a record's chance grows with its size, gives the quantiles of the bytes over that
order; they part it into many more ranges than shards. Ranges that turn out overfull are parted again by a
sample of their own. Exact sums by range then say where each record lies in the whole, and the shards are cut
there: no record is compared with more than the logarithm of the splitters, and no task sees more than a range.

A group of equal texts lighter than a range stays in one shard; a heavier one is parted, as the law of
near equal sizes asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import materialize, prepared

#: Ranges for each shard at least; rows for each range; ranges at most. The splitters are broadcast: 65,536 rows of 24 bytes.
RANGES_PER_SHARD, ROWS_PER_RANGE, MOST_RANGES = 64, 100_000, 65_536
#: Sampled records for each splitter, and how many times the mean a range may hold before it is parted again.
DRAWS, OVERFULL = 16, 2


def _splitters(keys: DataFrame, within: list[str], pieces: Column, weight: Column) -> DataFrame:
    """(within, splits): for each part of `keys` the quantiles of the bytes that cut it in `pieces`.

    weight: the mean number of draws of a record. Below 1 it is its chance to be drawn, once.
    """
    chance = F.pmod(F.xxhash64("n", "h", F.lit(len(within))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = keys.withColumn("_w", weight).where(F.col("_w") > chance).select(
        *within, F.struct("h", "id", "n").alias("k"), F.greatest("_w", F.lit(1.0)).alias("w"), pieces.alias("p"))
    by = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    upto = F.sum("w").over(by.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w") / 2
    cut = drawn.withColumn("q", F.floor(upto * F.col("p") / F.sum("w").over(by)))
    first = cut.where("q > 0").groupBy(*within, "q").agg(F.min("k").alias("k"))
    # The first splitter inside a group of equal texts moves to its start: a light group isn't cut.
    head = F.row_number().over(by.partitionBy(*within, F.col("k.h")).orderBy("k") if within else Window.partitionBy("k.h").orderBy("k")) == 1
    moved = F.when(head, F.struct(F.col("k.h").alias("h"), F.lit(None).cast("long").alias("id"), F.lit(-1).cast("long").alias("n"))).otherwise(F.col("k"))
    return first.withColumn("k", moved)


def _place(splits: Column, key: Column) -> Column:
    """How many of the sorted `splits` are at or before `key`, by halving."""
    low, high = F.lit(0), F.size(splits)
    start = F.struct(low.alias("lo"), high.alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        after = F.get(splits, mid) <= key
        return F.when(s["lo"] >= s["hi"], s).when(after, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
            F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(splits) + F.lit(1.0))).cast("int") + 1)
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row of `docs`.

    size: UTF-8 bytes of the text and 1; a null text is empty. Shards differ by about a range, 1/64 of their bytes, or
    by a record where one is larger. slot counts from 0 in each shard, without gaps, in the order above; null ids
    come first among equal texts. Repeated rows get slots of their own. An empty table gives no rows. `docs` needs doc_id (a whole
    number) and text.
    """
    spark = prepared(docs.sparkSession)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = docs.select("doc_id", F.col("doc_id").cast("long").alias("id"), (F.octet_length(data) + F.lit(1)).cast("long").alias("size"), F.crc32(data).alias("crc"),
                       F.xxhash64(data).alias("h"), F.monotonically_increasing_id().alias("n"))
    keys = materialize(keys, "op3-keys")  # the numbers are final from here on
    rows, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(max(RANGES_PER_SHARD * shards, -(-rows // ROWS_PER_RANGE)), MOST_RANGES)
    mean = max(total / ranges, 1e-9)
    weight = F.col("size") * F.lit(DRAWS / mean)

    # DRAWS * ranges records at most are sorted in one task; it doesn't grow beyond MOST_RANGES.
    splits = _splitters(keys, [], F.lit(ranges), weight).select(F.shiftright("k.h", 56).cast("int").alias("cell"), "k")
    splits = splits.groupBy("cell").agg(F.sort_array(F.collect_list("k")).alias("splits"))
    # For each value of the hash's first byte its own splitters, and how many come before them.
    cells = spark.range(-128, 128).select(F.col("id").cast("int").alias("cell")).join(splits, "cell", "left")
    before = Window.partitionBy(F.lit(0)).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(cells.select("cell", "splits", F.coalesce(F.sum(F.greatest(F.size("splits"), F.lit(0))).over(before), F.lit(0)).alias("base")), "op3-splitters")
    inside = F.when(F.col("splits").isNull(), 0).otherwise(_place(F.col("splits"), F.struct("h", "id", "n")))
    placed = keys.withColumn("cell", F.shiftright("h", 56).cast("int")).join(F.broadcast(cells), "cell").withColumn("r", F.col("base") + inside).drop("splits", "base", "cell")
    placed = materialize(placed, "op3-placed")
    full = placed.groupBy("r").agg(F.sum("size").alias("b")).where(F.col("b") > OVERFULL * mean).select("r", F.ceil(F.col("b") / mean).alias("pieces"))
    full = materialize(full, "op3-overfull")  # ranges / OVERFULL rows at most
    again = placed.join(F.broadcast(full), "r")
    inner = materialize(_splitters(again, ["r"], F.col("pieces"), weight * 4).groupBy("r").agg(F.sort_array(F.collect_list("k")).alias("splits")), "op3-inner")
    parted = placed.join(F.broadcast(inner), "r", "left").withColumn(
        "s", F.when(F.col("splits").isNull(), 0).otherwise(_place(F.col("splits"), F.struct("h", "id", "n")))).drop("splits")

    part = Window.partitionBy("r", "s")
    order = part.orderBy("h", "id", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = parted.withColumn("after", F.sum("size").over(order)).withColumn("at", F.count("*").over(order))
    group = Window.partitionBy("r", "s", "h")
    lines = lines.withColumn("mid", (F.min(F.col("after") - F.col("size")).over(group) + F.max("after").over(group)) / 2)
    lines = materialize(lines, "op3-lines")
    sums = lines.groupBy("r", "s").agg(F.max("after").alias("b"), F.max("at").alias("c"))
    before = Window.orderBy("r", "s").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select("r", "s", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))
    whole = lines.join(F.broadcast(starts), ["r", "s"]).withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor((F.col("b0") + F.col("mid")) * shards / F.lit(max(total, 1)))).cast("int"))
    whole = whole.withColumn("at", F.col("c0") + F.col("at") - 1)
    heads = dict(whole.groupBy("shard").agg(F.min("at")).collect())  # a row for each shard
    head = F.get(F.array(*[F.lit(heads.get(i, 0)).cast("long") for i in range(shards)]), F.col("shard"))
    return whole.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("at") - head).alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
