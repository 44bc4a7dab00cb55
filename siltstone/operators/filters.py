"""Runtime filters: what one side of a join holds, told to the scan of the other before anything of it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20  # 128 KB, whatever the number of keys
MOST_BITS = 1 << 26  # 8 MB
_WORD = 64


def bits_for(keys: int) -> int:
    """Bits for that many keys: at least eight for each, as far as `MOST_BITS` goes."""
    return min(MOST_BITS, max(BITS, 1 << (8 * keys).bit_length()))


def known_filter(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """A condition on the column `key` of another table that every key of `keys` meets, and few others.

    Others pass by the chance of a bit that is set, more of them the more keys there are: an exact join
    has to follow. The bounds reach the scan; the bits are ORed word by word on the way to it. NULL keys never pass.
    """
    def bit(c: Column | str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits).cast("bigint"))

    mask = F.expr(f"shiftleft(1L, CAST(_bit % {_WORD} AS INT))")
    words = keys.filter(F.col(key).isNotNull()).select(bit(key).alias("_bit")).select(F.floor(F.col("_bit") / _WORD).cast("int").alias("_word"), mask.alias("_mask"))
    every = keys.sparkSession.range(bits // _WORD).select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("bigint").alias("_mask"))
    ordered = words.unionByName(every).groupBy("_word").agg(F.bit_or("_mask").alias("_mask")).agg(
        F.sort_array(F.collect_list(F.struct("_word", "_mask"))).alias("_words"))
    table = ordered.select(F.transform("_words", lambda w: w["_mask"]).alias("_words")).scalar()
    place = bit(F.col(key))
    is_set = F.get(table, F.floor(place / _WORD).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % _WORD).cast("int"))) != 0
    return F.col(key).between(keys.agg(F.min(key)).scalar(), keys.agg(F.max(key)).scalar()) & is_set
