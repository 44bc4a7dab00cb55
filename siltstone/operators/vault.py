"""Hubs, links and satellites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.dates import timestamp
from siltstone.functions.hashing import hash_diff, packed, unpacked


def hub_additions(hub: DataFrame, sources: Sequence[DataFrame], hash_key: str, business_key: str) -> DataFrame:
    """Rows for the business keys that the hub does not know yet.

    Each source is reduced to its distinct keys before anything is shuffled by key, so a
    key that most rows carry costs no more than any other.
    """
    columns = [packed(F.col(hash_key)).alias(hash_key), "load_date", "record_source", business_key]
    keys = None
    for source in sources:
        part = source.select(*columns).filter(F.col(business_key).isNotNull())
        keys = part if keys is None else keys.unionByName(part)
    unseen = keys.distinct().join(hub.select(business_key), business_key, "left_anti")
    return unseen.withColumn(hash_key, unpacked(F.col(hash_key))).select(*hub.columns)


def load_hub(hub: DataFrame, sources: Sequence[DataFrame], hash_key: str, business_key: str) -> DataFrame:
    """DV-1: the hub with the unseen business keys of one or more sources. A key may
    arrive with a child before its own row does."""
    return hub.unionByName(hub_additions(hub, sources, hash_key, business_key))


def link_additions(link: DataFrame, staged: DataFrame, hash_key: str, hub_keys: Sequence[str]) -> DataFrame:
    """Rows for the relationships that the link does not know yet."""
    keys = [hash_key, *hub_keys]
    unseen = staged.select("load_date", "record_source", *[packed(F.col(k)).alias(k) for k in keys]).join(
        link.select(packed(F.col(hash_key)).alias(hash_key)), hash_key, "left_anti")
    return unseen.withColumns({k: unpacked(F.col(k)) for k in keys}).select(*link.columns)


def load_link(link: DataFrame, staged: DataFrame, hash_key: str, hub_keys: Sequence[str]) -> DataFrame:
    """DV-2: the link with unseen relationships; they are never ended."""
    return link.unionByName(link_additions(link, staged, hash_key, hub_keys))


def _meet(satellite: DataFrame, staged: DataFrame, key: str, how: str) -> DataFrame:
    """The open rows (`_was`) and the staged rows (`_now`) by key."""
    opened = satellite.filter(F.col("load_end_date").isNull()).select(key, F.struct("*").alias("_was"))
    return opened.join(staged.select(key, F.struct("*").alias("_now")), key, how)


def _end(diff: str, load_ts: str, full: bool) -> Column:
    """When a load ends the open row of a pair (NULL: it stays open)."""
    was, now = F.col("_was"), F.col("_now")
    end = F.when((was["hash_diff"] != now[diff]) & (now["load_date"] > was["load_date"]), now["load_date"])
    return end.when(now.isNull(), timestamp(load_ts)) if full else end


def ending_rows(satellite: DataFrame, staged: DataFrame, key: str, diff: str, load_ts: str, full: bool = True) -> DataFrame:
    """The open rows that a load will end."""
    pairs = _meet(satellite, staged, key, "left").withColumn("_end", _end(diff, load_ts, full)).filter(F.col("_end").isNotNull())
    return pairs.select(*[(F.col("_end") if c == "load_end_date" else F.col("_was")[c]).alias(c) for c in satellite.columns])


def load_satellite(satellite: DataFrame, staged: DataFrame, key: str, diff: str, payload: Sequence[str], load_ts: str,
                   full: bool = True, known: DataFrame | None = None, computed: bool = False) -> DataFrame:
    """DV-3: a row per change of the payload.

    Appends where the key has no open row or another hash diff; ends the older open row
    where the newer one starts; with `full` (the staged rows are a whole snapshot) ends
    open rows whose key is gone at the load time. The open row of a key meets at most one staged row, so one full outer
    join gives the ended, the kept and the added rows together; ended rows pass by.
    `known` is the whole satellite where the first argument is only the part with rows
    to end; open rows outside that part are then left out, since nothing happens to them.
    Keys are packed for the join, and with `computed` the diffs of both sides are taken from the payload after it.
    """
    was, now, value = F.col("_was"), F.col("_now"), unpacked(F.col("_key"))

    def row(values: Mapping[str, Column]) -> Column:
        return F.struct(*[values[c].cast(t).alias(c) for c, t in satellite.dtypes])

    is_open = F.col("load_end_date").isNull()

    def open_rows(rows: DataFrame) -> DataFrame:
        others = [c for c in satellite.columns if c != key]
        return rows.filter(is_open).select(packed(F.col(key).cast("string")).alias("_key"), F.struct(*others).alias("_was"))

    given = ["load_date", "record_source", *payload, *([] if computed else [diff])]
    staged = staged.select(packed(F.col(key).cast("string")).alias("_key"), F.struct(*given).alias("_now"))
    changed = F.col("_was_diff") != F.col("_now_diff")
    end = F.when(changed & (now["load_date"] > was["load_date"]), now["load_date"])
    end = end.when(now.isNull(), timestamp(load_ts)) if full else end
    kept = row({c: was[c] for c in satellite.columns if c != key} | {key: value, "load_end_date": end})
    added = row({c: now[c] for c in ("load_date", "record_source", *payload)} | {
        key: value, "load_end_date": F.lit(None), "hash_diff": F.col("_now_diff")})
    differs = was.isNull() | changed
    if known is not None:  # a part that is written anew has all its own rows, and of the others only what is added
        # Own rows are counted before the outer join, dealt as it deals them; its key is of neither side, so a join after it would deal all pairs anew.
        opened = open_rows(known)
        if known is satellite:
            opened = opened.withColumn("_own", F.when(F.col("_key").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy("_key"))))
        else:
            opened = opened.join(open_rows(satellite).groupBy("_key").agg(F.count(F.lit(1)).alias("_own")), "_key", "left")
        pairs = opened.join(staged, "_key", "full_outer")
        rows = F.filter(F.array(F.when(F.col("_own").isNotNull(), kept), F.when(now.isNotNull() & differs, added)), lambda r: r.isNotNull())
        rows = F.when(F.col("_own") > 1, F.flatten(F.array_repeat(rows, F.col("_own").cast("int")))).otherwise(rows)
    else:
        pairs = open_rows(satellite).join(staged, "_key", "full_outer")
        rows = F.when(was.isNull(), F.array(added)).when(now.isNotNull() & differs, F.array(kept, added)).otherwise(F.array(kept))
    if computed:
        diffs = {side: F.when(F.col(side).isNotNull(), payload_diff([f"{side}.{c}" for c in payload])) for side in ("_was", "_now")}
    else:
        diffs = {"_was": was["hash_diff"], "_now": now[diff]}
    pairs = pairs.withColumns({f"{side}_diff": d for side, d in diffs.items()})
    return satellite.filter(~is_open).unionByName(pairs.select(F.inline(rows)))


def payload_diff(payload: Sequence[str]) -> Column:
    return hash_diff(*payload) if payload else F.lit("")


def with_computed_diff(satellite: DataFrame, staged: DataFrame, payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a satellite without a stored diff, with a diff over the payload. With
    an empty payload only the presence of the key counts."""
    diff = payload_diff(payload)
    return satellite.withColumn("hash_diff", diff), staged.withColumn("_staged_diff", diff)


def load_plain_satellite(satellite: DataFrame, staged: DataFrame, key: str, payload: Sequence[str], load_ts: str,
                         full: bool = True, known: DataFrame | None = None) -> DataFrame:
    """DV-4: the same for a satellite that stores no hash diff."""
    return load_satellite(satellite, staged, key, "", payload, load_ts, full, known, computed=True)
