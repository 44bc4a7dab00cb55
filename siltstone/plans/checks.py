"""The declared constraints of the warehouses, checked on a loaded state."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.hashing import packed
from siltstone.plans.common import State
from siltstone.schemas import LENGTHS, columns, not_null

# Primary keys.
PRIMARY_KEYS = {
    "core.dim_inventory": ["inventory_pk"], "core.dim_staff": ["staff_pk"], "core.dim_date": ["date_pk"],
    "core.fact_payment": ["payment_pk"], "core.fact_rental": ["rental_pk"],
    "edw.hub_film": ["hub_film_hash_key"], "edw.hub_inventory": ["hub_inventory_hash_key"],
    "edw.hub_rental": ["hub_rental_hash_key"], "edw.link_film_inventory": ["link_film_inventory_hash_key"],
    "edw.link_rental_inventory": ["link_rental_inventory_hash_key"],
    "edw.sat_film_static": ["hub_film_hash_key", "load_date"], "edw.sat_film_dynamic": ["hub_film_hash_key", "load_date"],
    "edw.sat_film_inventory": ["link_film_inventory_hash_key", "load_date"],
    "edw.sat_inventory": ["hub_inventory_hash_key", "load_date"],
    "edw.sat_rental_inventory": ["link_rental_inventory_hash_key", "load_date"],
    "edw.sat_rental_static": ["hub_rental_hash_key", "load_date"], "edw.sat_rental_dynamic": ["hub_rental_hash_key", "load_date"],
}

# Foreign keys, as column → (table, column).
FOREIGN_KEYS = {
    "core.fact_payment": {"payment_date_fk": ("core.dim_date", "date_pk"),
                          "inventory_fk": ("core.dim_inventory", "inventory_pk"), "staff_fk": ("core.dim_staff", "staff_pk")},
    "core.fact_rental": {"rental_date_fk": ("core.dim_date", "date_pk"), "return_date_fk": ("core.dim_date", "date_pk"),
                         "inventory_fk": ("core.dim_inventory", "inventory_pk"), "staff_fk": ("core.dim_staff", "staff_pk")},
    "edw.link_film_inventory": {"hub_film_hash_key": ("edw.hub_film", "hub_film_hash_key"),
                                "hub_inventory_hash_key": ("edw.hub_inventory", "hub_inventory_hash_key")},
    "edw.link_rental_inventory": {"hub_rental_hash_key": ("edw.hub_rental", "hub_rental_hash_key"),
                                  "hub_inventory_hash_key": ("edw.hub_inventory", "hub_inventory_hash_key")},
    "edw.sat_film_static": {"hub_film_hash_key": ("edw.hub_film", "hub_film_hash_key")},
    "edw.sat_film_dynamic": {"hub_film_hash_key": ("edw.hub_film", "hub_film_hash_key")},
    "edw.sat_film_inventory": {"link_film_inventory_hash_key": ("edw.link_film_inventory", "link_film_inventory_hash_key")},
    "edw.sat_inventory": {"hub_inventory_hash_key": ("edw.hub_inventory", "hub_inventory_hash_key")},
    "edw.sat_rental_inventory": {"link_rental_inventory_hash_key": ("edw.link_rental_inventory",
                                                                    "link_rental_inventory_hash_key")},
    "edw.sat_rental_static": {"hub_rental_hash_key": ("edw.hub_rental", "hub_rental_hash_key")},
    "edw.sat_rental_dynamic": {"hub_rental_hash_key": ("edw.hub_rental", "hub_rental_hash_key")},
}


@dataclass(frozen=True)
class Constraint:
    """One declared constraint, by its place in the report."""

    table: str
    check: str
    subject: str


def _subject(key: list[str]) -> str:
    return ",".join(key)


def declared_constraints(tables: dict[str, str], names: list[str]) -> dict[Constraint, tuple[str, Column | None, tuple[str, str]]]:
    """Constraint → (table it is on, condition of a bad row or None, (table, column) whose keys it is about)."""
    none, out = F.lit(False), {}
    for name in names:
        types = columns(tables, name)
        for c in not_null(tables, name):
            out[Constraint(name, "not_null", c)] = (name, F.col(c).isNull(), (name, c))
        for c, n in LENGTHS.items():
            if types.get(c) == "string":
                out[Constraint(name, "length", c)] = (name, F.coalesce(F.length(c) > n, none), (name, c))
        if name in PRIMARY_KEYS:
            subject = _subject(PRIMARY_KEYS[name])
            out[Constraint(name, "unique", subject)] = (name, None, (name, subject))
        for fk, parent in FOREIGN_KEYS.get(name, {}).items():
            out[Constraint(name, "reference", fk)] = (name, None, parent)
    return out


OWN = 0  # the slot of a row that has the key as its own; the references to the key have 1, 2, …


def check_state(state: State, tables: dict[str, str], layers: list[str] | None = None) -> DataFrame:
    """Every declared constraint of the given layers: (table, check, subject, violations), one row each.

    Each table is read once. Its keys are expanded, one that others refer to once for all of them, each with the number of what it is about and its
    slot there, and packed; rows that break a column's declaration come without a key. One shuffle then counts them per key and slot, after each
    task has: a key that most rows share is one row per task. A NULL key of a reference passes.
    """
    names = [n for n in tables if n in state and (layers is None or n.split(".")[0] in layers)]
    found = declared_constraints(tables, names)
    subjects: dict[tuple, int] = {}
    entries: dict[str, dict[tuple[int, int], Column]] = {}
    places: list[tuple[Constraint, int, int]] = []
    slots: dict[int, int] = {}

    def entry(table: str, subject: int, slot: int, key: list[str], counts: Column) -> None:
        given = F.array(*[packed(F.col(c).cast("string")) for c in key]) if key else F.lit(None).cast("array<binary>")
        entries.setdefault(table, {})[subject, slot] = F.when(counts, F.struct(
            F.lit(subject).alias("subject"), F.lit(slot).alias("slot"), given.alias("key")))

    for constraint, (name, bad, about) in found.items():
        known = ("key", *about) if bad is None else (constraint.check, *about)
        subject = subjects.setdefault(known, len(subjects))
        slot = OWN
        if constraint.check != "unique":
            slot = slots[subject] = slots.get(subject, OWN) + 1
        places.append((constraint, subject, slot))
        if bad is not None:
            entry(name, subject, slot, [], bad)
        elif constraint.check == "unique":
            entry(name, subject, OWN, PRIMARY_KEYS[name], F.lit(True))
        else:
            fk, (parent, pk) = constraint.subject, about
            entry(name, subject, slot, [fk], F.col(fk).isNotNull())
            if (subject, OWN) not in entries.get(parent, {}):
                entry(parent, subject, OWN, [pk], F.col(pk).isNotNull())
    expanded = reduce(DataFrame.unionByName, [state[n].select(F.inline(F.array_compact(F.array(*e.values())))) for n, e in entries.items()])
    every = range(1 + max(slots.values(), default=OWN))
    by_key = expanded.groupBy("subject", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in every])
    own, none = F.col("n0"), F.lit(0).cast("bigint")
    wrong = [F.when(own > 1, F.lit(1).cast("bigint")).otherwise(none), *[F.when(own > 0, none).otherwise(F.col(f"n{i}")) for i in every if i != OWN]]
    counts = by_key.groupBy("subject").agg(*[F.sum(w).alias(f"n{i}") for i, w in zip(every, wrong, strict=True)])
    counts = counts.select("subject", F.posexplode(F.array(*[f"n{i}" for i in every])).alias("slot", "n"))
    listed = F.array(*[F.struct(F.lit(subject).alias("subject"), F.lit(slot).alias("slot"), F.lit(c.table).alias("table"), F.lit(c.check).alias("check"), F.lit(c.subject).alias("column"))
                       for c, subject, slot in places])
    return expanded.sparkSession.range(1).select(F.inline(listed)).join(counts, ["subject", "slot"], "left").select(
        "table", "check", F.col("column").alias("subject"), F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))
