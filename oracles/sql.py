"""Oracle statements for DuckDB, written step by step in the order of the loads.

Each step is a named query; `compose` puts the steps a statement needs, directly or
not, in front of it as CTEs.
"""

from __future__ import annotations

import re

from oracles.fixture import FIXTURE

B1 = "TIMESTAMP '2002-01-01 00:00:00'"
B2 = "TIMESTAMP '2002-02-01 00:00:00'"
LOW = "TIMESTAMP '1900-01-01 00:00:00'"
HIGH = "TIMESTAMP '2199-01-01 00:00:00'"
MONTHS = ("['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь','Ноябрь','Декабрь']")
DAYS = "['Понедельник','Вторник','Среда','Четверг','Пятница','Суббота','Воскресенье']"
MONTHS_EN = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"

STEPS: dict[str, str] = dict(FIXTURE)


def compose(statement: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\b[a-z]\w*\b", text)) & STEPS.keys() - needed:
            needed.add(name)
            visit(STEPS[name])

    visit(statement)
    ctes = [f"{n} AS ({STEPS[n]})" for n in STEPS if n in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + statement


def hashed(*columns: str) -> str:
    parts = ", ".join(f"TRIM(COALESCE(CAST({c} AS VARCHAR), ''))" for c in columns)
    return f"UPPER(MD5(UPPER(CONCAT_WS(';', {parts}))))"


def day_key(expr: str) -> str:
    return f"CAST(STRFTIME({expr}, '%Y%m%d') AS INTEGER)"


def drawn(row: str, purpose: str) -> str:
    """A number in [0, 1) that seed 7, row and purpose decide."""
    return f"(CAST('0x' || MD5('7/{purpose}/' || {row})[1:8] AS BIGINT) / 4294967296.0)"


def full_calendar(days: str) -> str:
    """25 columns over a query with one DATE column d."""
    return f"""
SELECT {day_key('d')} AS date_pk, d AS date_actual, {DAYS}[ISODOW(d)] AS day_name,
  CAST(ISODOW(d) AS INTEGER) AS day_of_week, CAST(DAY(d) AS INTEGER) AS day_of_month,
  CAST(DATE_DIFF('day', DATE_TRUNC('quarter', d), d) + 1 AS INTEGER) AS day_of_quarter,
  CAST(DAYOFYEAR(d) AS INTEGER) AS day_of_year, CAST(CEIL(DAY(d) / 7.0) AS INTEGER) AS week_of_month,
  CAST(WEEK(d) AS INTEGER) AS week_of_year, CAST(MONTH(d) AS INTEGER) AS month_actual, {MONTHS}[MONTH(d)] AS month_name,
  {MONTHS_EN}[MONTH(d)] AS month_name_abbreviated, CAST(QUARTER(d) AS INTEGER) AS quarter_actual,
  CAST(YEAR(d) AS INTEGER) AS year_actual,
  CAST(d + CAST(1 - ISODOW(d) AS INTEGER) AS DATE) AS first_day_of_week,
  CAST(d + CAST(7 - ISODOW(d) AS INTEGER) AS DATE) AS last_day_of_week,
  CAST(DATE_TRUNC('month', d) AS DATE) AS first_day_of_month,
  CAST(DATE_TRUNC('month', d) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_month,
  CAST(DATE_TRUNC('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(DATE_TRUNC('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
  MAKE_DATE(YEAR(d), 1, 1) AS first_day_of_year, MAKE_DATE(YEAR(d), 12, 31) AS last_day_of_year,
  STRFTIME(d, '%m%Y') AS mmyyyy, STRFTIME(d, '%m%d%Y') AS mmddyyyy, ISODOW(d) IN (6, 7) AS weekend_indr
FROM ({days})"""


STEPS["data_days"] = ("SELECT CAST(g AS DATE) AS d FROM (SELECT UNNEST(GENERATE_SERIES(lo, hi, INTERVAL 1 DAY)) AS g FROM "
                      "(SELECT DATE_TRUNC('day', MIN(o_orderdate)) AS lo, (SELECT DATE_TRUNC('day', MAX(l_shipdate)) "
                      "FROM lineitem) AS hi FROM orders))")
STEPS["cal"] = (f"SELECT {day_key('d')} AS date_pk, d AS date_actual, CAST(DAY(d) AS INTEGER) AS day_of_month, "
                f"{MONTHS}[MONTH(d)] AS month_name, CAST(YEAR(d) AS INTEGER) AS year_actual FROM data_days")

# ---------------------------------------------------------------- star

for entity in ("inventory", "staff", "rental"):
    STEPS[f"stg_{entity}2"] = f"SELECT * FROM {entity}2 WHERE last_update >= {B1} OR deleted >= {B1}"
_PAID = ("SELECT p.payment_id, p.customer_id, p.staff_id, p.rental_id, r.inventory_id, p.amount, p.payment_date, "
         "p.last_update, p.deleted FROM payment{b} p JOIN rental{b} r ON r.rental_id = p.rental_id")
STEPS["stg_payment1"] = _PAID.format(b=1)
STEPS["stg_payment2"] = (_PAID.format(b=2) + f" WHERE p.deleted >= {B1} OR p.last_update >= {B1} OR r.last_update >= {B1}")
STEPS["paid2"] = _PAID.format(b=2)

_DISC = "i.inventory_id, i.film_id, f.title, f.rental_duration, f.rental_rate, f.length, f.rating"
STEPS["di_pre"] = (f"SELECT {_DISC}, {LOW} AS effective_date_from, {HIGH} AS effective_date_to, TRUE AS is_active "
                   "FROM inventory1 i JOIN film1 f ON f.film_id = i.film_id")
_PERSON = "s.staff_id, s.first_name, s.last_name, a.address, a.district, c.city AS city_name"
_PLACES = ("JOIN store{b} st ON st.store_id = s.store_id JOIN address{b} a ON a.address_id = st.address_id "
           "JOIN city{b} c ON c.city_id = a.city_id")
STEPS["ds_pre"] = (f"SELECT {_PERSON}, {LOW} AS effective_date_from, {HIGH} AS effective_date_to, TRUE AS is_active "
                   f"FROM staff1 s {_PLACES.format(b=1)}")


def _close(table: str, key: str, changes: str, at: str, where: str) -> str:
    """Live rows of `table` with a row in `changes` end at its `at`."""
    hit = f"(x.{key} IS NOT NULL AND t.is_active)"
    return (f"SELECT t.* REPLACE (CASE WHEN {hit} THEN x.{at} ELSE t.effective_date_to END AS effective_date_to, "
            f"CASE WHEN {hit} THEN FALSE ELSE t.is_active END AS is_active) FROM {table} t "
            f"LEFT JOIN (SELECT * FROM {changes} WHERE {where}) x ON x.{key} = t.{key}")


def _scd(prefix: str, staged: str, key: str, alias: str, selected: str, lookups: str) -> None:
    STEPS[f"{prefix}_1"] = _close(f"{prefix}_pre", key, staged, "deleted", "deleted IS NOT NULL")
    STEPS[f"{prefix}_new"] = f"SELECT n.* FROM {staged} n WHERE NOT EXISTS (SELECT 1 FROM {prefix}_1 d WHERE d.{key} = n.{key})"
    STEPS[f"{prefix}_2"] = (
        f"SELECT * FROM {prefix}_1 UNION ALL SELECT {selected}, {LOW}, COALESCE({alias}.deleted, {HIGH}), "
        f"{alias}.deleted IS NULL FROM {prefix}_new {alias} {lookups}")
    later = f"deleted IS NULL AND {key} NOT IN (SELECT {key} FROM {prefix}_new)"
    STEPS[f"{prefix}_3"] = _close(f"{prefix}_2", key, staged, "last_update", later)
    STEPS[f"{prefix}_4"] = (
        f"SELECT * FROM {prefix}_3 UNION ALL SELECT {selected}, {alias}.last_update, {HIGH}, TRUE "
        f"FROM (SELECT * FROM {staged} WHERE {later}) {alias} {lookups}")


_scd("di", "stg_inventory2", "inventory_id", "i", _DISC, "JOIN film2 f ON f.film_id = i.film_id")
_scd("ds", "stg_staff2", "staff_id", "s", _PERSON, _PLACES.format(b=2))
STEPS["changed_film"] = f"SELECT * FROM film2 WHERE last_update >= {B1}"


def _split(table: str) -> str:
    inside = (f"FROM {table} t JOIN changed_film f ON f.film_id = t.film_id AND f.last_update > t.effective_date_from "
              "AND f.last_update < t.effective_date_to")
    return (f"SELECT t.* REPLACE (COALESCE(f.last_update, t.effective_date_to) AS effective_date_to, "
            "CASE WHEN f.film_id IS NULL THEN t.is_active ELSE FALSE END AS is_active) "
            + inside.replace(" JOIN ", " LEFT JOIN ") +
            " UNION ALL SELECT t.inventory_id, t.film_id, f.title, f.rental_duration, f.rental_rate, f.length, f.rating, "
            f"f.last_update, t.effective_date_to, t.is_active {inside}")


STEPS["di_post"] = _split("di_4")
STEPS["ds_post"] = "SELECT * FROM ds_4"


def _fks(alias: str, version: str) -> str:
    return (f"JOIN di_{version} di ON di.inventory_id = {alias}.inventory_id AND {alias}.last_update "
            f"BETWEEN di.effective_date_from AND di.effective_date_to JOIN ds_{version} ds ON ds.staff_id = {alias}.staff_id "
            f"AND {alias}.last_update BETWEEN ds.effective_date_from AND ds.effective_date_to")


_FK_COLUMNS = ("di.inventory_id, di.effective_date_from AS inventory_from, ds.staff_id, "
               "ds.effective_date_from AS staff_from")
_FIRST = "{low} AS effective_date_from, COALESCE({a}.deleted, {high}) AS effective_date_to, {a}.deleted IS NULL AS is_active"


def _first(a: str) -> str:
    return _FIRST.format(low=LOW, high=HIGH, a=a)


# fact_payment, step by step
_PAY = "p.payment_id, p.rental_id, p.amount, dd.date_pk AS payment_date_fk, " + _FK_COLUMNS
_PAY_DAY = "JOIN cal dd ON dd.date_actual = CAST(p.payment_date AS DATE)"
STEPS["fp_pre"] = f"SELECT {_PAY}, {_first('p')} FROM stg_payment1 p {_fks('p', 'pre')} {_PAY_DAY}"
STEPS["fp_1"] = _close("fp_pre", "payment_id", "stg_payment2", "deleted", "deleted IS NOT NULL")
STEPS["fp_new"] = ("SELECT p.* FROM stg_payment2 p LEFT JOIN (SELECT DISTINCT payment_id FROM fp_1) k "
                   "ON k.payment_id = p.payment_id WHERE k.payment_id IS NULL")
STEPS["fp_2"] = f"SELECT * FROM fp_1 UNION ALL SELECT {_PAY}, {_first('p')} FROM fp_new p {_fks('p', 'post')} {_PAY_DAY}"
STEPS["fp_same"] = ("SELECT DISTINCT p.payment_id FROM stg_payment2 p JOIN fp_2 fp ON fp.payment_id = p.payment_id "
                    "AND p.last_update BETWEEN fp.effective_date_from AND fp.effective_date_to JOIN cal dd "
                    "ON dd.date_pk = fp.payment_date_fk WHERE p.amount = fp.amount "
                    "AND CAST(p.payment_date AS DATE) = dd.date_actual AND p.rental_id = fp.rental_id")
STEPS["fp_pick"] = (f"SELECT * FROM (SELECT p.payment_id, p.last_update, {_FK_COLUMNS}, ROW_NUMBER() OVER (PARTITION BY "
                    "p.payment_id ORDER BY di.effective_date_from DESC, ds.effective_date_from DESC) AS rn "
                    f"FROM stg_payment2 p JOIN fp_same s ON s.payment_id = p.payment_id {_fks('p', 'post')}) WHERE rn = 1")
STEPS["fp_3"] = ("SELECT fp.* REPLACE (COALESCE(k.inventory_id, fp.inventory_id) AS inventory_id, "
                 "COALESCE(k.inventory_from, fp.inventory_from) AS inventory_from, COALESCE(k.staff_id, fp.staff_id) AS "
                 "staff_id, COALESCE(k.staff_from, fp.staff_from) AS staff_from) FROM fp_2 fp LEFT JOIN fp_pick k "
                 "ON k.payment_id = fp.payment_id AND k.last_update BETWEEN fp.effective_date_from AND fp.effective_date_to")
STEPS["fp_hist"] = ("SELECT p.* FROM stg_payment2 p WHERE p.deleted IS NULL AND p.payment_id NOT IN (SELECT payment_id FROM "
                    "fp_same) AND p.payment_id NOT IN (SELECT payment_id FROM fp_new)")
STEPS["fp_4"] = _close("fp_3", "payment_id", "fp_hist", "last_update", "TRUE")
STEPS["fp_post"] = (f"SELECT * FROM fp_4 UNION ALL SELECT {_PAY}, p.last_update, {HIGH}, TRUE FROM fp_hist p "
                    f"{_fks('p', 'post')} {_PAY_DAY}")

# fact_rental, step by step
_RENT = "r.rental_id, d1.date_pk AS rental_date_fk, d2.date_pk AS return_date_fk, " + _FK_COLUMNS
_RENT_DAYS = ("JOIN cal d1 ON d1.date_actual = CAST(r.rental_date AS DATE) "
              "LEFT JOIN cal d2 ON d2.date_actual = CAST(r.return_date AS DATE)")
STEPS["fr_pre"] = f"SELECT {_RENT}, {_first('r')} FROM rental1 r {_fks('r', 'pre')} {_RENT_DAYS}"
STEPS["fr_1"] = _close("fr_pre", "rental_id", "stg_rental2", "deleted", "deleted IS NOT NULL")
STEPS["fr_new"] = ("SELECT r.* FROM stg_rental2 r LEFT JOIN (SELECT DISTINCT rental_id FROM fr_1) k "
                   "ON k.rental_id = r.rental_id WHERE k.rental_id IS NULL")
STEPS["fr_2"] = f"SELECT * FROM fr_1 UNION ALL SELECT {_RENT}, {_first('r')} FROM fr_new r {_fks('r', 'post')} {_RENT_DAYS}"
STEPS["fr_back"] = ("SELECT DISTINCT r.rental_id, r.return_date FROM stg_rental2 r JOIN fr_2 fr ON fr.rental_id = r.rental_id "
                    "JOIN cal dd ON dd.date_pk = fr.rental_date_fk WHERE r.return_date IS NOT NULL AND "
                    "fr.return_date_fk IS NULL AND fr.is_active AND fr.inventory_id = r.inventory_id AND "
                    "fr.staff_id = r.staff_id AND dd.date_actual = CAST(r.rental_date AS DATE) AND r.deleted IS NULL "
                    "AND r.rental_id NOT IN (SELECT rental_id FROM fr_new)")
STEPS["fr_3"] = ("SELECT fr.* REPLACE (CASE WHEN fr.is_active AND k.date_pk IS NOT NULL THEN k.date_pk ELSE fr.return_date_fk "
                 "END AS return_date_fk) FROM fr_2 fr LEFT JOIN (SELECT b.rental_id, dd.date_pk FROM fr_back b JOIN cal dd "
                 "ON dd.date_actual = CAST(b.return_date AS DATE)) k ON k.rental_id = fr.rental_id")
STEPS["fr_hist"] = ("SELECT r.* FROM stg_rental2 r WHERE r.deleted IS NULL AND r.rental_id NOT IN (SELECT rental_id FROM "
                    "fr_back) AND r.rental_id NOT IN (SELECT rental_id FROM fr_new)")
STEPS["fr_4"] = _close("fr_3", "rental_id", "fr_hist", "last_update", "TRUE")
STEPS["fr_post"] = (f"SELECT * FROM fr_4 UNION ALL SELECT {_RENT}, r.last_update, {HIGH}, TRUE FROM fr_hist r "
                    f"{_fks('r', 'post')} {_RENT_DAYS}")

# ---------------------------------------------------------------- corporate

COLUMNS = {
    "film": ["film_id", "title", "description", "release_year", "rental_duration", "rental_rate", "length",
             "replacement_cost", "rating", "last_update"],
    "inventory": ["inventory_id", "film_id", "store_id", "last_update", "deleted"],
    "address": ["address_id", "address", "district", "city_id", "last_update"],
    "city": ["city_id", "city", "last_update"],
    "staff": ["staff_id", "first_name", "last_name", "address_id", "store_id", "last_update", "deleted"],
    "store": ["store_id", "manager_staff_id", "address_id", "last_update"],
    "payment": ["payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date", "deleted", "last_update"],
    "rental": ["rental_id", "rental_date", "inventory_id", "customer_id", "return_date", "staff_id", "last_update", "deleted"],
}
LOOKUPS = {
    "film": {"film_id": "film"},
    "inventory": {"inventory_id": "inventory", "film_id": "film", "store_id": "store"},
    "address": {"address_id": "address", "city_id": "city"},
    "city": {"city_id": "city"},
    "staff": {"staff_id": "staff", "address_id": "address", "store_id": "store"},
    "store": {"store_id": "store", "manager_staff_id": "staff", "address_id": "address"},
    "payment": {"payment_id": "payment", "staff_id": "staff", "rental_id": "rental"},
    "rental": {"rental_id": "rental", "inventory_id": "inventory", "staff_id": "staff"},
}


def upserted(target: str, delta: str, key: str, columns: list[str]) -> str:
    names = ", ".join(columns)
    return (f"SELECT {names} FROM {target} WHERE {key} NOT IN (SELECT {key} FROM {delta}) UNION ALL "
            f"SELECT {names} FROM {delta}")


def with_surrogates(rows: str, entity: str, version: str) -> str:
    joins, names = [], []
    for c in COLUMNS[entity]:
        if c in LOOKUPS[entity]:
            ref = LOOKUPS[entity][c]
            joins.append(f"JOIN ref_{ref}_{version} k_{c} ON k_{c}.{ref}_nk = n.{c}")
            names.append(f"k_{c}.{ref}_sk AS {c}")
        else:
            names.append(f"n.{c}")
    return f"SELECT {', '.join(names)} FROM ({rows}) n {' '.join(joins)}"


for entity in COLUMNS:
    names = ", ".join(COLUMNS[entity])
    STEPS[f"ods_{entity}_pre"] = f"SELECT {names} FROM {entity}1"
    STEPS[f"ods_{entity}_post"] = (
        f"SELECT {names} FROM {entity}2" if entity not in ("payment", "rental")
        else upserted(f"ods_{entity}_pre", "payment2" if entity == "payment" else "stg_rental2", f"{entity}_id", COLUMNS[entity]))
for entity in COLUMNS:
    key = f"{entity}_id"
    STEPS[f"ref_{entity}_pre"] = (f"SELECT ROW_NUMBER() OVER (ORDER BY {key}) AS {entity}_sk, {key} AS {entity}_nk "
                                  f"FROM ods_{entity}_pre")
    STEPS[f"ref_{entity}_post"] = (
        f"SELECT {entity}_sk, {entity}_nk FROM ref_{entity}_pre UNION ALL SELECT (SELECT COALESCE(MAX({entity}_sk), 0) FROM "
        f"ref_{entity}_pre) + ROW_NUMBER() OVER (ORDER BY {key}), {key} FROM ods_{entity}_post WHERE {key} NOT IN "
        f"(SELECT {entity}_nk FROM ref_{entity}_pre)")
for entity in COLUMNS:
    key = f"{entity}_id"
    STEPS[f"integ_{entity}_pre"] = with_surrogates(f"SELECT * FROM ods_{entity}_pre", entity, "pre")
    if entity in ("payment", "rental"):
        STEPS[f"delta_{entity}"] = (f"SELECT * FROM ods_{entity}_post WHERE last_update > (SELECT COALESCE(MAX(last_update), "
                                    f"{LOW}) FROM integ_{entity}_pre)")
        STEPS[f"delta_{entity}_sk"] = with_surrogates(f"SELECT * FROM delta_{entity}", entity, "post")
        gone = (f"SELECT k.{entity}_sk FROM delta_{entity} d JOIN ref_{entity}_post k ON k.{entity}_nk = d.{key}")
        columns = ", ".join(COLUMNS[entity])
        STEPS[f"integ_{entity}_post"] = (f"SELECT {columns} FROM integ_{entity}_pre WHERE {key} NOT IN ({gone}) UNION ALL "
                                         f"SELECT {columns} FROM delta_{entity}_sk")
        STEPS[f"fact_{entity}_pre"] = f"SELECT * FROM integ_{entity}_pre WHERE last_update > {LOW}"
        STEPS[f"newer_{entity}"] = (f"SELECT * FROM integ_{entity}_post WHERE last_update > (SELECT COALESCE(MAX(last_update), "
                                    f"{LOW}) FROM fact_{entity}_pre)")
        STEPS[f"fact_{entity}_post"] = upserted(f"fact_{entity}_pre", f"newer_{entity}", key, COLUMNS[entity])
    else:
        STEPS[f"integ_{entity}_post"] = with_surrogates(f"SELECT * FROM ods_{entity}_post", entity, "post")
        row = "MD5(CONCAT_WS('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in COLUMNS[entity]) + ")) AS h"
        kept = ", ".join(c for c in COLUMNS[entity] if c not in ("last_update", "deleted"))
        STEPS[f"snap_{entity}_pre"] = f"SELECT *, {row} FROM integ_{entity}_pre"
        STEPS[f"snap_{entity}_post"] = f"SELECT *, {row} FROM integ_{entity}_post"
        open_span = f"{LOW} AS date_effective_from, {HIGH} AS date_effective_to, TRUE AS is_active, h"
        STEPS[f"dim_{entity}_pre"] = f"SELECT {kept}, {open_span} FROM snap_{entity}_pre"
        # new keys, then missing keys, then changed keys
        STEPS[f"dim_{entity}_a"] = (f"SELECT * FROM dim_{entity}_pre UNION ALL SELECT {kept}, {open_span} FROM "
                                    f"snap_{entity}_post WHERE {key} NOT IN (SELECT {key} FROM dim_{entity}_pre)")
        missing = f"(t.is_active AND t.{key} NOT IN (SELECT {key} FROM snap_{entity}_post))"
        STEPS[f"dim_{entity}_b"] = (
            f"SELECT t.* REPLACE (CASE WHEN {missing} THEN {B2} ELSE t.date_effective_to END AS date_effective_to, "
            f"CASE WHEN {missing} THEN FALSE ELSE t.is_active END AS is_active) FROM dim_{entity}_a t")
        STEPS[f"chg_{entity}"] = (f"SELECT s.* FROM snap_{entity}_post s JOIN dim_{entity}_b t ON t.{key} = s.{key} "
                                  "WHERE t.is_active AND t.h <> s.h")
        STEPS[f"dim_{entity}_post"] = (
            f"SELECT t.* REPLACE (CASE WHEN c.{key} IS NOT NULL AND t.is_active THEN c.last_update ELSE t.date_effective_to END "
            f"AS date_effective_to, CASE WHEN c.{key} IS NOT NULL AND t.is_active THEN FALSE ELSE t.is_active END AS is_active) "
            f"FROM dim_{entity}_b t LEFT JOIN chg_{entity} c ON c.{key} = t.{key} UNION ALL "
            f"SELECT {kept}, last_update, {HIGH}, TRUE, h FROM chg_{entity}")

STEPS["corp_by_date"] = (
    "SELECT c.date_pk AS sales_date_id, CONCAT(c.day_of_month, ' ', c.month_name, ' ', c.year_actual) AS sales_date_title, "
    "CAST(SUM(p.amount) AS DOUBLE) AS amount FROM fact_payment_post p JOIN cal c ON c.date_actual = CAST(p.payment_date AS DATE) "
    "WHERE p.deleted IS NULL GROUP BY c.date_pk, c.day_of_month, c.month_name, c.year_actual")
STEPS["corp_by_film"] = (
    "SELECT f.title AS film_title, CAST(SUM(p.amount) AS DECIMAL(18,2)) AS amount FROM fact_payment_post p "
    "JOIN fact_rental_post r ON r.rental_id = p.rental_id JOIN dim_inventory_post i ON i.inventory_id = r.inventory_id "
    "JOIN dim_film_post f ON f.film_id = i.film_id GROUP BY 1")

# ---------------------------------------------------------------- vault

STATIC = ["title", "description", "release_year", "length", "rating"]
DYNAMIC = ["rental_duration", "rental_rate", "replacement_cost"]
HASHES = {
    "film": {"hub_film_hash_key": ["film_id"], "film_static_hash_diff": STATIC, "film_dynamic_hash_diff": DYNAMIC},
    "inventory": {"hub_inventory_hash_key": ["inventory_id"], "hub_film_hash_key": ["film_id"],
                  "link_film_inventory_hash_key": ["film_id", "inventory_id"]},
    "rental": {"hub_rental_hash_key": ["rental_id"], "hub_inventory_hash_key": ["inventory_id"],
               "link_rental_inventory_hash_key": ["rental_id", "inventory_id"]},
}
for entity, exprs in HASHES.items():
    extra = ", ".join(f"{hashed(*c)} AS {n}" for n, c in exprs.items())
    for batch, (load, name) in enumerate([(B1, f"{entity}1"), (B2, "stg_rental2" if entity == "rental" else f"{entity}2")], 1):
        STEPS[f"v_{entity}{batch}"] = f"SELECT *, {extra}, {load} AS load_date, 'film_rental_db' AS record_source FROM {name}"

for entity, feeds in {"film": ["film", "inventory"], "inventory": ["inventory", "rental"], "rental": ["rental"]}.items():
    wanted = f"hub_{entity}_hash_key, load_date, record_source, {entity}_id"
    for batch, version in ((1, "pre"), (2, "post")):
        unseen = "" if batch == 1 else f" WHERE {entity}_id NOT IN (SELECT {entity}_id FROM hub_{entity}_pre)"
        rows = " UNION ".join(f"SELECT {wanted} FROM v_{f}{batch}{unseen}" for f in feeds)
        rows = f"SELECT DISTINCT {wanted} FROM ({rows})"
        STEPS[f"hub_{entity}_{version}"] = rows if batch == 1 else f"SELECT * FROM hub_{entity}_pre UNION ALL {rows}"

for name, (staged, parent) in {"film_inventory": ("inventory", "film"), "rental_inventory": ("rental", "rental")}.items():
    wanted = f"link_{name}_hash_key, load_date, record_source, hub_{parent}_hash_key, hub_inventory_hash_key"
    STEPS[f"link_{name}_pre"] = f"SELECT {wanted} FROM v_{staged}1"
    STEPS[f"link_{name}_post"] = (
        f"SELECT * FROM link_{name}_pre UNION ALL SELECT {wanted} FROM v_{staged}2 s WHERE NOT EXISTS (SELECT 1 FROM "
        f"link_{name}_pre l WHERE l.link_{name}_hash_key = s.link_{name}_hash_key)")

SATELLITES = {
    "film_static": ("film", "hub_film_hash_key", "film_static_hash_diff", STATIC, True),
    "film_dynamic": ("film", "hub_film_hash_key", "film_dynamic_hash_diff", DYNAMIC, True),
    "film_inventory": ("inventory", "link_film_inventory_hash_key", "''", [], True),
    "inventory": ("inventory", "hub_inventory_hash_key", "''", [], True),
    "rental_inventory": ("rental", "link_rental_inventory_hash_key", "''", [], False),
    "rental_static": ("rental", "hub_rental_hash_key", hashed("rental_date"), ["rental_date"], False),
    "rental_dynamic": ("rental", "hub_rental_hash_key", hashed("return_date"), ["return_date"], False),
}
for name, (staged, key, diff, payload, full) in SATELLITES.items():
    pay = "".join(f", {p}" for p in payload)
    for batch in (1, 2):
        STEPS[f"sat_{name}_in{batch}"] = (f"SELECT {key}, load_date, CAST(NULL AS TIMESTAMP) AS load_end_date, record_source, "
                                          f"{diff} AS hash_diff{pay} FROM v_{staged}{batch}")
    STEPS[f"sat_{name}_a"] = (f"SELECT * FROM sat_{name}_in1 UNION ALL SELECT n.* FROM sat_{name}_in2 n LEFT JOIN sat_{name}_in1 o "
                              f"ON o.{key} = n.{key} AND o.load_end_date IS NULL WHERE o.{key} IS NULL OR o.hash_diff <> n.hash_diff")
    STEPS[f"sat_{name}_b"] = (f"SELECT * REPLACE (COALESCE(load_end_date, LEAD(load_date) OVER (PARTITION BY {key} ORDER BY "
                              f"load_date)) AS load_end_date) FROM sat_{name}_a")
    STEPS[f"sat_{name}_post"] = (
        f"SELECT * FROM sat_{name}_b" if not full else
        f"SELECT t.* REPLACE (CASE WHEN t.load_end_date IS NULL AND t.{key} NOT IN (SELECT {key} FROM sat_{name}_in2) "
        f"THEN {B2} ELSE t.load_end_date END AS load_end_date) FROM sat_{name}_b t")


# ---------------------------------------------------------------- statements

def _statements() -> dict[str, str]:
    s: dict[str, str] = {}
    cols = {e: ", ".join(c) for e, c in COLUMNS.items()}

    s["extract_full_film"] = f"SELECT {cols['film']} FROM film2"
    s["high_water_mark"] = (
        "SELECT w.table_name, COALESCE(MAX(e.ts), " + LOW + ") AS update_dt FROM (VALUES ('view'), ('click'), ('error'), "
        "('purchase'), ('signup'), ('never_loaded')) w(table_name) LEFT JOIN events e ON e.event_type = w.table_name GROUP BY 1")
    s["record_load"] = ("SELECT event_type AS table_name, ts AS update_dt FROM events UNION ALL "
                        f"SELECT 'staging.film', {B2}")
    s["previous_load_time"] = (
        "SELECT table_name, MAX(before) AS update_dt FROM (SELECT event_type AS table_name, LAG(ts) OVER (PARTITION BY "
        "event_type ORDER BY ts) AS before FROM events) GROUP BY 1")
    s["extract_incremental_inventory"] = f"SELECT {cols['inventory']} FROM stg_inventory2"
    s["extract_incremental_staff"] = "SELECT staff_id, first_name, last_name, store_id, last_update, deleted FROM stg_staff2"
    s["extract_incremental_rental"] = f"SELECT {cols['rental']} FROM stg_rental2"
    s["extract_incremental_payment"] = "SELECT * FROM stg_payment2"
    s["schema_evolution_align"] = (
        "SELECT payment_id, customer_id, staff_id, rental_id, amount, payment_date, CAST(NULL AS TIMESTAMP) AS deleted, "
        "CAST(NULL AS TIMESTAMP) AS last_update FROM payment0")
    for e in ("payment", "rental"):
        s[f"upsert_{e}"] = upserted(f"{e}1", f"{e}2", f"{e}_id", COLUMNS[e])
        mark = f"(SELECT MAX(last_update) FROM {e}1)"
        s[f"upsert_since_{e}"] = upserted(f"{e}1", f"(SELECT * FROM {e}2 WHERE last_update > {mark})", f"{e}_id", COLUMNS[e])
    for e in COLUMNS:
        s[f"sync_keys_{e}"] = f"SELECT {e}_sk, {e}_nk FROM ref_{e}_post"
        s[f"replace_keys_{e}"] = with_surrogates(f"SELECT * FROM ods_{e}_post", e, "post")
    s["hash_key_film"] = f"SELECT film_id, {hashed('film_id')} AS hub_film_hash_key FROM film2"
    s["hash_diff_film_static"] = f"SELECT film_id, {hashed(*STATIC)} AS film_static_hash_diff FROM film2"
    s["hash_diff_film_dynamic"] = f"SELECT film_id, {hashed(*DYNAMIC)} AS film_dynamic_hash_diff FROM film2"
    s["link_key_inventory"] = (f"SELECT inventory_id, film_id, {hashed('film_id', 'inventory_id')} AS "
                               "link_film_inventory_hash_key FROM inventory2")
    s["link_key_rental"] = (f"SELECT rental_id, inventory_id, {hashed('rental_id', 'inventory_id')} AS "
                            "link_rental_inventory_hash_key FROM rental2")
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in COLUMNS["film"])
    s["row_hash_changed_film"] = f"SELECT a.film_id FROM film1 a JOIN film2 b ON a.film_id = b.film_id WHERE {differs}"

    s["scd2_soft_delete_inventory"] = "SELECT * FROM di_1"
    s["scd2_new_inventory"] = "SELECT * FROM di_2"
    s["scd2_version_inventory"] = s["scd2_merge_inventory"] = "SELECT * FROM di_4"
    s["scd2_dim_staff"] = "SELECT * FROM ds_post"
    s["scd2_dim_inventory"] = "SELECT * FROM di_post"
    s["scd2_split_film_change"] = _split("di_pre")
    for e in ("film", "inventory", "address", "city", "staff", "store"):
        s[f"scd2_hash_dim_{e}"] = f"SELECT * EXCLUDE (h) FROM dim_{e}_post"

    within = "p.last_update >= di.effective_date_from AND p.last_update {op} di.effective_date_to"
    join = "FROM paid2 p JOIN di_post di ON di.inventory_id = p.inventory_id AND " + within
    s["as_of_join_payment_inventory"] = (
        "SELECT p.payment_id, p.inventory_id, p.last_update, di.title, di.rental_rate, di.effective_date_from AS "
        "inventory_from " + join.format(op="<="))
    s["as_of_join_boundary"] = (
        f"SELECT payment_id, CAST(SUM(b) AS BIGINT) AS matches_both, CAST(SUM(l) AS BIGINT) AS matches_left FROM (SELECT p.payment_id, 1 AS b, 0 AS l "
        f"{join.format(op='<=')} UNION ALL SELECT p.payment_id, 0, 1 {join.format(op='<')}) GROUP BY payment_id "
        "HAVING SUM(b) <> SUM(l)")
    s["fact_payment_star"] = "SELECT * FROM fp_post"
    s["fact_rental_star"] = "SELECT * FROM fr_post"

    s["calendar_full"] = full_calendar("SELECT d FROM data_days")
    s["calendar_short"] = (f"SELECT {day_key('d')} AS date_id, d AS date_actual, CAST(DAY(d) AS INTEGER) AS day_of_month, "
                           f"{MONTHS}[MONTH(d)] AS month_name, CAST(YEAR(d) AS INTEGER) AS year FROM data_days")

    for suffix, where in (("", ""), ("_current", " WHERE p.is_active")):
        s[f"sales_by_date_star{suffix}"] = (
            "SELECT d.day_of_month || ' ' || d.month_name || ' ' || d.year_actual AS date_title, d.date_pk AS date_sort, "
            "CAST(SUM(p.amount) AS DECIMAL(18,2)) AS amount FROM fp_post p JOIN cal d ON d.date_pk = p.payment_date_fk"
            f"{where} GROUP BY 1, 2")
        s[f"sales_by_film_star{suffix}"] = (
            "SELECT di.title AS film_title, CAST(SUM(p.amount) AS DECIMAL(18,2)) AS amount FROM fp_post p JOIN di_post di "
            f"ON di.inventory_id = p.inventory_id AND di.effective_date_from = p.inventory_from{where} GROUP BY 1")
    s["sales_by_date_corp"] = "SELECT * FROM corp_by_date"
    s["sales_by_film_corp"] = "SELECT * FROM corp_by_film"
    s["integrated_payment"] = f"SELECT {cols['payment']} FROM integ_payment_post"
    s["integrated_rental"] = f"SELECT {cols['rental']} FROM integ_rental_post"
    s["fact_payment_corp"] = f"SELECT {cols['payment']} FROM fact_payment_post"
    s["fact_rental_corp"] = f"SELECT {cols['rental']} FROM fact_rental_post"
    s["mart_reader_by_date"] = "SELECT sales_date_id, sales_date_title, amount FROM corp_by_date"
    s["mart_reader_by_film"] = "SELECT film_title, CAST(amount AS DOUBLE) AS amount FROM corp_by_film"

    for e in ("film", "inventory", "rental"):
        s[f"hub_{e}"] = f"SELECT * FROM hub_{e}_post"
    for e in ("film_inventory", "rental_inventory"):
        s[f"link_{e}"] = f"SELECT * FROM link_{e}_post"
    for e in SATELLITES:
        s[f"sat_{e}"] = (f"SELECT * FROM sat_{e}_post" if e.startswith("film_") and e != "film_inventory"
                         else f"SELECT * EXCLUDE (hash_diff) FROM sat_{e}_post")
    s["rented_film_vault"] = (
        "SELECT sfs.title AS film_title, COUNT(hr.rental_id) AS quantity FROM hub_film_post hf JOIN sat_film_static_post sfs "
        "ON sfs.hub_film_hash_key = hf.hub_film_hash_key JOIN link_film_inventory_post lfi ON lfi.hub_film_hash_key = "
        "hf.hub_film_hash_key JOIN hub_inventory_post hi ON hi.hub_inventory_hash_key = lfi.hub_inventory_hash_key "
        "JOIN link_rental_inventory_post lri ON lri.hub_inventory_hash_key = hi.hub_inventory_hash_key JOIN hub_rental_post hr "
        "ON hr.hub_rental_hash_key = lri.hub_rental_hash_key GROUP BY 1")

    s["synthetic_rentals"] = (
        "SELECT g.id, g.rental_date, g.inventory_id, g.customer_id, g.rental_date + TO_DAYS(CAST(f.rental_duration AS INTEGER)) "
        "AS return_date, g.staff_id FROM (SELECT n.id, CAST(m.day AS TIMESTAMP) AS rental_date, CAST(FLOOR(n.r * m.discs) AS BIGINT) "
        "AS inventory_id, CAST(FLOOR(n.r * m.customers) AS BIGINT) AS customer_id, CAST(FLOOR(n.r * m.people) AS BIGINT) AS "
        f"staff_id FROM (SELECT id, {drawn('id', 'rental')} AS r FROM (SELECT UNNEST(RANGE(c)) AS id FROM "
        "(SELECT COUNT(*) AS c FROM rental0))) n, (SELECT (SELECT CAST(MAX(rental_date) AS DATE) + 1 FROM rental0) AS day, "
        "(SELECT COUNT(*) FROM inventory0) AS discs, (SELECT COUNT(*) FROM customer) AS customers, (SELECT COUNT(*) FROM "
        "staff0) AS people) m) g LEFT JOIN (SELECT i.inventory_id, f.rental_duration FROM inventory0 i JOIN film0 f ON "
        "f.film_id = i.film_id) f ON f.inventory_id = g.inventory_id")

    kinds, upto = [], 0.0
    for kind, share in (("update", 0.05), ("delete", 0.02), ("insert", 0.03), ("late", 0.02), ("repeat", 0.01)):
        upto += share
        kinds.append(f"WHEN u < CAST({upto!r} AS DOUBLE) THEN '{kind}'")
    draw = lambda purpose: drawn("rental_id", purpose)
    some = lambda purpose, table: f"CAST(FLOOR({draw(purpose)} * (SELECT COUNT(*) FROM {table})) AS BIGINT)"
    s["synthetic_changes"] = (
        "SELECT CASE WHEN n THEN rental_id + 1 + (SELECT MAX(rental_id) FROM rental0) ELSE rental_id END AS rental_id, "
        "CASE WHEN n THEN TIMESTAMP '2002-01-31 00:00:00' ELSE rental_date END AS rental_date, "
        f"CASE WHEN x OR n THEN {some('inventory', 'inventory0')} ELSE inventory_id END AS inventory_id, "
        f"CASE WHEN n THEN {some('customer', 'customer')} ELSE customer_id END AS customer_id, "
        f"CASE WHEN x THEN rental_date + TO_DAYS(CAST(FLOOR({draw('return')} * 10) AS INTEGER) + 1) WHEN NOT n THEN return_date END AS return_date, "
        f"CASE WHEN n THEN {some('staff', 'staff0')} ELSE staff_id END AS staff_id, "
        f"moment - TO_DAYS(CASE WHEN change = 'late' THEN CAST(FLOOR({draw('late')} * 3) AS INTEGER) + 1 ELSE 0 END) AS last_update, "
        "CASE WHEN change = 'delete' THEN moment END AS deleted, change FROM (SELECT *, change IN ('update', 'late', 'repeat') AS x, "
        f"change = 'insert' AS n, TIMESTAMP '2002-01-31 00:00:00' + TO_SECONDS(FLOOR({draw('second')} * 86400)) AS moment FROM "
        f"(SELECT *, CASE {' '.join(kinds)} END AS change FROM (SELECT *, {draw('kind')} AS u FROM rental0))), "
        "(SELECT UNNEST([1, 2]) AS nth) WHERE change IS NOT NULL AND (nth = 1 OR change = 'repeat')")

    # The steps give rows without generated keys, so that what holds for these by construction stands as 0.
    declared = []

    def keyed(table: str, columns: str, rows: str | None) -> None:
        found = f"(SELECT COUNT(*) FROM (SELECT 1 FROM {rows} GROUP BY {columns} HAVING COUNT(*) > 1))" if rows else "0"
        declared.append(f"('{table}', 'unique', '{columns}', {found})")

    def refers(table: str, fk: str, rows: str | None, parent: str = "", pk: str = "") -> None:
        found = f"(SELECT COUNT(*) FROM {rows} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent}))" if rows else "0"
        declared.append(f"('{table}', 'reference', '{fk}', {found})")

    for table, pk in (("dim_inventory", "inventory_pk"), ("dim_staff", "staff_pk"), ("fact_payment", "payment_pk"), ("fact_rental", "rental_pk")):
        keyed(f"core.{table}", pk, None)
    keyed("core.dim_date", "date_pk", "cal")
    refers("core.fact_payment", "payment_date_fk", "fp_post", "cal", "date_pk")
    refers("core.fact_rental", "rental_date_fk", "fr_post", "cal", "date_pk")
    refers("core.fact_rental", "return_date_fk", "fr_post", "cal", "date_pk")
    for fact in ("payment", "rental"):
        refers(f"core.fact_{fact}", "inventory_fk", None)
        refers(f"core.fact_{fact}", "staff_fk", None)
    for e in ("film", "inventory", "rental"):
        keyed(f"edw.hub_{e}", f"hub_{e}_hash_key", f"hub_{e}_post")
    for e, parent in (("film_inventory", "film"), ("rental_inventory", "rental")):
        keyed(f"edw.link_{e}", f"link_{e}_hash_key", f"link_{e}_post")
        for hub_ in (parent, "inventory"):
            refers(f"edw.link_{e}", f"hub_{hub_}_hash_key", f"link_{e}_post", f"hub_{hub_}_post", f"hub_{hub_}_hash_key")
    for e, (_, key, *_) in SATELLITES.items():
        keyed(f"edw.sat_{e}", f"{key},load_date", f"sat_{e}_post")
        parent = (f"link_{e}" if key.startswith("link") else key.removesuffix("_hash_key")) + "_post"
        refers(f"edw.sat_{e}", key, f"sat_{e}_post", parent, key)
    s["dq_declared"] = f"SELECT * FROM (VALUES {', '.join(declared)}) t(\"table\", \"check\", subject, violations)"

    s["dq_not_null"] = " UNION ALL ".join(
        f"SELECT 'not_null' AS \"check\", '{c}' AS subject, COUNT(*) AS violations FROM (SELECT *, NULL AS deleted FROM rental0) WHERE {c} IS NULL"
        for c in ("rental_id", "rental_date", "return_date", "deleted"))
    s["dq_domain"] = (
        "SELECT 'domain' AS \"check\", 'rating' AS subject, COUNT(*) AS violations FROM film2 WHERE rating NOT IN "
        "('G', 'PG', 'PG-13', 'R', 'NC-17') UNION ALL SELECT 'domain', 'release_year', COUNT(*) FROM film2 WHERE release_year < "
        "1901 OR release_year > 2155 UNION ALL SELECT 'domain', 'rental_duration', COUNT(*) FROM film2 WHERE "
        "rental_duration > 40")
    s["dq_length"] = " UNION ALL ".join(
        f"SELECT 'length' AS \"check\", '{c}' AS subject, COUNT(*) AS violations FROM film2 WHERE LENGTH({c}) > {n}"
        for c, n in (("title", 12), ("description", 15), ("rating", 10)))
    s["dq_unique"] = " UNION ALL ".join(
        f"SELECT 'unique' AS \"check\", '{k}' AS subject, COUNT(*) AS violations FROM (SELECT 1 FROM {t} GROUP BY {k} "
        "HAVING COUNT(*) > 1)" for t, k in (("lineitem", "l_orderkey,l_linenumber"), ("payment2", "payment_id")))
    s["dq_reference"] = " UNION ALL ".join(
        f"SELECT 'reference' AS \"check\", '{k}' AS subject, COUNT(*) AS violations FROM {c} x WHERE x.{k} IS NOT NULL AND "
        f"NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{k})"
        for c, k, p in (("inventory1", "film_id", "film1"), ("payment2", "rental_id", "rental2"),
                        ("payment2", "staff_id", "staff2")))
    s["dq_asof_misses"] = (
        "SELECT p.payment_id, p.inventory_id, p.last_update, CASE WHEN p.inventory_id IS NULL THEN 'no key' WHEN p.last_update IS NULL "
        "THEN 'no time' WHEN k.lo IS NULL THEN 'unknown key' WHEN p.last_update < k.lo THEN 'before the first version' "
        "WHEN p.last_update < k.hi THEN 'between two versions' ELSE 'after the last version' END AS reason FROM paid2 p LEFT JOIN "
        "(SELECT inventory_id, MIN(effective_date_from) AS lo, MAX(effective_date_from) AS hi FROM di_post GROUP BY 1) k "
        "ON k.inventory_id = p.inventory_id WHERE NOT EXISTS (SELECT 1 FROM di_post d WHERE d.inventory_id = p.inventory_id AND "
        "p.last_update BETWEEN d.effective_date_from AND d.effective_date_to)")
    s["dq_missing_parents"] = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", c.{t}_id AS row_key, '{fk}' AS fk, c.{fk} AS parent_key FROM {rows} c "
        f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{fk} = c.{fk})"
        for t, rows, fk, parent in (("inventory", "stg_inventory2", "film_id", "film2"), ("staff", "stg_staff2", "store_id", "store2"),
                                    ("payment", "payment2", "rental_id", "rental2"), ("rental", "stg_rental2", "inventory_id", "di_4"),
                                    ("rental", "stg_rental2", "staff_id", "ds_post")))
    # the whole pipelines give what the steps give
    for name, same in (("star_fact_payment", "fact_payment_star"), ("star_dim_inventory", "scd2_dim_inventory"),
                       ("star_sales_by_film", "sales_by_film_star"), ("corporate_fact_payment", "fact_payment_corp"),
                       ("corporate_dim_film", "scd2_hash_dim_film"), ("corporate_sales_by_film", "sales_by_film_corp"),
                       ("vault_hub_film", "hub_film"), ("vault_sat_rental_dynamic", "sat_rental_dynamic"),
                       ("vault_rented_film", "rented_film_vault")):
        s[f"pipeline_{name}"] = s[same]
    return s


def statements() -> dict[str, str]:
    return {name: compose(sql) for name, sql in _statements().items()}
