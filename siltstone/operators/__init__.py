from siltstone.operators.asof import as_of_join, as_of_misses
from siltstone.operators.calendar import calendar, calendar_short, days_between, describe_days, describe_days_short
from siltstone.operators.extract import extract_full, extract_incremental, extract_incremental_enriched
from siltstone.operators.facts import load_fact_payment, load_fact_rental
from siltstone.operators.journal import (high_water_mark, high_water_marks, previous_load_time, previous_load_times,
                                         record_load)
from siltstone.operators.keys import Registry, fill_keys, number_rows, replace_keys, sync_keys
from siltstone.operators.quality import (check_domain, check_length, check_not_null, check_reference, check_schema,
                                         check_unique, missing_parents)
from siltstone.operators.scd import (CORP_SPAN, STAR_SPAN, Span, scd2_hash, scd2_insert_new, scd2_merge,
                                     scd2_soft_delete, scd2_split, scd2_version)
from siltstone.operators.synthetic import synthetic_changes, synthetic_rentals
from siltstone.operators.upsert import changes_since_target, stored_with_mark, upsert, upsert_since
from siltstone.operators.vault import load_hub, load_link, load_plain_satellite, load_satellite

__all__ = [
    "CORP_SPAN", "Registry", "STAR_SPAN", "Span", "as_of_join", "as_of_misses", "calendar", "calendar_short", "changes_since_target",
    "check_domain", "check_length", "check_not_null", "check_reference", "check_schema", "check_unique", "days_between",
    "describe_days", "describe_days_short", "extract_full", "extract_incremental", "extract_incremental_enriched",
    "fill_keys", "high_water_mark", "high_water_marks", "load_fact_payment", "load_fact_rental", "load_hub", "load_link",
    "load_plain_satellite", "load_satellite", "missing_parents", "number_rows", "previous_load_time", "previous_load_times", "record_load",
    "replace_keys", "scd2_hash", "scd2_insert_new", "scd2_merge", "scd2_soft_delete", "scd2_split", "scd2_version",
    "stored_with_mark", "sync_keys", "synthetic_changes", "synthetic_rentals", "upsert", "upsert_since",
]
