from siltstone.functions.dates import (CHANGE_FLOOR, OPEN_END, OPEN_START, date_key, day_name, month_name,
                                       timestamp)
from siltstone.functions.hashing import hash_diff, hash_key, link_key, row_hash

__all__ = ["CHANGE_FLOOR", "OPEN_END", "OPEN_START", "date_key", "day_name", "hash_diff", "hash_key", "link_key",
           "month_name", "row_hash", "timestamp"]
