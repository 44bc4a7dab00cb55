"""Hash keys and hash diffs, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def hash_key(*names: str) -> Column:
    """Upper-case MD5 of the trimmed, upper-cased columns joined by `;` (NULL counts as empty).

    Cast doubles to decimals before hashing: engines print doubles differently.
    """
    return F.upper(F.md5(F.upper(F.concat_ws(";", *[_part(n) for n in names]))))


def link_key(*names: str) -> Column:
    """Hash key over the ordered business keys of a relationship."""
    return hash_key(*names)


def hash_diff(*names: str) -> Column:
    """Hash of a payload: ignores case, outer blanks and the difference of NULL and empty."""
    return hash_key(*names)


_PAD = 17  # bytes behind a key that is no MD5


def packed(key: Column) -> Column:
    """A text key in fewer bytes, for shuffles: 16 for an upper-case MD5. Keys are equal where these are, whatever they hold."""
    digest = F.unhex(key)
    other = F.concat(key.cast("binary"), F.lit(bytearray(_PAD)))  # longer than a digest
    return F.when((F.octet_length(key) == 32) & (F.hex(digest) == key), digest).otherwise(other)


def unpacked(key: Column) -> Column:
    """What `packed` was given."""
    size = F.octet_length(key)
    return F.when(size == 16, F.hex(key)).otherwise(F.substring(key, F.lit(1), size - _PAD).cast("string"))


def row_hash(names: list[str]) -> Column:
    """MD5 of the whole row. Sees every difference, also case, blanks and NULL."""
    return F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
