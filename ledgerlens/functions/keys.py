"""KEY-1: deterministic hashed surrogate keys.

A key is the first 24 hex characters of SHA-256 over the business-key parts.
Each part is cast to text, trimmed and upper-cased; a null part becomes the
marker ``^^`` so that (null, 'x') and ('x', null) hash differently; parts are
joined with ``||``. A rebuild therefore produces the same keys, and two
systems that share a business key meet on the same surrogate.

A key is never null, and says so to Spark (which takes any sha2 for nullable): else a
join on keys pushes a test of each key below the aggregates it comes from, where it
differs by system and keeps two loads of one extract from sharing its shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's key convention.
KEY_NULL_MARKER = "^^"
KEY_SEPARATOR = "||"
KEY_HEX_CHARS = 24


def _part(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(F.trim(col.cast("string"))), F.lit(KEY_NULL_MARKER))


def surrogate_key(*parts: Column | str) -> Column:
    """Column expression: hashed key over ``parts`` (column names or Columns)."""
    joined = F.concat_ws(KEY_SEPARATOR, *[_part(p) for p in parts])
    return F.coalesce(F.substring(F.sha2(joined, 256), 1, KEY_HEX_CHARS), F.lit(""))


def surrogate_key_sql(*parts: str) -> str:
    """The same key as a Spark SQL expression string over SQL expressions."""
    inner = ", ".join(
        f"coalesce(upper(trim(cast({p} as string))), '{KEY_NULL_MARKER}')" for p in parts)
    return f"coalesce(substring(sha2(concat_ws('{KEY_SEPARATOR}', {inner}), 256), 1, {KEY_HEX_CHARS}), '')"


def packed_key(key: Column | str) -> Column:
    """A key as bytes, for an exchange: the 12 bytes of a surrogate key. Other text keeps its
    own behind a mark, with which it never has 12; :func:`unpacked_key` gives either back."""
    text = F.col(key) if isinstance(key, str) else key
    size, own = F.octet_length(text), text.cast("binary")
    hashed = (size == KEY_HEX_CHARS) & (F.translate(text, "0123456789abcdef", "") == "")
    return F.when(hashed, F.unhex(text)).when(size == KEY_HEX_CHARS // 2 - 1, F.concat(F.lit(b"\x02\x02"), own)).otherwise(
        F.concat(F.lit(b"\x01"), own))


def unpacked_key(packed: Column | str) -> Column:
    """The key that :func:`packed_key` made bytes of."""
    own = F.col(packed) if isinstance(packed, str) else packed
    marks = F.when(F.substring(own, 1, 1) == F.lit(b"\x02"), F.lit(2)).otherwise(F.lit(1))
    return F.when(F.octet_length(own) == KEY_HEX_CHARS // 2, F.lower(F.hex(own))).otherwise(
        F.substring(own, marks + 1, F.octet_length(own)).cast("string"))
