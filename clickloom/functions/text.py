"""String expressions: empties, id lists, padding, and `k=v|k=v` records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_empty(col: Column) -> Column:
    """Null or the empty string. Blanks count as text."""
    return F.coalesce(col, F.lit("")) == ""


def is_not_empty(col: Column) -> Column:
    return ~is_empty(col)


def trim_comma(col: Column) -> Column:
    """Drop at most one comma from each side."""
    return F.regexp_replace(F.regexp_replace(col, "^,", ""), ",\\z", "")


def pad_two(col: Column) -> Column:
    """Two-character text stays, anything else gets one leading zero."""
    return F.when(F.length(col) == 2, col).otherwise(F.concat(F.lit("0"), col))


def tokens(col: Column, pattern: str = ",") -> Column:
    """Split without the trailing empty tokens that `split` would keep."""
    return F.split(F.regexp_replace(col, f"({pattern})+\\z", ""), pattern)


def as_id(token: Column) -> Column:
    """Text to bigint, null if it is no number. A try_cast that fails is slow, so text
    that cannot pass is not tried."""
    return F.when(token.rlike(r"^[+-]?[0-9]+\z"), token.try_cast("bigint"))


def id_list(col: Column) -> Column:
    """Comma list of ids as array<bigint>; null, empty and non-numeric tokens are left out."""
    ids = F.transform(F.split(col, ","), as_id)
    return F.coalesce(F.filter(ids, lambda i: i.isNotNull()), F.array().cast("array<bigint>"))


def joined_set(col: Column) -> Column:
    """Aggregate: the distinct non-null values, in order, as one comma list."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(col)), lambda v: v.cast("string")), ",")


def pack_fields(**fields: Column) -> Column:
    """`name=value|name=value`; a null value becomes an empty one."""
    return F.concat_ws(
        "|",
        *[F.concat(F.lit(f"{name}="), F.coalesce(col.cast("string"), F.lit(""))) for name, col in fields.items()],
    )


def get_field(col: Column, name: str) -> Column:
    """Value of the first `name=value` part; null if absent, empty, or itself holding `=`."""
    found = F.filter(
        F.split(col, "\\|"), lambda p: p.startswith(f"{name}=") & F.substr(p, F.lit(len(name) + 1)).rlike("^=[^=]+=*$")
    )
    return F.regexp_extract(F.substr(F.try_element_at(found, F.lit(1)), F.lit(len(name) + 1)), "^=([^=]+)", 1)


def set_field(col: Column, name: str, value: Column) -> Column:
    """Replace the value of the first part called `name`, by nothing if `value` is null; text
    without it stays as it is."""
    parts = F.split(col, "\\|")
    names = F.transform(parts, lambda p: F.substring_index(p, "=", 1))
    at = F.array_position(names, F.lit(name))
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(i + 1 == at, F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("")))).otherwise(p)),
        "|",
    )
