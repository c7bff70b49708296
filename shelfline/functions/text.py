"""Text building and parsing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import constants as C

SEPARATOR = "^"


def format_payload(columns: Sequence[Column | str], nulls: str = "skip") -> Column:
    """``^``-joined message text.

    ``nulls`` says what a NULL part does: ``propagate`` makes the message NULL, ``skip`` leaves
    the part and its separator out, ``blank`` writes it as empty text.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    if nulls == "skip":
        return F.concat_ws(SEPARATOR, *parts)
    if nulls not in ("propagate", "blank"):
        raise ValueError(f"unknown NULL rule {nulls!r}")
    if nulls == "blank":
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(SEPARATOR), part]
    return F.concat(*joined)


def quoted(column: Column | str) -> Column:
    """Text in single quotes, inner quotes doubled."""
    return F.concat(F.lit("'"), F.replace(column, F.lit("'"), F.lit("''")), F.lit("'"))


def full_mod_name(dev_name: str = "dev_name", mod_id: str = "mod_id") -> Column:
    """The name a modification has on the shop: ``<device>: <modification>``."""
    return F.concat(F.col(dev_name), F.lit(": "), F.col(mod_id))


def trailing_number(name: Column | str) -> Column:
    """Digits that end an item name after a colon, NULL when there are none."""
    return F.nullif(F.regexp_extract(name, C.TRAILING_NUMBER, 1), F.lit(""))


def mod_number(mod_id: Column | str) -> Column:
    """A modification id as a number of any length up to 38 digits, NULL when it is not one."""
    column = F.col(mod_id) if isinstance(mod_id, str) else mod_id
    return column.try_cast(T.DecimalType(38, 0))


def null_as_text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("NULL"))
