"""Notification numbers: the series and the integer, however they are written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Series as written, letters only, and the letter they are keyed by.
SERIES = {"gsr": "G", "so": "S", "circular": "C", "circ": "C", "cir": "C"}

_SHAPE = r"^(gsr|so|circular|circ|cir)(?:no)?0*([0-9]+)e?$"


def number_key(number: Column) -> Column:
    """'G. S. R. 0578 ( E )' -> 'G:578'. Null for nulls, blanks and texts that state no number."""
    packed = F.regexp_replace(F.lower(number), "[^a-z0-9]", "")
    digits = F.regexp_extract(packed, _SHAPE, 2)
    return F.when(digits != "", F.concat(F.upper(F.substring(packed, 1, 1)), F.lit(":"), digits))


def sortable_key(number: Column) -> Column:
    """number_key with its integer padded, so that text order is numeric order: 'G:578' -> 'G:000000000000000578'.

    Integers of more than 18 digits keep all digits and sort after the padded ones of their series.
    """
    key = number_key(number)
    digits = F.substring(key, 3, 1 << 20)
    return F.when(F.length(digits) <= 18, F.concat(F.substring(key, 1, 2), F.lpad(digits, 18, "0"))).otherwise(F.concat(F.substring(key, 1, 2), F.lit("~"), digits))
