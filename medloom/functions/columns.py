"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Unicode has it; plain \s misses the no-break space.
SPACE = r"[\s\u0085\u00a0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"


def squeeze(text: Column) -> Column:
    """Runs of whitespace as one blank, outer whitespace dropped."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def blank_to_null(text: Column) -> Column:
    """Null for texts of whitespace only."""
    return F.when(~text.rlike("^" + SPACE + "*$"), text)


def letters_only(text: Column) -> Column:
    """Lower case, letters, marks and digits only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and inside whatever lambda it is mentioned there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
