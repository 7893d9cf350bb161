"""Names that list ingredients: where one ends and the next begins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between the items of separated().
BREAK = "\u0001"

_DELIMITER = r"+＋&/|;,\t\n\r"
_EDGE = rf"[^\s\u0085\u00a0{_DELIMITER}]"
_PLAIN = rf"(?i)[{_DELIMITER}]|(?<!{_EDGE})(?:and|with|plus)(?!{_EDGE})"
#: quoted and bracketed stretches, words, delimiters
_PIECES = rf"\x22[^\x22]*\x22|“[^”]*”|'[^']*'|\([^()]*\)|\[[^\[\]]*\]|[^\s\u0085\u00a0{_DELIMITER}\x22“(\[]+|[{_DELIMITER}\x22“(\[]"
_ALONE = rf"^(?:[{_DELIMITER}]|(?i:and|with|plus))$"


def separated(name: Column) -> Column:
    """The name with BREAK for whatever joins its ingredients. What quotes and brackets hold stays together.

    Names without quotes and brackets, most of them, take one pattern; the others are cut into pieces.
    """
    pieces = F.transform(F.regexp_extract_all(name, F.lit(_PIECES), F.lit(0)), lambda p: F.when(p.rlike(_ALONE), F.lit(BREAK)).otherwise(F.concat(F.lit(" "), p)))
    return F.when(name.rlike(r"[\x22“'(\[]"), F.array_join(pieces, "")).otherwise(F.regexp_replace(name, _PLAIN, BREAK))
