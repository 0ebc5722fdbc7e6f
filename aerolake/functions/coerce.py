"""Typed conversion of text fields, null on failure (SCA5).

Surrounding white space of any kind is trimmed first, as Python's ``int`` and
``float`` do. A pattern then decides what counts as a number, because a cast alone
also takes type suffixes ("1d", "1f"): ``try_int`` rejects a fraction or exponent
("5.0", "1e3"), ``try_double`` takes them and the words for infinity and not-a-number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_INT = r"^[+-]?[0-9]+$"
_FLOAT = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _trimmed(col) -> Column:
    return F.regexp_replace(_c(col).cast("string"), r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def try_double(col) -> Column:
    t = _trimmed(col)
    bare = F.regexp_replace(F.lower(t), r"^[+-]", "")
    number = F.when(bare == "nan", F.lit(float("nan"))).otherwise(t.try_cast("double"))
    return F.when(t.rlike(_FLOAT), number)


def try_int(col) -> Column:
    t = _trimmed(col)
    return F.when(t.rlike(_INT), t.try_cast("int"))


def try_text(col) -> Column:
    return _c(col).cast("string")
