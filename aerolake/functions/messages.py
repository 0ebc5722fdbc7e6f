"""Message encoding (SCA1-3): topic bytes <-> text <-> typed struct."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from aerolake import schemas


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def message_text(value_col="value") -> Column:
    """Topic value bytes -> text (CAST(value AS STRING))."""
    return _c(value_col).cast("string")


def parse_request(text_col="value", keep_corrupt: bool = True) -> Column:
    """JSON text -> request struct; permissive: a malformed message gives nulls
    and, with ``keep_corrupt``, its text in ``_corrupt_record``."""
    schema = schemas.REQUEST_WITH_CORRUPT if keep_corrupt else schemas.REQUEST
    opts = {"columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN} if keep_corrupt else {}
    return F.from_json(_c(text_col), schema, opts)


# Time stamps in JSON keep their microseconds (Spark's default JSON format cuts
# them to milliseconds); the default parser reads this format back exactly.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTIONS = {"timestampFormat": JSON_TIMESTAMP_FORMAT}


def to_message(*cols) -> Column:
    """Columns -> JSON object text; null fields are left out, time stamps keep
    their microseconds."""
    return F.to_json(F.struct(*[_c(c) for c in cols]), JSON_OPTIONS)
