"""Column-level functions (SCA*): each returns a Column built from Spark built-ins."""

from aerolake.functions.dates import date_parts, day_after, day_of_week, iso_day
from aerolake.functions.labels import delay_class, prediction_label, status_column
from aerolake.functions.coerce import try_double, try_int, try_text
from aerolake.functions.messages import parse_request, to_message, message_text

__all__ = [
    "date_parts", "day_after", "day_of_week", "iso_day",
    "delay_class", "prediction_label", "status_column",
    "try_double", "try_int", "try_text",
    "parse_request", "to_message", "message_text",
]
