"""Delay classes, their display text and request status (SCA10-12)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's: class edges of arrival delay in
# minutes (left-closed buckets, as pyspark.ml.feature.Bucketizer) and the text
# shown for each class.
DELAY_SPLITS = [float("-inf"), -15.0, 0.0, 30.0, float("inf")]
CLASS_TEXT = {
    0: "Early (15+ Minutes Early)",
    1: "Slightly Early (0-15 Minute Early)",
    2: "Slightly Late (0-30 Minute Delay)",
    3: "Very Late (30+ Minutes Late)",
}
MISSING_TEXT = "Prediction data not available or in unexpected format."
UNKNOWN_PREFIX = "Unknown prediction value: "

STATUS_WAIT, STATUS_OK, STATUS_TIMEOUT = "WAIT", "OK", "TIMEOUT"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def delay_class(delay_col) -> Column:
    """Delay minutes -> class 0..3 (DOUBLE, as Bucketizer emits); null stays null."""
    d = _c(delay_col)
    expr = None
    for i in range(1, len(DELAY_SPLITS) - 1):
        cond = d < F.lit(DELAY_SPLITS[i])
        expr = F.when(cond, F.lit(float(i - 1))) if expr is None else expr.when(cond, F.lit(float(i - 1)))
    return F.when(d.isNull() | F.isnan(d), F.lit(None).cast("double")).otherwise(
        expr.otherwise(F.lit(float(len(DELAY_SPLITS) - 2))))


def _number_text(v: Column) -> Column:
    # A whole number prints without a fraction, as a browser prints it.
    return F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))


def prediction_label(pred_col) -> Column:
    """Class value (number or text) -> display text."""
    p = _c(pred_col)
    as_num = p.cast("string").try_cast("double")
    expr = F.when(p.isNull(), F.lit(MISSING_TEXT))
    for k, text in CLASS_TEXT.items():
        expr = expr.when(as_num == F.lit(float(k)), F.lit(text))
    shown = F.coalesce(_number_text(as_num), p.cast("string"))
    return expr.otherwise(F.concat(F.lit(UNKNOWN_PREFIX), shown))


def status_column(matched: Column, missing: str = STATUS_WAIT) -> Column:
    """Constant status, overridden with OK where a reply matched."""
    return F.when(matched, F.lit(STATUS_OK)).otherwise(F.lit(missing))
