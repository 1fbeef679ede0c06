"""Lenient text-to-number casts, as a data contract in lax mode does them; bad text gives NULL.

The input should be stripped already.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_integer(text: Column) -> Column:
    """'6', '+3', '1_000' and '6.0' are integers; '6.5', '6.' and '' are not.

    Values beyond 64 bits give NULL.
    """
    whole = F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), "_", "")
    return F.when(text.rlike(r"\A[+-]?[0-9]{1,18}\z"), text.try_cast("bigint")).when(
        text.rlike(r"\A[+-]?[0-9]+(_[0-9]+)*(\.0+)?\z"), whole.try_cast("bigint")
    )


def to_float(text: Column) -> Column:
    """Decimal and exponent notation with inner underscores, plus the words for infinity and NaN."""
    number = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
    joined = F.regexp_replace(text, "_", "")
    return (
        F.when(text.rlike(number), text.try_cast("double"))
        .when(~text.rlike(r"\A_|_\z|__") & joined.rlike(number), joined.try_cast("double"))
        .when(text.rlike(r"(?i)\A[+-]?nan\z"), F.lit(float("nan")))
        .when(text.rlike(r"(?i)\A\+?inf(inity)?\z"), F.lit(float("inf")))
        .when(text.rlike(r"(?i)\A-inf(inity)?\z"), F.lit(float("-inf")))
    )
