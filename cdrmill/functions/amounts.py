"""Amounts held as text. Casts are explicit and never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sentinels import NOT_QUALIFIED, ZERO
from .text import as_col


def number(c: Column | str) -> Column:
    return as_col(c).try_cast("double")


def price_or_zero(c: Column | str) -> Column:
    """``NQ`` and null become "0"."""
    c = as_col(c)
    return F.coalesce(F.nullif(c, F.lit(NOT_QUALIFIED)), F.lit(ZERO))


def signed_usage(delta: Column | str, credit: Column | str) -> Column:
    """Credits (``C``) count negative; a null delta counts 0."""
    value = number(delta)
    return (
        F.when(as_col(delta).isNull(), F.lit(0.0))
        .when(as_col(credit) == "C", -value)
        .otherwise(value)
    )


def signed_recharge(amount: Column | str, method: Column | str, credit: Column | str) -> Column:
    """A debited balance transfer counts negative."""
    value = number(amount)
    return F.when((as_col(method) == "BTSOURCE") & (as_col(credit) == "D"), -value).otherwise(value)


def total(c: Column | str) -> Column:
    return F.sum(number(c))
