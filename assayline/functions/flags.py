"""Warning flags: 1 or 0, never NULL. A flagged row stays in its table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline.functions.clean import as_col


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def negative(c) -> Column:
    return flag(as_col(c) < 0)


def above(c, threshold) -> Column:
    return flag(as_col(c) > threshold)


def missing(c) -> Column:
    return flag(as_col(c).isNull())


def blank(c) -> Column:
    return flag(is_blank(c))


def missing_or_negative(c) -> Column:
    c = as_col(c)
    return flag(c.isNull() | (c < 0))


def not_among(c, allowed) -> Column:
    return flag(is_outside(c, allowed))


def parse_loss(raw, parsed) -> Column:
    """Raw text was there, but reading it gave nothing."""
    return flag(as_col(raw).isNotNull() & as_col(parsed).isNull())


def is_blank(c) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def is_outside(c, allowed) -> Column:
    c = as_col(c)
    return c.isNull() | ~c.isin(list(allowed))
