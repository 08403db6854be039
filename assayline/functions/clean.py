"""Cleaning functions. Each takes a column and returns a column.

Text that cannot be read as the wanted type gives NULL, never an error: ANSI
mode stays on, so every conversion is a `try_` form.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline import contracts as K


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def vocabulary(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Standard word for a raw word, ignoring case; unknown or NULL gives the default."""
    c = as_col(c)
    if not mapping:
        return c
    found = F.try_element_at(_literal_map(mapping), F.lower(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def expand_code(c, mapping: Mapping[str, str] = K.REGION_CODES) -> Column:
    """One-letter codes become words; longer text stays as it is."""
    c = as_col(c)
    return F.when(F.length(c) == 1, F.try_element_at(_literal_map(mapping), c)).otherwise(c)


def null_token(c, *tokens: str, fold_case: bool = False, trim: bool = False) -> Column:
    """NULL where the text is one of the tokens, e.g. '?', 'NULL' or 'NA'."""
    c = as_col(c)
    probe = F.trim(c) if trim else c
    probe = F.upper(probe) if fold_case else probe
    wanted = [t.upper() for t in tokens] if fold_case else list(tokens)
    return F.when(~F.coalesce(probe.isin(wanted), F.lit(False)), c)


def without_trailing_dot(c) -> Column:
    return F.regexp_replace(as_col(c), r"\.$", "")


def first_number(c, pattern: str = r"(\d+\.?\d*)", group: int = 1,
                 strip_commas: bool = True) -> Column:
    """First number in text that carries a unit, as double: '1,248 CC' is 1248.0."""
    c = as_col(c)
    text = F.regexp_replace(c, ",", "") if strip_commas else c
    return F.regexp_extract(text, pattern, group).try_cast("double")


def plain_number(c) -> Column:
    """Variant that keeps commas, so the number ends at the first one."""
    return first_number(c, r"[\d.]+", 0, strip_commas=False)


def pair_part(c, index: int) -> Column:
    """Part of 'a/b' as int in raw units."""
    return F.get(F.split(as_col(c), "/"), F.lit(index)).try_cast("int")


def pair_part_scaled(c, index: int, scale: int = 1000) -> Column:
    """Part of 'a/b' times the scale; needs the slash on the right side of the part."""
    pattern = r"(\d+)/" if index == 0 else r"/(\d+)"
    number = F.regexp_extract(as_col(c), pattern, 1).try_cast("int")
    return F.try_multiply(number, F.lit(scale))


def number(c, dtype: str, invalid: Iterable[str] = ("?", "NULL", "null")) -> Column:
    """Typed number; placeholder words and unreadable text give NULL."""
    return null_token(as_col(c).cast("string"), *invalid).try_cast(dtype)


def truth(c, yes: str, no: str) -> Column:
    """Boolean from a pair of words, ignoring case; anything else is NULL."""
    word = F.upper(as_col(c))
    return F.when(word == yes.upper(), F.lit(True)).when(word == no.upper(), F.lit(False))


def yes_no(c) -> Column:
    return truth(c, "YES", "NO")


def y_n(c) -> Column:
    return truth(c, "Y", "N")


def null_if_negative(c) -> Column:
    c = as_col(c)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def iso_date(c) -> Column:
    """Ten characters of a plain date are cast, which takes a fraction of the time of a format;
    other text that the format reads begins with a sign."""
    c = as_col(c)
    plain = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(plain, c.try_cast("date")).when(c.rlike("^[+-]"), F.try_to_date(c, K.ISO_FORMAT))


def day_first_time(c) -> Column:
    return F.try_to_timestamp(as_col(c), F.lit(K.DAY_FIRST_FORMAT))


def days_between(end, start) -> Column:
    """Whole days from start to end; NULL if either is."""
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date"))


def without_broken_time(c, pattern: str = K.BROKEN_TIME_PATTERN) -> Column:
    """NULL where a date column holds a clock fragment such as '34:00.0'."""
    c = as_col(c)
    return F.when(~F.coalesce(c.rlike(pattern), F.lit(False)), c)


def clock_time(c) -> Column:
    """'08:30' or '08:30.0' as a timestamp of the epoch day; hours above 23 give NULL."""
    text = F.regexp_replace(F.trim(as_col(c)), r"\.0$", "")
    hour = F.get(F.split(text, ":"), F.lit(0)).try_cast("int")
    return F.when(hour.between(0, 23), F.try_to_timestamp(text, F.lit("HH:mm")))


def leading_digits(c) -> Column:
    return F.regexp_extract(as_col(c).cast("string"), r"^(\d+)", 1).try_cast("int")


def salvaged_duration(start, end) -> Column:
    """Difference of the leading digits of two broken times; both positive, not reversed."""
    a, b = leading_digits(start), leading_digits(end)
    return F.when((b >= a) & (a > 0) & (b > 0), b - a)


def total(*amounts, dtype: str = "decimal(14,2)") -> Column:
    """Sum in which a NULL counts as zero."""
    result = F.lit(0).cast(dtype)
    for a in amounts:
        result = (result + F.coalesce(as_col(a), F.lit(0))).cast(dtype)
    return result


def date_key(c) -> Column:
    """Date as the integer YYYYMMDD."""
    c = as_col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def by_presence(c, present, absent) -> Column:
    """One value where the column is set, another where it is NULL."""
    return F.when(as_col(c).isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def first_present(columns: Iterable[str], candidates: Iterable[str],
                  dtype: str = "string") -> Column:
    """First non-NULL of the candidates that exist, each cast before the choice."""
    have = {c.lower() for c in columns}
    found = [F.col(c).try_cast(dtype) for c in candidates if c.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast(dtype)


def swapped(a: str, b: str, condition: Column) -> dict[str, Column]:
    """Columns a and b exchanged in the rows that meet the condition."""
    hit = F.coalesce(condition, F.lit(False))
    return {
        a: F.when(hit, F.col(b)).otherwise(F.col(a)),
        b: F.when(hit, F.col(a)).otherwise(F.col(b)),
    }
