"""Text-to-value conversions with the semantics of the SQL dialect that tracker logs rely on.

Each differs from Spark's own cast in a few spellings; see the docstrings. All are column
expressions inside whole-stage code.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_CANONICAL = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?\z"
_LOOSE = r"\A\s*([0-9]{1,4})([-/\\ ])([0-9]{1,2})\2([0-9]{1,2})(?:(?: +|T)([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\.([0-9]*))?)?\s*(?:Z|UTC|[+-][0-9]{2}(?::?[0-9]{2})?)?\s*)?\z"
_NUMBER = r"\A\s*\+?-?(?:(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*\z"


# Unicode space separators, and white space of any kind.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c) == "Zs")
_WHITE = _SPACES + "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u2028\u2029"


def clean_text(c: Column) -> Column:
    """Without Unicode space separators around (tabs stay); blank is null."""
    return F.nullif(F.trim(c.cast("string"), F.lit(_SPACES)), F.lit(""))


def try_timestamp(c: Column) -> Column:
    """A naive timestamp, or null.

    Takes one-digit months, days and clock parts, ``/`` or a blank as date separator, dates alone,
    times to the minute, fractions of any length (cut to microseconds), 24:00:00 as the next
    midnight, and zone suffixes, which are ignored. Hours alone and year-month don't count.
    Years beyond 1 to 9999, ``infinity`` and ``epoch`` are null.
    """
    quick = F.when(c.rlike(_CANONICAL) & ~c.startswith("0000"), F.replace(c, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz"))
    # few rows come this way: the text is taken apart once, and a lambda binds its parts
    parts = F.when(c.rlike(_LOOSE), F.split(F.regexp_replace(c, _LOOSE, "$1,$3,$4,$5,$6,$7,$8"), ","))
    return F.when(c.isNull(), None).otherwise(F.coalesce(quick, F.transform(F.array(parts), _loose_timestamp)[0]))


def _loose_timestamp(parts: Column) -> Column:
    """From year, month, day, hour, minute, second and fraction as text; absent ones are empty."""
    num = lambda i: F.coalesce(parts[i].try_cast("int"), F.lit(0))
    hour, minute, sec = num(3), num(4), num(5)
    frac = F.rpad(F.substring(parts[6], 1, 6), 6, "0")
    seconds = F.concat(sec.cast("string"), F.lit("."), frac).cast("decimal(8,6)")
    midnight = (hour == 24) & (minute == 0) & (seconds == 0)
    made = F.call_function("try_make_timestamp_ntz", num(0), num(1), num(2), F.when(midnight, 0).otherwise(hour), minute, seconds)
    return F.when((num(0) >= 1) & (sec < 60), F.when(midnight, made + F.make_dt_interval(days=F.lit(1))).otherwise(made))


def try_double(c: Column) -> Column:
    """A double, or null: takes ``_`` between digits, inf and nan; not ``1d`` or ``0x1``."""
    return F.when(c.rlike(_NUMBER), F.translate(c, "_+", "").try_cast("double"))


def try_integer(c: Column, kind: str = "int") -> Column:
    """Through double, rounded half to even; null beyond the type's range."""
    limit = 2147483647.5 if kind == "int" else 9.2233720368547e18
    r = F.rint(try_double(c))
    return F.when(F.abs(r + 0.5) <= limit, r.try_cast(kind))


def full_match(c: Column, pattern: str) -> Column:
    """Whether the whole text matches; a trailing newline counts, null is false."""
    return F.coalesce(c.rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def strip_all(c: Column) -> Column:
    """Without white space of any kind around."""
    return F.trim(c, F.lit(_WHITE))


def rounded_mean(c: Column, digits: int, where: Column | None = None) -> Column:
    """Mean of a double, rounded half up; nulls don't count, nor do rows outside ``where``.

    Where every value is a decimal of at most 22 and 6 places, the sum is exact, so that no order
    of rows decides a mean that lies between two roundings; else, as with NaN, infinity, very
    large or finer values, it is the plain mean.
    """
    v = c if where is None else F.when(where, c)
    exact = v.try_cast("decimal(28,6)")
    other = F.count_if(v.isNotNull() & ~F.coalesce(exact.cast("double") == v, F.lit(False)))
    mean = F.try_divide(F.sum(exact).cast("double"), F.count(v))
    rounded = F.coalesce(F.round(mean.try_cast("decimal(38,10)"), digits).cast("double"), F.round(mean, digits))
    return F.when(other > 0, F.round(F.avg(v), digits)).otherwise(rounded)


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent as a double; null for nothing of nothing."""
    share = part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0)).cast("double")
    return F.round(share.cast("decimal(28,10)"), digits).cast("double")
