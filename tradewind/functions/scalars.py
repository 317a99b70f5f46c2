"""Column expressions shared by every build. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


# --- ids and text -------------------------------------------------------------
def id_digits(c: Column) -> Column:
    """Trailing digits of an id, NULL when it does not end in digits."""
    return F.regexp_substr(c, F.lit("[0-9]+$"))


def id_tail(c: Column) -> Column:
    """Everything after the last slash."""
    return F.element_at(F.split(c, "/"), -1)


def null_if_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def join_array(c: Column, separator: str = ",") -> Column:
    """Array to text; NULL for a NULL or empty array."""
    return F.when(F.size(c) > 0, F.concat_ws(separator, c))


def full_name(first: Column, last: Column) -> Column:
    return null_if_blank(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def titled(product: Column, variant: Column, default_title: str = "Default Title") -> Column:
    suffix = F.when(variant != default_title, F.concat(F.lit(" - "), variant)).otherwise("")
    return F.concat(product, suffix)


def first_match(c: Column, rules: Mapping[str, str], default: Column | None = None) -> Column:
    """Label of the first rule whose text occurs in ``c``."""
    out = F.lit(None).cast("string") if default is None else default
    for needle, label in reversed(list(rules.items())):
        out = F.when(c.contains(needle), F.lit(label)).otherwise(out)
    return out


# --- flags --------------------------------------------------------------------
def flag(predicate: Column) -> Column:
    """Two-valued truth: NULL counts as false."""
    return F.coalesce(predicate, F.lit(False))


def one_of(c: Column, values: Iterable[str]) -> Column:
    return flag(c.isin(*values))


def count_if(predicate: Column) -> Column:
    return F.count(F.when(predicate, 1))


# --- numbers ------------------------------------------------------------------
def money(c: Column) -> Column:
    return c.try_cast(MONEY)


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole as a decimal, NULL unless whole is positive.

    Scaling before the division keeps at least sixteen decimals of the quotient, so the
    later rounding to two places is exact.
    """
    return F.when(whole > 0, part.cast(MONEY) * 100 / whole.cast(MONEY))


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """Reported rate as a double; NULL on a zero denominator."""
    quotient = numerator.cast("double") * F.lit(float(scale)) if scale != 1.0 else numerator.cast("double")
    return quotient / F.nullif(denominator.cast("double"), F.lit(0.0))


def spread_of(c: Column, name: str) -> list[Column]:
    """Sum and count of the filled values, the exact parts of an average."""
    return [F.sum(c).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n")]


# fixed values: grams per unit
GRAMS_PER_UNIT = {"GRAMS": "1", "KILOGRAMS": "1000", "POUNDS": "453.592", "OUNCES": "28.3495"}


def weight_in_grams(weight: Column, unit: Column) -> Column:
    out = weight.cast("decimal(20,6)")
    for name, factor in GRAMS_PER_UNIT.items():
        scaled = (weight * F.lit(factor).cast("decimal(10,4)")).cast("decimal(20,6)")
        out = F.when(F.upper(unit) == name, scaled).otherwise(out)
    return out


# --- dates and times ----------------------------------------------------------
def date_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_key(c: Column) -> Column:
    return F.year(c) * 100 + F.month(c)


def parse_utc(c: Column) -> Column:
    """ISO-8601 text to a zone-free UTC timestamp, NULL when it does not parse.

    Text that carries a zone is shifted to UTC; text without one is taken as UTC.
    The result does not depend on the session time zone.
    """
    has_zone = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.unix_micros(c.try_cast("timestamp")).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    zoned = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.when(has_zone, zoned).otherwise(c.try_cast("timestamp_ntz"))


def micros_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))
