"""Number expressions with the typed defaults the targets expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no amount", and the duration code that means "see the free field".
NO_AMOUNT = ["#N/A", ""]
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
PLAIN_NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
FREE_FIELD_DURATION = 100


def cast_numeric(c: Column, to: str) -> Column:
    """Text that is no number gives null rather than an error."""
    return c.try_cast(to)


def number_from_text(c: Column, pattern: str = NUMBER_PATTERN) -> Column:
    """Number in a text, null where it holds none. The pattern comes first, as a failing cast is slow."""
    return F.regexp_substr(c, F.lit(pattern)).try_cast("double")


def to_number_or_zero(c: Column, to: str = "double") -> Column:
    """Number read from text, 0 when it is none. A whole-number target drops the decimals."""
    number = number_from_text(c)
    if to != "double":
        number = number.try_cast(to)
    return F.coalesce(number, F.lit(0).cast(to))


def round_or_zero(c: Column, digits: int = 2) -> Column:
    """Rounded amount, 0 for the no-amount texts. Rounds the shown decimal value half up. Null stays null; any other
    text that is no number stops the load, as the source's own conversion does."""
    number = number_from_text(c)
    wrong = F.raise_error(F.concat(F.lit("not an amount: "), c)).cast("double")
    return F.when(c.isin(*NO_AMOUNT), F.lit(0.0)).when(c.isNotNull() & number.isNull(), wrong).otherwise(F.round(number, digits))


def number_or_zero(c: Column, to: str = "double") -> Column:
    return F.coalesce(c.try_cast(to), F.lit(0).cast(to))


def unit_scale(c: Column, factor: int = 1000) -> Column:
    return c * F.lit(factor)


def uniform_duration(code: Column, free_field: Column) -> Column:
    """Months of a duration code: the free field for code 100, the code itself below, else 0."""
    months = F.when(code == FREE_FIELD_DURATION, free_field).when(code < FREE_FIELD_DURATION, code)
    return F.coalesce(months.cast("int"), F.lit(0))


def duration_or_free_field(code: Column, free_field: Column, to: str = "decimal(18,0)") -> Column:
    """As above, but any code other than 100 stands for itself."""
    return F.coalesce(F.when(code == FREE_FIELD_DURATION, free_field).otherwise(code).cast(to), F.lit(0).cast(to))


def margin_formula(
    discounted: Column, is_fixed: Column, fixed_percent: Column, fixed_revenue: Column, percent: Column, revenue: Column
) -> Column:
    """Discounted margin when present and not 0, else percent of revenue for the kind of price calculation."""
    zero = F.lit(0.0)
    fixed = F.coalesce(fixed_percent.cast("double"), zero) * F.coalesce(fixed_revenue.cast("double"), zero) / 100
    other = F.coalesce(percent.cast("double"), zero) * F.coalesce(revenue.cast("double"), zero) / 100
    return (
        F.when(discounted.isNotNull() & (discounted != 0), discounted.cast("double")).when(is_fixed, fixed).otherwise(other)
    )
