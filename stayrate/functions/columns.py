"""Column expressions shared by the operators. All run inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def as_col(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_blank(value: Col) -> Column:
    """True for an empty or all-space string; NULL stays NULL."""
    return F.trim(as_col(value)) == ""


def to_number(value: Col) -> Column:
    """Text to double; anything unreadable becomes NULL instead of an ANSI error."""
    return F.trim(as_col(value)).try_cast("double")


def trim_null(value: Col) -> Column:
    return F.nullif(F.trim(as_col(value)), F.lit(""))


def is_yes(value: Col) -> Column:
    """1 for ``Yes``, 0 for everything else including NULL."""
    return F.when(as_col(value) == "Yes", 1).otherwise(0)


def loose_yes(value: Col) -> Column:
    """1 when the trimmed, lower-cased text is ``yes``."""
    return F.when(F.lower(F.trim(as_col(value).cast("string"))) == "yes", 1).otherwise(0)


def flag(condition: Column) -> Column:
    """0/1 from a predicate; an unknown predicate is 0, as in SQL ``CASE``."""
    return F.when(condition, 1).otherwise(0)


def total(value: Col) -> Column:
    """Money sum, exact in decimals, so the order of rows cannot change it."""
    return F.sum(as_col(value).cast("decimal(18,2)")).cast("double")


def mean(value: Col, digits: int = 2) -> Column:
    """Money mean over an exact decimal sum."""
    return F.round(F.try_divide(total(value), F.count(as_col(value))), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def ratio(part: Column, whole: Column) -> Column:
    """Division that answers 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def recode(value: Col, mapping: dict, otherwise: object = None) -> Column:
    """Literal recode map; values outside it become ``otherwise``."""
    column = as_col(value)
    chain = None
    for key, result in mapping.items():
        step = column == F.lit(key)
        chain = F.when(step, F.lit(result)) if chain is None else chain.when(step, F.lit(result))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain


def has_any(columns: list[str], value: str = "Yes") -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.coalesce(F.col(name) == value, F.lit(False))
    return condition.cast("int")


def add_up(columns: list[Column]) -> Column:
    result = columns[0]
    for column in columns[1:]:
        result = result + column
    return result
