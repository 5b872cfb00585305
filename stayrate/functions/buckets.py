"""Bucketing of a numeric column into named ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayrate.functions.columns import Col, as_col


@dataclass(frozen=True)
class Buckets:
    """``edges[i] .. edges[i+1]`` is ``labels[i]``.

    ``lowest``: lower bound of the first bucket, or None for no lower bound.
    ``closed``: which end of each range belongs to it.
    ``include_lowest``: a right-closed first range also holds its lower bound.
    ``rest``: label above the last edge; None gives NULL; ``error`` raises instead.
    """

    column: str
    edges: tuple
    labels: tuple
    lowest: float | None = None
    closed: str = "right"
    include_lowest: bool = False
    rest: str | None = None
    error: str | None = None

    def expr(self, column: Col | None = None) -> Column:
        value = as_col(column if column is not None else self.column)
        chain = None
        if self.lowest is not None:
            low = F.lit(self.lowest)
            below = (value < low) if self.include_lowest else (value <= low)
            chain = F.when(below, F.lit(None).cast("string"))
        for edge, label in zip(self.edges, self.labels, strict=True):
            inside = (value <= F.lit(edge)) if self.closed == "right" else (value < F.lit(edge))
            chain = F.when(inside, F.lit(label)) if chain is None else chain.when(inside, F.lit(label))
        if self.error is not None:
            # An unknown value is no range error: it stays unknown.
            return chain.when(value.isNotNull(), F.raise_error(F.lit(self.error)))
        return chain.otherwise(F.lit(self.rest)) if self.rest is not None else chain

    def all_labels(self) -> list[str]:
        return [*self.labels, *([self.rest] if self.rest is not None else [])]


# Edges and labels of every bucketing the reports use.
BUCKETS: dict[str, Buckets] = {
    "sql5": Buckets(
        "tenure", (12, 24, 48, 60),
        ("0-12 months (New)", "13-24 months (Growing)", "25-48 months (Established)", "49-60 months (Loyal)"),
        rest="60+ months (Very Loyal)",
    ),
    "sql3": Buckets("tenure", (12, 48), ("New", "Established"), rest="Loyal"),
    "spark4": Buckets("tenure", (12, 24, 48), ("New", "Growing", "Established"), rest="Loyal"),
    "sparkpd": Buckets("tenure", (12, 24, 48, 72), ("New", "Growing", "Established", "Loyal"), lowest=0),
    "dp": Buckets(
        "tenure", (12, 24, 48, 72), ("0-12", "13-24", "25-48", "49-72"), lowest=0, include_lowest=True
    ),
    "fe": Buckets(
        "tenure", (12, 24, 48, 72), ("0-12_months", "13-24_months", "25-48_months", "49-72_months"),
        lowest=0, include_lowest=True,
    ),
    "nb4": Buckets(
        "tenure", (12, 24, 48),
        ("New (0-12 months)", "Growing (13-24 months)", "Established (25-48 months)"),
        rest="Loyal (49+ months)",
    ),
    "nb2": Buckets(
        "tenure", (12, 48, 90, 600), ("New", "Established", "Loyal", "Very Loyal"),
        error="tenure above 600 months",
    ),
    "v": Buckets(
        "tenure", (12, 24, 36, 48), ("0-12 months", "13-24 months", "25-36 months", "37-48 months"),
        rest="49+ months",
    ),
    "x": Buckets(
        "tenure", (12, 24, 48, 60, 9999), ("0-12", "13-24", "25-48", "49-60", "61-72"),
        lowest=0, include_lowest=True,
    ),
    "chg_dp": Buckets(
        "MonthlyCharges", (30, 60, 90, 120), ("Low", "Medium", "High", "Very High"),
        lowest=0, include_lowest=True,
    ),
    "chg_fe": Buckets(
        "MonthlyCharges", (35, 70, 90, 120), ("Low", "Medium", "High", "Premium"),
        lowest=0, include_lowest=True,
    ),
    "chg_v": Buckets(
        "MonthlyCharges", (30, 60, 90), ("$0-30", "$30-60", "$60-90"), closed="left", rest="$90+"
    ),
}


def equal_width_bin(value: Col, low: Column, high: Column, bins: int, closed: str = "right") -> Column:
    """Index of the equal-width bin; edge ``i`` is ``width * i + low``.

    Division only proposes a bin. Comparing with that bin's own edges then keeps a value that
    equals an edge on the side that ``closed`` says, whatever the division rounded to.
    """
    x = as_col(value)
    width = (high - low) / F.lit(float(bins))
    guess = F.least(F.lit(bins - 1.0), F.coalesce(F.floor(F.try_divide(x - low, width)).cast("double"), F.lit(0.0)))
    left, right = width * guess + low, width * (guess + 1) + low
    if closed == "right":
        moved = guess - ((x <= left) & (guess > 0)).cast("int") + ((x > right) & (guess < bins - 1)).cast("int")
    else:
        moved = guess - ((x < left) & (guess > 0)).cast("int") + ((x >= right) & (guess < bins - 1)).cast("int")
    return moved.cast("int")
