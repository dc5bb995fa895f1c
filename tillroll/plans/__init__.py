"""Logical plans: the cleaners (C1-C5) and the six reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import with_position
from tillroll.plans import (
    customer_profile,
    customer_retention,
    customer_transactions,
    monthly_performance,
    monthly_sales,
    order_lines,
    order_summary,
)


@dataclass(frozen=True)
class Derived:
    """An intermediate result several reports read: built once per batch run
    from cleaned inputs and shared like them."""

    name: str
    inputs: tuple[str, ...]
    build: Callable


DERIVED: dict[str, Derived] = {
    "order_category_lines": Derived("order_category_lines", ("order_items", "products"),
                                    order_lines.order_category_lines),
}


@dataclass(frozen=True)
class Report:
    """A registered report: its output table name, the cleaned inputs it
    reads, ``transform(**inputs, date=...) -> DataFrame``, its display
    order, and the shared intermediates (``DERIVED``) its transform accepts
    as keyword arguments instead of building them itself."""

    name: str
    inputs: tuple[str, ...]
    transform: Callable
    order_by: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()

    def ordered(self, df: DataFrame) -> DataFrame:
        """The report's display order (ascending, NULLs first).  A global sort
        is a range shuffle and is lost by any table write, so it is applied
        only for display, never on the sink path."""
        if not self.order_by:
            return df
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in self.order_by])

    def positioned(self, df: DataFrame) -> DataFrame:
        """The display order as a column, which a table write keeps: ``position``
        from 1.  Every report with a display order is unique on it."""
        if not self.order_by:
            raise ValueError(f"{self.name} has no display order")
        return with_position(df, [F.col(c).asc_nulls_first() for c in self.order_by])


REPORTS: dict[str, Report] = {
    r.name: r
    for r in [
        Report("order_summary", ("orders", "customers", "order_items", "products", "transactions"),
               order_summary.transform, derived=("order_category_lines",)),
        Report("monthly_sales", ("orders", "customers", "order_items", "products", "transactions"),
               monthly_sales.transform, ("year", "month", "region", "category"),
               derived=("order_category_lines",)),
        Report("monthly_performance", ("orders", "transactions"), monthly_performance.transform,
               ("year", "month")),
        Report("customer_profile_summary", ("orders", "customers", "order_items", "products"),
               customer_profile.transform, derived=("order_category_lines",)),
        Report("customer_transactions", ("orders", "customers", "transactions"),
               customer_transactions.transform),
        Report("customer_retention", ("orders", "customers"), customer_retention.transform,
               ("cohort_year", "cohort_month", "periods_since_cohort")),
    ]
}
