"""Quarter-over-quarter growth decline."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent_change
from ..operators.filters import in_period
from .sales import dealer_totals


@dataclasses.dataclass(frozen=True)
class Quarters:
    """First and last day of the compared quarters, as 8-digit integers."""

    current: tuple[int, int]
    current_last_year: tuple[int, int]
    previous: tuple[int, int]
    previous_last_year: tuple[int, int]

    @classmethod
    def of_fiscal_third(cls, year: int) -> Quarters:
        """October to December against July to September, both against the year before."""
        return cls(
            (year * 10000 + 1001, year * 10000 + 1231),
            (year * 10000 - 10000 + 1001, year * 10000 - 10000 + 1231),
            (year * 10000 + 701, year * 10000 + 930),
            (year * 10000 - 10000 + 701, year * 10000 - 10000 + 930),
        )


def _amount(period: tuple[int, int]) -> Column:
    """Exact sum of the period's sales, NULL without any."""
    return F.sum(F.when(in_period("invoice_date", *period), F.col("sales").cast("decimal(18,4)")))


def _measures(quarters: Quarters) -> tuple[dict[str, Column], Column]:
    """Sums of the four quarters and rows of the current one, and the condition for rows inside any."""
    q = dataclasses.asdict(quarters)
    rows = F.sum(F.when(in_period("invoice_date", *quarters.current), F.lit(1)).cast("decimal(12,0)"))
    wanted = reduce(lambda a, b: a | b, [in_period("invoice_date", *period) for period in q.values()])
    return {"_rows": rows} | {name: _amount(period) for name, period in q.items()}, wanted


BY = ("tsi_name", "sh_3_name")


def growth_decline(view: DataFrame, quarters: Quarters) -> DataFrame:
    """Territories and clusters growing slower than the quarter before.

    One aggregation serves all four quarters: rows outside them are filtered at
    the scan and partial sums are combined before the shuffle.
    """
    totals, wanted = _measures(quarters)
    named = F.col("tsi_name").isNotNull() & F.col("sh_3_name").isNotNull()
    return declines(view.filter(wanted & named).groupBy(*BY).agg(*[v.alias(n) for n, v in totals.items()]))


def growth_decline_of(
    tables: Mapping[str, DataFrame],
    quarters: Quarters,
    cutoff: int,
    material_types: Sequence[str],
    allowed: Callable[[DataFrame], DataFrame] = lambda side: side,
) -> DataFrame:
    """The same over the secondary view of ``tables``, from sums made before any join."""
    totals, wanted = _measures(quarters)
    named = lambda side: allowed(side).filter("tsi_name IS NOT NULL AND sh_3_name IS NOT NULL")
    return declines(dealer_totals(tables, BY, totals, wanted, cutoff, material_types, named))


def declines(totals: DataFrame) -> DataFrame:
    """Growth of the quarters against the year before, where it fell."""
    known = totals.filter(
        (F.col("_rows") > 0) & F.col("current_last_year").isNotNull() & F.col("previous_last_year").isNotNull()
    ).select(*BY, *[F.col(f.name).cast("double").alias(f.name) for f in dataclasses.fields(Quarters)])
    zero = F.lit(0.0)
    growth = known.select(
        F.col("tsi_name").alias("tsi_territory_name"),
        F.col("sh_3_name").alias("cluster"),
        percent_change(F.coalesce("current", zero), F.col("current_last_year")).alias("_now"),
        percent_change(F.coalesce("previous", zero), F.col("previous_last_year")).alias("_before"),
    )
    return (
        growth.filter(F.col("_now") < F.col("_before"))
        .select(
            "tsi_territory_name",
            "cluster",
            F.concat(F.col("_now").cast("string"), F.lit("%")).alias("current_quarter_growth"),
            F.concat(F.col("_before").cast("string"), F.lit("%")).alias("previous_quarter_growth"),
            F.round(F.col("_before") - F.col("_now"), 2).alias("growth_decline"),
        )
        .orderBy(F.desc("growth_decline"))
    )
