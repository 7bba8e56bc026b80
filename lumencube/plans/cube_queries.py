"""The demonstration queries as DataFrame plans over typed cube tables.

``index``: istat, component, value, raw; ``dim``: istat, label, region; others as named in each query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_index(index: DataFrame, dim: DataFrame, n: int = 10, lowest: bool = False, component: str = "aggregate") -> DataFrame:
    """The n provinces with the highest (or lowest) index; ties by code."""
    order = F.asc("value") if lowest else F.desc("value")
    return index.where(F.col("component") == component).join(dim, "istat").select("istat", "label", "value").orderBy(order, "istat").limit(n)


def breakdown(index: DataFrame, istat: str) -> DataFrame:
    """All components of one province."""
    return index.where(F.col("istat") == istat).select("component", "value", "raw")


def managements_by_region(pensions: DataFrame, dim: DataFrame, region: str) -> DataFrame:
    """Every management but the total, of the provinces of a region."""
    return pensions.where(F.col("management") != "TOT").join(dim.where(F.col("region") == region), "istat").select("label", "management", "count", "mean").orderBy("label", "management")


def growth(series: DataFrame, offices: list[str], first: int, last: int) -> DataFrame:
    """Counts of two years and the growth in per cent, of the named offices; one pass by conditional sums."""
    some = series.where(F.col("office").isin(*offices) & F.col("year").isin(first, last))
    both = some.groupBy("office").agg(F.max(F.when(F.col("year") == first, F.col("count"))).alias("before"), F.max(F.when(F.col("year") == last, F.col("count"))).alias("after"))
    return both.where(F.col("before").isNotNull() & F.col("after").isNotNull()).withColumn("growth_pct", F.round(F.try_divide((F.col("after") - F.col("before")) * 100.0, F.col("before")), 4))


def estimated_by_cube(observations: DataFrame) -> DataFrame:
    """Observations with status E by dataset."""
    return observations.where(F.col("status") == "E").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def pensions_by_income(pensions: DataFrame, incomes: DataFrame, codes: list[str]) -> DataFrame:
    """Total pension spending in per cent of income, of the named provinces."""
    total = pensions.where((F.col("management") == "TOT") & F.col("istat").isin(*codes)).select("istat", "annual_millions")
    income = incomes.where(F.col("istat").isin(*codes)).groupBy("istat").agg(F.sum("amount").cast("double").alias("income"))
    return total.join(income, "istat").withColumn("pct", F.round(F.try_divide(F.col("annual_millions") * 1e8, F.col("income")), 4))


def retributive_share_by_region(regimes: DataFrame, bridge: DataFrame, dim: DataFrame) -> DataFrame:
    """Share of retributive pensions by region; offices of several provinces have no part."""
    single = bridge.groupBy("office").agg(F.count(F.lit(1)).alias("n"), F.min("istat").alias("istat")).where(F.col("n") == 1)
    rows = regimes.join(single, "office").join(dim, "istat")
    sums = rows.groupBy("region").agg(F.sum(F.when(F.col("regime") == "retributivo", F.col("count"))).alias("retributive"), F.sum("count").alias("total"))
    return sums.select("region", "retributive", "total", F.round(F.try_divide(F.col("retributive").cast("double"), F.col("total")), 4).alias("share"))


def age_by_decade(start_years: DataFrame) -> DataFrame:
    """Mean start age by decade, weighted by pensions."""
    decade = (F.floor(F.col("year") / 10) * 10).cast("bigint").alias("decade")
    sums = start_years.where(F.col("age").isNotNull() & (F.col("count") > 0)).groupBy(decade).agg(F.sum(F.col("age") * F.col("count")).alias("w"), F.sum("count").alias("pensions"))
    return sums.select("decade", F.round(F.try_divide("w", "pensions"), 4).alias("mean_age"), "pensions")


def expected_duration(life: DataFrame, start_years: DataFrame) -> DataFrame:
    """Life expectancy at 65 plus 65 less the national weighted start age, by province; the one-row mean is broadcast."""
    age = start_years.where(F.col("age").isNotNull() & (F.col("count") > 0)).agg(F.try_divide(F.sum(F.col("age") * F.col("count")), F.sum("count").cast("double")).alias("age"))
    return life.crossJoin(F.broadcast(age)).select("istat", F.round(F.col("expectancy") + 65 - F.col("age"), 4).alias("years"))


def national_series(series: DataFrame) -> DataFrame:
    """Totals by year and the mean weighted by counts, rounded to one digit; rows without count or mean don't weigh."""
    ok = (F.col("count") > 0) & F.col("mean").isNotNull()
    sums = series.groupBy("year").agg(F.sum("count").alias("total"), F.sum(F.when(ok, F.col("count") * F.col("mean"))).alias("w"), F.sum(F.when(ok, F.col("count"))).alias("n"))
    return sums.select("year", "total", F.round(F.try_divide("w", "n"), 1).alias("mean"))


def macro_area(nuts: DataFrame, areas: dict[str, str], by_office: dict[str, str]) -> DataFrame:
    """(office, macro): from the third letter of the first NUTS code, or by name; "Altro" if neither."""
    letter = F.substring(F.element_at(F.array_sort(F.filter("nuts", lambda c: F.char_length(c) >= 3)), 1), 3, 1)
    ladder = F.lit(None).cast("string")
    for k, a in areas.items():
        ladder = F.when(letter == k, a).otherwise(ladder)
    named = F.lit(None).cast("string")
    for k, a in by_office.items():
        named = F.when(F.col("office") == k, a).otherwise(named)
    return nuts.select("office", F.coalesce(named, ladder, F.lit("Altro")).alias("macro"))


def identity_card(istat: str, index: DataFrame, pensions: DataFrame, employed: DataFrame, incomes: DataFrame) -> DataFrame:
    """(kind, value): the index and its raw components, pensions, employed persons and income of one province."""
    here = lambda d: d.where(F.col("istat") == istat)
    own = here(index).select(F.when(F.col("component") == "aggregate", "index").otherwise(F.col("component")).alias("kind"), F.when(F.col("component") == "aggregate", F.col("value")).otherwise(F.col("raw")).alias("value"))
    total = here(pensions).where(F.col("management") == "TOT").select(F.lit("pensions").alias("kind"), F.col("count").cast("double").alias("value"))
    work = here(employed).select(F.lit("employed").alias("kind"), F.col("thousands").alias("value"))
    income = here(incomes).agg(F.sum("amount").cast("double").alias("value")).select(F.lit("income").alias("kind"), "value")
    return own.unionByName(total).unionByName(work).unionByName(income)
