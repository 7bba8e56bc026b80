"""Composite indices: min-max normalisation, means of components, long form with provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import shared_dir, written
from .quantiles import exact_quantiles
from .reshape import unpivot


def minmax(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); 0.5 for everything if they are equal."""
    return F.when(value.isNotNull(), F.when(high == low, F.lit(0.5)).otherwise((value - low) / (high - low)))


def normalized(data: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Add the normalized form of each column. The bounds are one row, joined back: no window holds all rows in one task."""
    bounds = data.agg(*[F.min(c).alias(f"__lo_{c}") for c in columns], *[F.max(c).alias(f"__hi_{c}") for c in columns])
    both = data.crossJoin(F.broadcast(bounds))  # one row by construction
    return both.select(*data.columns, *[minmax(F.col(c), F.col(f"__lo_{c}"), F.col(f"__hi_{c}")).alias(c + suffix) for c in columns])


def composite_long(data: DataFrame, key: Sequence[str], components: Sequence[str], sources: Mapping[str, Column] | None = None, digits: int = 6) -> DataFrame:
    """A row for each component and one for the mean of their normalized values.

    Columns: key, component, value (normalized, or the mean), raw (null for the mean), sources array<string>:
    those of the component; the mean has those named ``aggregate``, or all of the components', sorted.
    """
    sources = dict(sources or {})
    none = F.array().cast("array<string>")
    own = {c: F.filter(sources.get(c, none), lambda x: x.isNotNull()) for c in components}
    every = F.array_sort(F.array_distinct(F.concat(*own.values())))
    norm = normalized(data.withColumns({f"__src_{c}": s for c, s in own.items()} | {"__src_mean": sources.get("aggregate", every)}), components)
    mean = sum((F.col(f"{c}_norm") for c in components[1:]), F.col(f"{components[0]}_norm")) / len(components)
    rows = {c: {"value": F.round(F.col(f"{c}_norm"), digits), "raw": F.round(F.col(c).cast("double"), digits), "sources": F.col(f"__src_{c}")} for c in components}
    rows["aggregate"] = {"value": F.round(mean, digits), "raw": F.lit(None).cast("double"), "sources": F.col("__src_mean")}
    return unpivot(norm, key, rows, "component")


def index_components(pensions: DataFrame, employed: DataFrame, incomes: DataFrame, offices: DataFrame, projected: DataFrame) -> DataFrame:
    """The three ratios of each province, from tables keyed by istat.

    pensions: istat, total_count, total_millions, private, public, self_employed (counts);
    employed: istat, thousands; incomes: istat, amount (a row for each kind); offices: istat, count
    (retributive, by office; an office of several provinces counts in each) and, if provenance is to name
    them, slug, which gives ``office_slugs``; projected: istat, count.
    d1 = pensions per employed person, d2 = pension spending by income, d3 = share of retributive
    pensions among the three managements.
    """
    income = incomes.groupBy("istat").agg(F.sum("amount").cast("double").alias("income"))
    slugs = [F.array_sort(F.collect_set("slug")).alias("office_slugs")] if "slug" in offices.columns else []  # a province's offices are few
    office = offices.groupBy("istat").agg(F.sum("count").alias("office"), *slugs)
    plan = projected.groupBy("istat").agg(F.sum("count").alias("plan"))
    all_ = pensions.join(employed, "istat").join(income, "istat").join(office, "istat").join(plan, "istat")
    return all_.select(
        "istat",
        F.try_divide(F.col("total_count").cast("double"), F.col("thousands") * 1000).alias("d1"),
        F.try_divide(F.col("total_millions") * 1e6, F.col("income")).alias("d2"),
        F.try_divide((F.col("office") + F.col("plan")).cast("double"), F.col("private") + F.col("public") + F.col("self_employed")).alias("d3"),
        *(["office_slugs"] if slugs else []),
    )


def ranked(data: DataFrame, value: str, tie: str) -> DataFrame:
    """``rank`` 1..n by falling value, ties by ``tie``, without a one-task sort: range partitions, their sizes, positions.

    The partitioned rows are written first: another run of the plan may draw other bounds.
    """
    order = data.repartitionByRange(F.desc(value), F.col(tie)).sortWithinPartitions(F.desc(value), tie)
    placed = written(order.withColumn("__at", F.monotonically_increasing_id()), f"{shared_dir(data.sparkSession, 'ranks')}/rows")
    part, nth = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))  # a row for each partition
    base = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__base"))
    return placed.withColumn("__part", part).join(F.broadcast(base), "__part").withColumn("rank", F.col("__base") + nth + 1).drop("__at", "__part", "__base")


def quintile_colours(data: DataFrame, value: str, colours: Sequence[str]) -> DataFrame:
    """``bucket`` and ``colour``: the first of the quantiles 1/n, 2/n, ... that is at least the value."""
    n = len(colours)
    cuts = exact_quantiles(data, F.col(value), [k / n for k in range(1, n + 1)])
    if cuts is None:
        return data.withColumn("bucket", F.lit(None).cast("int")).withColumn("colour", F.lit(None).cast("string"))
    ladder = F.lit(n - 1)
    for k in range(n - 2, -1, -1):
        ladder = F.when(F.col(value) <= cuts[k], F.lit(k)).otherwise(ladder)
    out = data.withColumn("bucket", F.when(F.col(value).isNotNull(), ladder))
    return out.withColumn("colour", F.when(F.col("bucket").isNotNull(), F.get(F.array(*map(F.lit, colours)), F.col("bucket"))))
