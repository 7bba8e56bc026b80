"""Wide to long and back, regrouping by weights, shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import Dataset, PipelineStep, need
from ..functions.numbers import to_number

# Territories before the reform and those they are counted in now, with their codes.
SARDINIA = {
    "Cagliari": ("Cagliari", "092"),
    "Carbonia -Iglesias": ("Sud Sardegna", "111"),
    "Carbonia-Iglesias": ("Sud Sardegna", "111"),
    "Medio Campidano": ("Sud Sardegna", "111"),
    "Nuoro": ("Nuoro", "091"),
    "Ogliastra": ("Nuoro", "091"),
    "Olbia -Tempio": ("Sassari", "090"),
    "Olbia-Tempio": ("Sassari", "090"),
    "Oristano": ("Oristano", "095"),
    "Sassari": ("Sassari", "090"),
}
# Income kinds, their columns of counts and of amounts.
INCOME_COLUMNS = {
    "v2": ("Reddito da lavoro dipendente e assimilati - Frequenza", "Reddito da lavoro dipendente e assimilati - Ammontare in euro"),
    "v4": ("Reddito da lavoro autonomo (comprensivo dei valori nulli) - Frequenza", "Reddito da lavoro autonomo (comprensivo dei valori nulli) - Ammontare in euro"),
    "v5": (
        "Reddito di spettanza dell'imprenditore in contabilita' ordinaria  (comprensivo dei valori nulli) - Frequenza",
        "Reddito di spettanza dell'imprenditore in contabilita' ordinaria  (comprensivo dei valori nulli) - Ammontare in euro",
    ),
    "v6": (
        "Reddito di spettanza dell'imprenditore in contabilita' semplificata (comprensivo dei valori nulli) - Frequenza",
        "Reddito di spettanza dell'imprenditore in contabilita' semplificata (comprensivo dei valori nulli) - Ammontare in euro",
    ),
    "v7": ("Reddito da partecipazione  (comprensivo dei valori nulli) - Frequenza", "Reddito da partecipazione  (comprensivo dei valori nulli) - Ammontare in euro"),
}
# Regimes and the start years they hold for, inclusive.
REGIMES = {"retributivo": (1900, 1995), "misto-dini": (1996, 2011), "misto-fornero": (2012, 2025), "contributivo-puro": (9999, 9999)}


def unpivot(data: DataFrame, keep: Sequence[str], groups: Mapping[str, Mapping[str, Column]], label: str) -> DataFrame:
    """One row for each row and group: ``keep``, the group's name as ``label``, and its named values. One pass, no shuffle."""
    items = [F.struct(F.lit(g).alias(label), *[v.alias(n) for n, v in values.items()]) for g, values in groups.items()]
    return data.select(*keep, F.explode(F.array(*items)).alias("__g")).select(*keep, "__g.*")


class PairedUnpivot(PipelineStep):
    """Several columns for each group become one column each: ``groups`` maps a group to {new column: old column}."""

    def __init__(self, groups: Mapping[str, Mapping[str, str]], keep: Sequence[str], label: str, skip_missing: bool = False):
        super().__init__()
        self.groups, self.keep, self.label, self.skip_missing = groups, list(keep), label, skip_missing

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [*self.keep, *(c for g in self.groups.values() for c in g.values())])
        out = unpivot(d, self.keep, {g: {n: d[c] for n, c in m.items()} for g, m in self.groups.items()}, self.label)
        if self.skip_missing:
            out = out.where(F.coalesce(*[F.col(n) for n in next(iter(self.groups.values()))]).isNotNull())
        return self.done(dataset, out, {"groups": list(self.groups), "keep": self.keep}, lambda: {"rows": out.count()})


class UnpivotPensionsInForce(PairedUnpivot):
    """``n_<m>``, ``media_<m>`` and ``annuo_<m>`` of each management m, one row each."""

    def __init__(self, managements: Sequence[str], province_column: str = "provincia", names: Sequence[str] = ("numero", "medio", "annuo")):
        super().__init__({m: dict(zip(names, (f"n_{m}", f"media_{m}", f"annuo_{m}"), strict=True)) for m in managements}, [province_column], "gestione")


class UnpivotMeasures(PipelineStep):
    """Counts and means of each group become three long measures: count, mean and count x mean x months.

    ``groups`` maps a label to (count column, mean column). Rows whose count and mean are both
    missing stay unless ``skip_missing``. The third measure is null if either is, and marked estimated.
    """

    MEASURES = ("count", "mean", "annual")

    def __init__(self, groups: Mapping[str, tuple[str, str]], measure_uris: Mapping[str, str], keep: Sequence[str], label: str, months: int = 13, skip_missing: bool = False, label_type: str = "string"):
        super().__init__()
        if months <= 0:
            raise ValueError("months must be positive")
        self.groups, self.uris, self.keep, self.label, self.months = dict(groups), dict(measure_uris), list(keep), label, months
        self.skip_missing, self.label_type = skip_missing, label_type

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [*self.keep, *(c for pair in self.groups.values() for c in pair)])
        pairs = unpivot(d, self.keep, {str(g): {"__n": d[n].cast("double"), "__m": d[m].cast("double")} for g, (n, m) in self.groups.items()}, self.label)
        pairs = pairs.withColumn(self.label, F.col(self.label).cast(self.label_type))
        some = pairs.where(F.col("__n").isNotNull() | F.col("__m").isNotNull()) if self.skip_missing else pairs
        values = (("count", F.col("__n"), False), ("mean", F.col("__m"), False), ("annual", F.col("__n") * F.col("__m") * self.months, True))
        items = [F.struct(F.lit(self.uris[k]).alias("measure_type"), v.alias("value"), F.lit(e).alias("is_estimated")) for k, v, e in values]
        out = some.select(*self.keep, self.label, F.explode(F.array(*items)).alias("x")).select(*self.keep, self.label, "x.*")
        return self.done(dataset, out, {"groups": list(self.groups), "months": self.months}, lambda: {"rows": out.count(), "rows_skipped_all_nan": 3 * (pairs.count() - some.count()) if self.skip_missing else 0})


class UnpivotRegimes(UnpivotMeasures):
    """Offices by regime: ``n_<r>`` and ``media_<r>``."""

    def __init__(self, regimes: Sequence[str], measure_uris: Mapping[str, str], office_column: str = "sede", months: int = 13):
        super().__init__({r: (f"n_{r}", f"media_{r}") for r in regimes}, measure_uris, [office_column], "regime", months)


class UnpivotYears(UnpivotMeasures):
    """Offices by year: ``n_<y>`` and ``media_<y>``; years with neither are left out."""

    def __init__(self, measure_uris: Mapping[str, str], office_column: str = "sede", years: Sequence[int] | None = None, months: int = 13):
        years = range(1998, 2027) if years is None else years
        super().__init__({str(y): (f"n_{y}", f"media_{y}") for y in years}, measure_uris, [office_column], "anno", months, skip_missing=True, label_type="int")


class WeightedRegroup(PipelineStep):
    """Merge the rows of some groups into one row for each new group; other rows pass through.

    Sums count missing values as 0; means are weighted by the pair's count column over rows where
    both are there and the weight is positive, else null; other columns come from the member that is
    first by ``order_by``.
    """

    def __init__(self, group_column: str, mapping: Mapping[str, str], count_columns: Sequence[str] = (), weight_pairs: Mapping[str, str] | None = None, sum_columns: Sequence[str] = (), order_by: Sequence[str] | None = None):
        super().__init__()
        self.group_column, self.mapping = group_column, dict(mapping)
        self.sums, self.pairs, self.order_by = [*count_columns, *sum_columns], dict(weight_pairs or {}), list(order_by or [group_column])

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [self.group_column, *self.sums, *self.pairs, *self.pairs.values(), *self.order_by])
        names = F.create_map(*[F.lit(x) for pair in self.mapping.items() for x in pair])
        member = d[self.group_column].isin(*self.mapping)
        inside = d.where(member).withColumn("__to", names[d[self.group_column]])
        kinds, aggs = dict(d.dtypes), []
        first = F.struct(*[F.col(c) for c in self.order_by], *[F.col(c).cast("string").alias(f"__{k}") for k, c in enumerate(d.columns)])
        for c in d.columns:
            if c == self.group_column:
                continue
            if c in self.sums:
                value = F.coalesce(F.sum(F.col(c)), F.lit(0)).cast(kinds[c])
            elif c in self.pairs:
                w = self.pairs[c]
                ok = F.col(c).isNotNull() & (F.col(w) > 0)
                value = F.try_divide(F.sum(F.when(ok, F.col(c) * F.col(w))), F.sum(F.when(ok, F.col(w)))).cast(kinds[c])
            else:
                value = F.min_by(F.col(c), first)
            aggs.append(value.alias(c))
        merged = inside.groupBy("__to").agg(*aggs) if aggs else inside.select("__to").distinct()
        merged = merged.withColumnRenamed("__to", self.group_column).select(*d.columns)
        out = d.where(~member | d[self.group_column].isNull()).unionByName(merged)
        return self.done(dataset, out, {"groups": sorted(set(self.mapping.values()))}, lambda: {"rows_in": d.count(), "rows_out": out.count()})


class AggregateSardiniaProvinces(WeightedRegroup):
    def __init__(self, province_column: str, count_columns: Sequence[str], weight_pairs: Mapping[str, str], sum_columns: Sequence[str] = (), mode: str = "snapshot"):
        if mode != "snapshot":
            raise ValueError(f"unknown mode {mode!r}")
        super().__init__(province_column, {k: name for k, (name, _) in SARDINIA.items()}, count_columns, weight_pairs, sum_columns)


class AggregateUnpivot(PipelineStep):
    """Sum pairs of columns by code, then one row for each code and kind: (code, kind, uri, freq, amount).

    Rows with the sentinel code or none are dropped; text that is no number counts as 0.
    """

    def __init__(self, code_column: str, kinds: Mapping[str, tuple[str, str]], uris: Mapping[str, str], sentinel: str = "0"):
        super().__init__()
        self.code_column, self.kinds, self.uris, self.sentinel = code_column, dict(kinds), dict(uris), sentinel

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [self.code_column, *(c for pair in self.kinds.values() for c in pair)])
        kept = d.where(d[self.code_column].isNotNull() & (d[self.code_column] != self.sentinel))
        whole = lambda c: F.coalesce(to_number(d[c]).cast("bigint"), F.lit(0))
        sums = kept.groupBy(d[self.code_column].alias("code")).agg(*[F.sum(whole(c)).alias(f"__{k}{j}") for k, pair in self.kinds.items() for j, c in enumerate(pair)])
        out = unpivot(sums, ["code"], {k: {"uri": F.lit(self.uris[k]), "freq": F.col(f"__{k}0"), "amount": F.col(f"__{k}1")} for k in self.kinds}, "kind")
        return self.done(dataset, out, {"kinds": list(self.kinds)}, lambda: {"rows": out.count()})


class AggregateIncomesByProvince(AggregateUnpivot):
    def __init__(self, uris: Mapping[str, str], code_column: str = "Sigla Provincia", sentinel: str = "0", columns: Mapping[str, tuple[str, str]] | None = None):
        super().__init__(code_column, columns or INCOME_COLUMNS, uris, sentinel)


def bucket_share(data: DataFrame, year: str, count: str, ranges: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """(bucket, total, share): counts by inclusive year range, the first that fits; years outside all are left out; shares are 0 without counts."""
    ranges = ranges or REGIMES
    names = list(ranges)
    ladder = F.lit(None).cast("string")
    for name in reversed(names):
        lo, hi = ranges[name]
        ladder = F.when(F.col(year).between(lo, hi), F.lit(name)).otherwise(ladder)
    sums = [F.coalesce(F.sum(F.when(ladder == n, F.col(count))), F.lit(0)).cast("double").alias(f"b{k}") for k, n in enumerate(names)]
    one = data.agg(*sums)  # one row: as many sums as ranges
    total = sum((F.col(f"b{k}") for k in range(1, len(names))), F.col("b0"))
    items = [F.struct(F.lit(n).alias("bucket"), F.col(f"b{k}").alias("total"), F.coalesce(F.try_divide(F.col(f"b{k}"), total), F.lit(0.0)).alias("share")) for k, n in enumerate(names)]
    return one.select(F.explode(F.array(*items)).alias("x")).select("x.*")


class ProjectShares(PipelineStep):
    """Split a count by the shares of ``composition`` (bucket, share): a row for each bucket (long) or a column (wide)."""

    def __init__(self, count_column: str, composition: DataFrame, shape: str = "long", keep_extra_columns: bool = True, key_columns: Sequence[str] = ()):
        super().__init__()
        if shape not in ("long", "wide"):
            raise ValueError("shape must be long or wide")
        self.count_column, self.composition, self.shape, self.keep_extra, self.keys = count_column, composition, shape, keep_extra_columns, list(key_columns)

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [self.count_column, *self.keys])
        keep = d.columns if self.keep_extra else [*self.keys, self.count_column]
        shares = {r.bucket: r.share for r in self.composition.collect()}  # as many rows as ranges
        parts = {b: d[self.count_column].cast("double") * F.lit(float(s)) for b, s in shares.items()}
        if self.shape == "wide":
            out = d.select(*keep, *[v.alias(f"projected_{b}") for b, v in parts.items()], F.lit("E").alias("_status"))
        else:
            out = unpivot(d, keep, {b: {"projected": v} for b, v in parts.items()}, "regime_notation").withColumn("_status", F.lit("E"))
        return self.done(dataset, out, {"shape": self.shape}, {"shares": shares})


class ProjectRegimes(ProjectShares):
    """The shares come from a file of counts by start year; FileNotFoundError if it is absent."""

    def __init__(self, count_column: str, spark, path: str, shape: str = "long", ranges: Mapping[str, tuple[int, int]] | None = None, keep_extra_columns: bool = True, key_columns: Sequence[str] = ()):
        from ..sources.olap import read_start_years

        try:
            spark.read.text(path)
        except AnalysisException as error:
            raise FileNotFoundError(path) from error
        composition = bucket_share(read_start_years(spark, path), "anno_decorrenza", "numero_pensioni", ranges)
        super().__init__(count_column, composition, shape, keep_extra_columns, key_columns)


def pivot_mean(data: DataFrame, index: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Long to wide with the mean of repeated cells; the labels are given, so no job looks for them."""
    return data.groupBy(*index).pivot(label, list(labels)).agg(F.avg(value))
