"""Recipes as a user would write them: customers, municipalities and an enrichment by two joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..core import Dataset, Pipeline, Recipe
from ..operators.columns import AddNormalizedKey, DropColumns, DropEmptyColumns, FillMissing, NormalizeColumnNames, ParseDates, ParseItalianNumbersAuto, RenameColumns, StripStringColumns
from ..operators.rows import DropDuplicateRows, FilterRows, KeepFirst, LeftJoinEnrich


@dataclass
class CustomersRecipe(Recipe):
    """Clean a customer table; whether rows are made unique is a parameter."""

    fill_age_strategy: str = "median"
    drop_duplicates: bool = True

    def build(self) -> Pipeline:
        steps = Pipeline([NormalizeColumnNames(), DropEmptyColumns(), StripStringColumns()], on_error="raise")
        if self.drop_duplicates:
            steps.add(DropDuplicateRows())
        return steps.add(FillMissing("age", self.fill_age_strategy))


@dataclass
class MunicipalitiesRecipe(Recipe):
    """Municipalities that still exist (no end date, or 9999-12-31), one for each name and province."""

    name: str = "name"
    province: str = "province"
    end_date: str = "end_date"

    def build(self) -> Pipeline:
        active = FilterRows(lambda d: d[self.end_date].isNull() | (F.year(d[self.end_date]) == 9999))
        return Pipeline([ParseDates(self.end_date, "%Y-%m-%d", errors="coerce"), active, AddNormalizedKey(self.name, "name_key"), KeepFirst(["name_key", self.province], [self.name])], on_error="raise")


@dataclass
class ProvincesRecipe(Recipe):
    """Provinces with clean names and a key."""

    renames: dict[str, str]
    name: str = "province_name"

    def build(self) -> Pipeline:
        return Pipeline([NormalizeColumnNames(), RenameColumns(self.renames), AddNormalizedKey(self.name, "province_key")], on_error="raise")


@dataclass
class EnrichmentRecipe(Recipe):
    """Local numbers parsed, the province by name, then the municipality by name and province; helpers dropped."""

    provinces: Dataset
    municipalities: Dataset
    name: str = "comune"
    province: str = "provincia"

    def build(self) -> Pipeline:
        return Pipeline(
            [
                ParseItalianNumbersAuto(),
                AddNormalizedKey(self.province, "province_key"),
                AddNormalizedKey(self.name, "name_key"),
                LeftJoinEnrich(self.provinces, "province_key", columns=["acronym"]),
                LeftJoinEnrich(self.municipalities, ["name_key", "acronym"], ["name_key", "province"], ["municipality_id"]),
                DropColumns(["province_key", "name_key"]),
            ],
            on_error="raise",
        )
