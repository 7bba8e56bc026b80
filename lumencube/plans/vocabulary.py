"""Names of the cubes' properties and codes under one configurable namespace."""

from __future__ import annotations

from dataclasses import dataclass

from ..operators.link import PROVINCES


@dataclass(frozen=True)
class Vocabulary:
    base: str = "https://example.org/cubes/"

    def __call__(self, name: str) -> str:
        return self.base + name

    def province(self, code: str) -> str:
        return PROVINCES + code

    def property(self, role: str) -> str:
        """The dimension, measure or attribute of a role, as DIMENSIONS, MEASURES and ATTRIBUTES name it; KeyError if none has it."""
        return self(PROPERTIES[role])

    def cube(self, name: str) -> str:
        """The node of a cube in CUBES."""
        if name not in CUBES:
            raise KeyError(name)
        return self(name)

    def structure(self, name: str) -> str:
        """The structure definition of a cube in CUBES."""
        if name not in CUBES:
            raise KeyError(name)
        return self(f"dsd-{name}")

    def concepts(self, role: str) -> dict[str, str]:
        """Code to IRI of the list that a coded dimension takes its values from; KeyError if it has none."""
        prefix, names = LISTS[role]
        return {code: self(prefix + name) for code, name in names.items()}


# Short codes of managements, regimes, kinds, and the local names of their concepts.
MANAGEMENTS = {"PRIV": "gestione-privati", "PUB": "gestione-pubblici", "AUTO": "gestione-autonomi", "ASS": "gestione-assistenziali", "TOT": "gestione-totale"}
REGIMES = {"RETR": "retributivo", "DINI": "misto-dini", "FORNERO": "misto-fornero", "CONTR": "contributivo-puro"}
MACRO_AREAS = {"C": "Nord-Ovest", "D": "Nord-Est", "H": "Nord-Est", "E": "Centro", "I": "Centro", "F": "Sud", "G": "Isole"}
MACRO_BY_OFFICE = {"barletta-andria-trani": "Sud", "fermo": "Centro", "monza-e-della-brianza": "Nord-Ovest", "cagliari-e-sud-sardegna": "Isole"}
SARDINIAN_OFFICES = ("cagliari", "cagliari-e-sud-sardegna", "nuoro", "oristano", "sassari")
# Local names of the cubes' properties by role, the cubes, the components of the index.
DIMENSIONS = {"province": "provincia", "office": "sede", "area": "area", "year": "annoRiferimento", "start year": "annoDecorrenza", "management": "tipoGestione", "regime": "regimeLiquidazione", "indicator": "indicatore", "income kind": "tipoReddito", "component": "componente"}
MEASURES = {"pensions": "numeroPensioni", "mean amount": "importoMedioMensile", "annual amount": "importoAnnuoComplessivo", "start age": "etaMediaDecorrenza", "employed": "numeroOccupati", "indicator value": "valoreIndicatore", "taxpayers": "numeroContribuenti", "income": "ammontareReddito", "index value": "valoreIndice"}
ATTRIBUTES = {"raw value": "valoreGrezzo"}
PROPERTIES = DIMENSIONS | MEASURES | ATTRIBUTES
CUBES = ("pensions-by-residence", "regime-by-office", "series-by-office", "public-start-years", "employment", "demography", "incomes", "composite-index", "projected-regimes")
COMPONENTS = {"d1": "d1", "d2": "d2", "d3": "d3", "aggregate": "aggregate"}
AREA_ITALY = "area-italia"
#: For each coded dimension, what its concepts' local names begin with, and code to the rest of the name.
LISTS = {"management": ("", MANAGEMENTS), "regime": ("regime-", REGIMES), "component": ("componente-", COMPONENTS)}
