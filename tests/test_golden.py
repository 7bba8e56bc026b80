"""Figures that were published for the public pensions by start year, computed again from the counts and mean ages."""

import pytest

from lumencube.core import Dataset
from lumencube.operators.reshape import ProjectRegimes, bucket_share
from lumencube.plans.cube_queries import age_by_decade
from lumencube.sources.olap import read_start_years

# Pensions and mean age at the start, by start year; the first year stands for all before it too.
START_YEARS = {
    1980: (28055, "38,07"), 1981: (9981, "42,65"), 1982: (18116, "41,95"), 1983: (20244, "42,85"), 1984: (16022, "43,92"), 1985: (15014, "44,47"),
    1986: (15015, "44,74"), 1987: (15276, "45,23"), 1988: (20489, "45,86"), 1989: (29843, "46,44"), 1990: (26883, "48,05"), 1991: (40772, "48,39"),
    1992: (55284, "49,34"), 1993: (24053, "51,30"), 1994: (80898, "51,22"), 1995: (23231, "54,12"), 1996: (59907, "54,60"), 1997: (81473, "53,01"),
    1998: (40675, "56,33"), 1999: (49413, "55,88"), 2000: (48449, "56,76"), 2001: (41161, "57,55"), 2002: (43972, "57,79"), 2003: (52765, "58,29"),
    2004: (53384, "58,76"), 2005: (55531, "59,59"), 2006: (83590, "59,38"), 2007: (105418, "59,73"), 2008: (77292, "60,01"), 2009: (91585, "60,82"),
    2010: (98774, "61,04"), 2011: (102107, "61,29"), 2012: (95524, "61,61"), 2013: (63824, "62,24"), 2014: (76858, "62,84"), 2015: (107429, "62,59"),
    2016: (92758, "62,98"), 2017: (105547, "63,88"), 2018: (136211, "64,33"), 2019: (144881, "64,70"), 2020: (159109, "65,11"), 2021: (157347, "65,18"),
    2022: (141183, "65,71"), 2023: (127008, "66,23"), 2024: (125775, "66,71"), 2025: (113139, "66,86"),
}


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    place = tmp_path_factory.mktemp("golden") / "years.csv"
    number = lambda n: f"{n:,}".replace(",", ".")
    lines = ['"A title"', '"Anno di decorrenza";"";"Numero Pensioni "']
    lines += [f'"{"Decorrenza anteriore al 31/12/1980" if y == 1980 else y}";"";"{number(n)} ";"{age} ";"1.551,72 ";"853,74 ";"80,00 "' for y, (n, age) in START_YEARS.items()]
    place.write_text("\n".join([*lines, f'"Totale";"";"{number(sum(n for n, _ in START_YEARS.values()))} ";"59,00 ";"1,00 ";"1,00 ";"1,00 "']))
    return str(place)


def test_national_composition(spark, path):
    years = read_start_years(spark, path)
    assert years.count() == 46
    shares = {r.bucket: r for r in bucket_share(years, "anno_decorrenza", "numero_pensioni").collect()}
    assert sum(r.total for r in shares.values()) == 3_171_265
    assert {k: round(100 * r.share, 2) for k, r in shares.items()} == {"retributivo": 13.85, "misto-dini": 34.23, "misto-fornero": 51.92, "contributivo-puro": 0.0}


def test_projection_conserves_the_total(spark, path):
    data = Dataset(spark.createDataFrame([("001", 3_159_266), ("002", 0)], "codice_istat string, n_pubblici long"))
    done = ProjectRegimes("n_pubblici", spark, path).apply(data).data
    assert done.count() == 8 and round(done.agg({"projected": "sum"}).first()[0]) == 3_159_266
    assert {r.regime_notation: round(r.projected) for r in done.where("codice_istat = '001'").collect()}["retributivo"] == round(3_159_266 * 439176 / 3_171_265)


def test_mean_age_by_decade(spark, path):
    years = read_start_years(spark, path).selectExpr("anno_decorrenza as year", "numero_pensioni as count", "eta_decorrenza as age")
    got = {r.decade: (r.mean_age, r.pensions) for r in age_by_decade(years).collect()}
    assert got == {1980: (43.5020, 188055), 1990: (52.3622, 482589), 2000: (59.1754, 653147), 2010: (62.9147, 1023913), 2020: (65.8837, 823561)}
