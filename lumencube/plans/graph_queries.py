"""The demonstration queries as graph-query texts over the cubes' triples.

``texts(vocabulary)`` gives each by name; run one with ``Engine(triples).query(text)``. They say the same as
the plans over typed tables in ``cube_queries``.
"""

from __future__ import annotations

from ..operators.link import CLV, PROVINCES, SKOS
from ..operators.observations import QB, STATUS, STATUS_CODE
from .vocabulary import Vocabulary

_PREFIXES = f"PREFIX qb: <{QB}> PREFIX skos: <{SKOS}> PREFIX clv: <{CLV}> PREFIX prov: <{PROVINCES}> PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> "

# The fourteen metropolitan provinces' codes.
METROPOLITAN = ("001", "010", "015", "027", "037", "048", "058", "063", "072", "080", "082", "083", "087", "092")


def _ranking(order: str) -> str:
    return f"""SELECT ?code ?name ?value WHERE {{
      ?o c:componente c:componente-aggregate ; c:provincia ?p ; c:valoreIndice ?value .
      ?p skos:prefLabel ?name ; skos:notation ?code . FILTER(LANG(?name) = "it")
    }} ORDER BY {order}(?value) ?code LIMIT 10"""


def texts(v: Vocabulary | None = None, region: str = "", province: str = "082", offices: tuple[str, ...] = ("torino", "milano", "roma", "napoli", "palermo")) -> dict[str, str]:
    v = v or Vocabulary()
    cities = " ".join(f"prov:{c}" for c in METROPOLITAN)
    named = " ".join(f"c:sede-{o}" for o in offices)
    body = {
        "top10": _ranking("DESC"),
        "bottom10": _ranking("ASC"),
        "breakdown": f"""SELECT ?component ?value ?raw WHERE {{
          ?o c:provincia prov:{province} ; c:componente ?component ; c:valoreIndice ?value . OPTIONAL {{ ?o c:valoreGrezzo ?raw }} }} ORDER BY ?component""",
        "managements_of_region": f"""SELECT ?name ?management ?n ?mean WHERE {{
          ?o qb:dataSet c:pensions-by-residence ; c:provincia ?p ; c:tipoGestione ?management ; c:numeroPensioni ?n ; c:importoMedioMensile ?mean .
          ?p clv:situatedWithin <{region}> ; skos:prefLabel ?name . FILTER(LANG(?name) = "it") FILTER(?management != c:gestione-totale) }} ORDER BY ?name ?management""",
        "growth": f"""SELECT ?office ?before ?after ((?after - ?before) * 100 / ?before AS ?growth) WHERE {{
          VALUES ?office {{ {named} }}
          ?a c:sede ?office ; c:annoRiferimento ?y1 ; c:numeroPensioni ?before . FILTER(STR(?y1) = "1998")
          ?b c:sede ?office ; c:annoRiferimento ?y2 ; c:numeroPensioni ?after . FILTER(STR(?y2) = "2026") }}""",
        "estimated": f"""SELECT ?dataset (COUNT(?o) AS ?n) WHERE {{ ?o qb:dataSet ?dataset ; <{STATUS}> <{STATUS_CODE}E> }} GROUP BY ?dataset ORDER BY ?dataset""",
        "pensions_by_income": f"""SELECT ?p ?annual (SUM(?amount) AS ?income) (?annual * 100000000 / SUM(?amount) AS ?pct) WHERE {{
          VALUES ?p {{ {cities} }}
          ?o qb:dataSet c:pensions-by-residence ; c:provincia ?p ; c:tipoGestione c:gestione-totale ; c:importoAnnuoComplessivo ?annual .
          ?i qb:dataSet c:incomes ; c:provincia ?p ; c:ammontareReddito ?amount . }} GROUP BY ?p ?annual ORDER BY DESC(?pct)""",
        "identity": f"""SELECT ?kind ?value WHERE {{
          {{ ?o qb:dataSet c:composite-index ; c:provincia prov:{province} ; c:componente c:componente-aggregate ; c:valoreIndice ?value . BIND("index" AS ?kind) }}
          UNION {{ ?o qb:dataSet c:composite-index ; c:provincia prov:{province} ; c:componente c:componente-d1 ; c:valoreGrezzo ?value . BIND("d1" AS ?kind) }}
          UNION {{ ?o qb:dataSet c:composite-index ; c:provincia prov:{province} ; c:componente c:componente-d2 ; c:valoreGrezzo ?value . BIND("d2" AS ?kind) }}
          UNION {{ ?o qb:dataSet c:composite-index ; c:provincia prov:{province} ; c:componente c:componente-d3 ; c:valoreGrezzo ?value . BIND("d3" AS ?kind) }}
          UNION {{ ?o qb:dataSet c:pensions-by-residence ; c:provincia prov:{province} ; c:tipoGestione c:gestione-totale ; c:numeroPensioni ?value . BIND("pensions" AS ?kind) }}
          UNION {{ ?o qb:dataSet c:employment ; c:provincia prov:{province} ; c:numeroOccupati ?value . BIND("employed" AS ?kind) }}
          UNION {{ {{ SELECT (SUM(?a) AS ?value) WHERE {{ ?o qb:dataSet c:incomes ; c:provincia prov:{province} ; c:ammontareReddito ?a }} }} BIND("income" AS ?kind) }} }}""",
        "retributive_by_region": """SELECT ?region (SUM(?r) AS ?retributive) (SUM(?n) AS ?total) (SUM(?r) / SUM(?n) AS ?share) WHERE {
          ?o qb:dataSet c:regime-by-office ; c:sede ?office ; c:regimeLiquidazione ?regime ; c:numeroPensioni ?n .
          ?office c:correspondsToProvince ?p . ?p clv:situatedWithin ?region .
          BIND(IF(?regime = c:regime-retributivo, ?n, 0) AS ?r) } GROUP BY ?region ORDER BY DESC(?share)""",
        "age_by_decade": """SELECT ?decade (SUM(?age * ?n) / SUM(?n) AS ?mean) (SUM(?n) AS ?pensions) WHERE {
          ?o c:annoDecorrenza ?y ; c:etaMediaDecorrenza ?age ; c:numeroPensioni ?n .
          BIND(FLOOR(xsd:integer(?y) / 10) * 10 AS ?decade) FILTER(?n > 0) } GROUP BY ?decade ORDER BY ?decade""",
        "expected_duration": """SELECT ?p (?life + 65 - ?age AS ?years) WHERE {
          { SELECT (SUM(?a * ?n) / SUM(?n) AS ?age) WHERE { ?o c:annoDecorrenza ?y ; c:etaMediaDecorrenza ?a ; c:numeroPensioni ?n } }
          ?d qb:dataSet c:demography ; c:provincia ?p ; c:indicatore c:indicatore-speranza-vita-65 ; c:valoreIndicatore ?life . } ORDER BY DESC(?years)""",
        "derived_from": """SELECT ?o ?source WHERE { ?o <http://www.w3.org/ns/prov#wasDerivedFrom>+ ?source }""",
    }
    return {name: f"{_PREFIXES}PREFIX c: <{v.base}> {text}" for name, text in body.items()}
