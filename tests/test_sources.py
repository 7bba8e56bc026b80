import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset
from lumencube.operators.columns import DropColumns
from lumencube.sources.olap import read_export, read_start_years
from lumencube.sources.remote import fetch_if_absent, read_endpoint
from lumencube.sources.sinks import GraphStore, rewrite_namespace, save_dataset, write_triples
from lumencube.sources.tabular import read_csv, read_geojson, read_quoted_csv
from lumencube.sources.turtle import XSD, parse, read_turtle


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_csv(spark, tmp_path):
    place = write(tmp_path / "a.csv", "﻿id,name,x,ok\n1,NA,1.5,True\n2,,nan,False\n3,\"a, b\",2,\n")
    d = Dataset.from_csv(place, spark, encoding="utf-8-sig")
    assert dict(d.data.dtypes) == {"id": "bigint", "name": "string", "x": "double", "ok": "boolean"}
    assert sorted(map(tuple, d.data.collect())) == [(1, None, 1.5, True), (2, None, None, False), (3, "a, b", 2.0, None)]
    text = read_csv(spark, place, encoding="utf-8-sig", infer=False, keep_default_na=False)
    assert {(r.id, r.name, r.x) for r in text.collect()} == {("1", "NA", "1.5"), ("2", "", "nan"), ("3", "a, b", "2")}
    semi = write(tmp_path / "b.csv", "a;b\n007;1,5\n")
    assert tuple(read_csv(spark, semi, sep=";", infer=False).first()) == ("007", "1,5")
    quoted = write(tmp_path / "c.csv", "REF,Nome,V\n'ITC11','Torino, TO',1.5\n")
    assert tuple(read_quoted_csv(spark, quoted, "REF string, Nome string, V double").first()) == ("ITC11", "Torino, TO", 1.5)


def test_parquet_nan_is_null(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(str(tmp_path / "p"))
    assert Dataset.from_parquet(str(tmp_path / "p"), spark).data.where("x is null").count() == 1


def test_exports(spark, tmp_path):
    head = 'title\n\n"a";"b"\n"Provincia di residenza";"";"n";"m"\n'
    place = write(tmp_path / "e.csv", head + '"Torino ";"";"1.000";"- "\n"Europa";"";"5";"6"\n"Totale";"";"1";"2"\n"x";"y"\n')
    got = read_export(spark, place, ["p", "blank", "n", "m"], drop=("Totale", "Provincia di residenza", "Europa"))
    assert [tuple(r) for r in got.collect()] == [("Torino", "", "1.000", "-")]
    years = write(tmp_path / "y.csv", 'title\n"Anno";"";"n";"eta";"m";"md";"e"\n"Anteriore al 31/12/1980";"";"10";"43,5";"1.000,5";"2";"80"\n"1996";"";"20";"50";"1";"2";"70"\n"Totale";"";"30";"1";"1";"1";"1"\n"1997";"";"-";"1";"1";"1";"1"\n')
    got = read_start_years(spark, years).orderBy("anno_decorrenza").collect()
    assert [(r.anno_decorrenza, r.numero_pensioni, r.eta_decorrenza) for r in got] == [(1980, 10, 43.5), (1996, 20, 50.0)]
    assert got[0].importo_medio == 1000.5


TURTLE = """@prefix ex: <http://ex/> . # comment
PREFIX xsd: <http://www.w3.org/2001/XMLSchema#>
@base <http://base/> .
ex:a a ex:Thing , ex:Other ;
    ex:n 5 ; ex:d -1.5 ; ex:e 1e3 ; ex:ok true ;
    ex:year "2026"^^xsd:gYear ; ex:label "ciao \\"x\\" \\u00e8"@it-x-own ;
    ex:part [ ex:name '''two
lines''' ; ] ;
    ex:list ( 1 ex:b ) ; .
<rel> ex:to _:z . _:z ex:to ex:a.
"""


def test_turtle(spark, tmp_path):
    rows = list(parse(TURTLE))
    find = {(s, p.rsplit("/", 1)[-1]): (o, kind, dt, lang) for s, p, o, kind, dt, lang in rows}
    assert find["http://ex/a", "n"] == ("5", "literal", XSD + "integer", None)
    assert find["http://ex/a", "d"] == ("-1.5", "literal", XSD + "decimal", None) and find["http://ex/a", "e"][2] == XSD + "double"
    assert find["http://ex/a", "label"] == ('ciao "x" è', "literal", None, "it-x-own") and find["http://ex/a", "year"][2] == XSD + "gYear"
    assert find["http://base/rel", "to"][1] == "bnode" and len(rows) == 17
    for bad in ("ex:a ex:b ex:c .", "<a> <b> .", "<a> <b> <c>"):
        with pytest.raises(ValueError):
            list(parse(bad))
    a, b = write(tmp_path / "a.ttl", TURTLE), write(tmp_path / "b.ttl", "<http://ex/a> a <http://ex/Thing> .")
    got = read_turtle(spark, a, b)
    assert got.count() == 17 and read_turtle(spark, str(tmp_path)).count() == 17
    write_triples(got, str(tmp_path / "nt"))
    back = list(parse("\n".join(r.value for r in spark.read.text(str(tmp_path / "nt")).collect())))
    assert {(p, o, dt) for _, p, o, kind, dt, _ in back if kind == "literal"} == {(r.p, r.o, r.datatype) for r in got.where("o_kind = 'literal'").collect()}


def test_save_and_history(spark, tmp_path):
    d = DropColumns(["c"]).apply(Dataset(spark.createDataFrame([(1, "x", 0), (2, None, 0), (3, "z", 0)], "a bigint, b string, c int")))
    for suffix in ("csv", "parquet", "json"):
        place = save_dataset(d, str(tmp_path / "sub" / f"o.{suffix}"), save_history=True)
        back = {"csv": lambda p: spark.read.csv(p, header=True), "parquet": spark.read.parquet, "json": spark.read.json}[suffix](place)
        assert back.count() == 3
        single = save_dataset(d, str(tmp_path / f"one.{suffix}"), single_file=True)
        assert (tmp_path / f"one.{suffix}").is_file() and single.endswith(suffix)
    assert json.loads((tmp_path / "one.json").read_text())[1] == {"a": 2, "b": None}
    side = json.loads((tmp_path / "sub" / "o.history.json").read_text())
    assert (side["rows"], side["cols"], side["columns"], side["data_file"]) == (3, 2, ["a", "b"], "o.json") and side["steps"][0]["name"] == "DropColumns"
    for bad in ("noext", "x.xml"):
        with pytest.raises(ValueError):
            save_dataset(d, str(tmp_path / bad))


def test_graph_store_and_namespace(spark, tmp_path):
    rows = lambda *xs: spark.createDataFrame([(f"http://old/{x}", "http://old/p", x, "literal", None, None) for x in xs], "s string, p string, o string, o_kind string, datatype string, lang string")
    store = GraphStore(spark, str(tmp_path / "g"))
    store.put("g1", rows("a", "a", "b"))
    store.put("g2", rows("b", "c"))
    store.post("g1", rows("b", "d"))
    assert store.read("g1").count() == 3 and store.read().count() == 4 and store.graphs() == ["g1", "g2"]
    store.put("g1", rows("e"))
    assert store.read("g1").count() == 1 and store.read("g2").count() == 2
    new, n = rewrite_namespace(rows("a", "b"), "http://old", "http://new")
    assert n == 4 and new.where(F.col("s").startswith("http://new/")).count() == 2
    assert rewrite_namespace(rows("a"), "http://old/", "x", dry_run=True)[1] == 2


def test_geojson_and_endpoint(spark, tmp_path):
    body = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"code": k}, "geometry": {"type": "Point", "coordinates": [k, 1]}} for k in (1, 2)]}
    answer = {"results": {"bindings": [{"a": {"value": "1"}, "b": {"value": "x"}}, {"a": {"value": "2"}}]}}

    class Handler(http.server.BaseHTTPRequestHandler):
        def _say(self, what):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(what).encode())

        def do_GET(self):
            self._say(body)

        def do_POST(self):
            self.rfile.read(int(self.headers["Content-Length"]))
            self._say(answer)

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    address = f"http://127.0.0.1:{server.server_port}/"
    place = str(tmp_path / "geo" / "f.json")
    assert [r.code for r in read_geojson(spark, place, address).orderBy("code").collect()] == [1, 2]
    assert fetch_if_absent("http://127.0.0.1:1/", place) == place
    got = read_endpoint(spark, address, "SELECT ?a ?b {}", ["a", "b"])
    assert [tuple(r) for r in got.collect()] == [("1", "x"), ("2", None)]
    server.shutdown()
