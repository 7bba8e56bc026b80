import http.server
import json
import re
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from lumencube.sources.remote import ask, filtered, read_endpoint

ROWS = [(f"k{k:02d}", f"v{k % 3}" if k % 5 else None) for k in range(25)]


class Endpoint(http.server.ThreadingHTTPServer):
    """Answers counts and pages of ROWS; the first request for the second page fails."""

    def __init__(self, most=1000):
        super().__init__(("127.0.0.1", 0), Handler)
        self.asked, self.failed, self.most = [], False, most
        threading.Thread(target=self.serve_forever, daemon=True).start()
        self.address = f"http://127.0.0.1:{self.server_port}/"


class Handler(http.server.BaseHTTPRequestHandler):
    def do_POST(self):
        query = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())["query"][0]
        self.server.asked.append(query)
        rows = ROWS
        if m := re.search(r'STR\(\?b\) = "(\w+)"', query):
            rows = [r for r in rows if r[1] == m[1]]
        if m := re.search(r"STR\(\?b\) IN \(([^)]*)\)", query):
            rows = [r for r in rows if r[1] in json.loads(f"[{m[1]}]")]
        if "!BOUND(?b)" in query:
            rows = [r for r in rows if r[1] is None]
        elif "BOUND(?b)" in query:
            rows = [r for r in rows if r[1] is not None]
        if "COUNT(*)" in query:
            self.say({"results": {"bindings": [{"n": {"value": str(len(rows))}}]}})
            return
        m = re.search(r"LIMIT (\d+) OFFSET (\d+)", query)
        if m:
            if m[2] == "10" and not self.server.failed:
                self.server.failed = True
                self.send_error(503)
                return
            rows = rows[int(m[2]) :][: min(int(m[1]), self.server.most)]
        self.say({"results": {"bindings": [{"a": {"value": a}} | ({"b": {"value": b}} if b else {}) for a, b in rows]}})

    def say(self, what):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(what).encode())

    def log_message(self, *args):
        pass


QUERY = "PREFIX ex: <http://ex/> SELECT ?a ?b WHERE { ?a ex:p ?b }"


def test_pages_are_tasks_and_a_failure_is_tried_again(spark):
    server = Endpoint()
    got = read_endpoint(spark, server.address, QUERY, ["a", "b"], page=10, order="?a", wait=0.01)
    assert got.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, got.collect()), key=str) == sorted(ROWS, key=str)
    assert server.failed and sum("OFFSET 10" in q for q in server.asked) == 2
    assert all(q.startswith("PREFIX ex: <http://ex/>") for q in server.asked)
    whole = read_endpoint(spark, server.address, QUERY, ["a", "b"])
    assert whole.rdd.getNumPartitions() == 1 and sorted(map(tuple, whole.collect()), key=str) == sorted(ROWS, key=str)
    server.shutdown()


def test_filters_go_into_the_query(spark):
    server = Endpoint()
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        base = lambda: read_endpoint(spark, server.address, QUERY, ["a", "b"], page=7, wait=0.01)
        for test, want in ((F.col("b") == "v1", [r for r in ROWS if r[1] == "v1"]), (F.col("b").isin("v0", "v2"), [r for r in ROWS if r[1] in ("v0", "v2")]), (F.col("b").isNull(), [r for r in ROWS if r[1] is None]), (F.col("a") > "k20", [r for r in ROWS if r[0] > "k20"])):
            server.asked.clear()
            assert sorted(map(tuple, base().where(test).collect())) == sorted(want)
            if "b" in str(test):
                assert all("FILTER(" in q for q in server.asked if "ORDER BY" in q)
    finally:
        spark.conf.set(key, before)
    server.shutdown()


def test_a_capped_endpoint_and_errors(spark):
    server = Endpoint(most=4)
    with pytest.raises(Exception, match="has 4 rows, not (10|5)"):
        read_endpoint(spark, server.address, QUERY, ["a", "b"], page=10, wait=0.01).collect()
    server.shutdown()
    with pytest.raises(OSError):
        ask("http://127.0.0.1:1/", "q", attempts=2, wait=0.01)
    assert filtered('BASE <http://b/>\nprefix x: <http://x/> SELECT ?a { }', ["BOUND(?a)"]) == ("BASE <http://b/>\nprefix x: <http://x/> ", "{ { SELECT ?a { } } FILTER(BOUND(?a)) }")
