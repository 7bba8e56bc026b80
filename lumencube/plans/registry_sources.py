"""Registered queries: sources, sinks, named graphs and streams, by writing tables and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import Dataset, Pipeline
from ..operators import columns as C
from ..operators.rows import FilterRows
from ..scratch import shared_dir
from ..sources import olap, sinks, tabular
from ..sources.turtle import read_turtle
from ..streaming import stateful
from ..streaming import steps as S
from .registry import _TYPE, _XSD, nation_triples, nth, query, run, t


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark, 'io')}/{name}"


def _lines(frame: DataFrame, path: str) -> str:
    """Write the column ``value`` as text lines."""
    frame.select("value").write.mode("overwrite").text(path)
    return path


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice, o_orderkey % 2 = 0 AS even FROM orders")
def csv_round_trip(spark, d):
    """Types are inferred from the text; missing values come back as missing."""
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(nth("o_orderkey", 5) != 0, F.col("o_totalprice")).alias("o_totalprice"), (nth("o_orderkey", 2) == 0).alias("even"))
    place = _place(spark, "orders.csv")
    Dataset(o).to_csv(place)
    return Dataset.from_csv(place, spark).data


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'NA' WHEN 1 THEN '' ELSE n_name END AS code FROM nation")
def csv_literal_na(spark, d):
    rows = t(spark, d, "nation").select("n_nationkey", F.when(nth("n_nationkey", 3) == 0, "NA").when(nth("n_nationkey", 3) == 2, F.col("n_name")).alias("code"))
    place = _place(spark, "codes.csv")
    Dataset(rows).to_csv(place, sep=";")
    return Dataset.from_csv(place, spark, sep=";", infer=False, keep_default_na=False).data


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation")
def csv_with_byte_order_mark(spark, d):
    rows = t(spark, d, "nation").select(F.col("n_nationkey").alias(tabular.BOM + "n_nationkey"), "n_name")
    place = _place(spark, "bom.csv")
    Dataset(rows).to_csv(place)
    return Dataset.from_csv(place, spark, encoding="utf-8-sig").data


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price FROM orders")
def parquet_source(spark, d):
    """NaN is missing from the start."""
    o = t(spark, d, "orders").select("o_orderkey", F.when(nth("o_orderkey", 4) == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"))
    place = _place(spark, "orders")
    Dataset(o).to_parquet(place)
    return Dataset.from_parquet(place, spark).data


@query("SELECT * FROM (VALUES (1, 'a', 1.5), (2, NULL, NULL), (3, 'ç', -2.0)) x(k, name, v)")
def memory_source(spark, d):
    return Dataset.from_rows([(1, "a", 1.5), (2, None, None), (3, "ç", -2.0)], "k int, name string, v double", spark).data


@query("SELECT n_nationkey AS code, 'd''' || n_name || ', x' AS name, CAST(n_regionkey AS DOUBLE) / 2 AS value FROM nation")
def quoted_csv_source(spark, d):
    rows = t(spark, d, "nation").select("n_nationkey", F.concat(F.lit("d'"), "n_name", F.lit(", x")).alias("name"), (F.col("n_regionkey") / 2).alias("value"))
    place = _place(spark, "quoted.csv")
    rows.write.option("header", True).option("quote", "'").option("escape", "'").option("quoteAll", True).csv(place)
    return tabular.read_quoted_csv(spark, place, "code int, name string, value double")


@query("SELECT 'Supplier ' || s_suppkey AS provincia, CAST(s_nationkey AS VARCHAR) AS numero, replace(CAST(s_acctbal AS VARCHAR), '.', ',') AS importo FROM supplier")
def olap_export_source(spark, d):
    """Titles, sub-headers and totals around the rows go; cells are text."""
    s = t(spark, d, "supplier")
    cells = F.concat_ws('","', F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")), F.col("s_nationkey").cast("string"), F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(",")))
    rows = s.select(F.concat(F.lit('"'), cells, F.lit('"')).alias("value"))
    around = spark.range(1).select(F.explode(F.array(*map(F.lit, ['"A title"', "", '"Provincia di residenza","Numero","Importo"', '"Totale","1","2"']))).alias("value"))
    return olap.read_export(spark, _lines(around.unionByName(rows), _place(spark, "export")), ["provincia", "numero", "importo"])


@query("SELECT CAST(1960 + p_size AS INTEGER) AS anno_decorrenza, CAST(count(*) AS BIGINT) * 1000 AS numero_pensioni, 60.5 AS eta_decorrenza, 1234.5 AS importo_medio, CAST(NULL AS DOUBLE) AS importo_medio_decorrenza, 70.25 AS eta FROM part GROUP BY p_size")
def start_years_source(spark, d):
    n = t(spark, d, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))
    number = F.concat(F.col("n").cast("string"), F.lit(".000"))
    rows = n.select(F.concat(F.lit('"anno '), (1960 + F.col("p_size")).cast("string"), F.lit('","x","'), number, F.lit('","60,5","1.234,50","-","70,25"')).alias("value"))
    rows = rows.unionByName(spark.range(1).select(F.lit('"Totale","x","9","1","1","1","1"').alias("value")))
    return olap.read_start_years(spark, _lines(rows, _place(spark, "years")))


_TRIPLES = f"""
SELECT 'http://ex/n' || n_nationkey AS s, '{_TYPE}' AS p, 'http://ex/Nation' AS o, 'iri' AS o_kind, NULL AS datatype, NULL AS lang FROM nation
UNION ALL SELECT 'http://ex/n' || n_nationkey, 'http://ex/label', n_name, 'literal', NULL, 'en' FROM nation
UNION ALL SELECT 'http://ex/n' || n_nationkey, 'http://ex/key', CAST(n_nationkey AS VARCHAR), 'literal', '{_XSD}integer', NULL FROM nation"""


@query(_TRIPLES)
def turtle_source(spark, d):
    """Prefixes, predicate and object lists, short numbers, language tags; one file for each region."""
    n = t(spark, d, "nation").select(F.concat(F.lit("ex:n"), F.col("n_nationkey").cast("string"), F.lit(" a ex:Nation ;\n  ex:label "), F.lit('"'), "n_name", F.lit('"@en ; # a note\n  ex:key '), F.col("n_nationkey").cast("string"), F.lit(" .")).alias("value"), "n_regionkey")
    files = n.groupBy("n_regionkey").agg(F.array_join(F.collect_list("value"), "\n").alias("body"))
    whole = files.select(F.concat(F.lit("@prefix ex: <http://ex/> .\n"), "body").alias("value"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("part"))
    place = _place(spark, "graph")
    whole.repartition("part").write.partitionBy("part").option("lineSep", "\n").text(place)
    fs = spark._jvm.org.apache.hadoop.fs
    root = fs.Path(place)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for at in [x.getPath() for x in store.globStatus(fs.Path(f"{place}/part=*/part-*"))]:  # a few files
        store.rename(at, fs.Path(at.getParent(), "data.ttl"))
    return read_turtle(spark, place)


@query("SELECT n_nationkey AS code, n_name AS name, '{\"type\":\"Point\",\"coordinates\":[' || n_nationkey || '.5,' || n_regionkey || '.5]}' AS geometry FROM nation")
def geojson_source(spark, d):
    n = t(spark, d, "nation")
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col("n_nationkey") + 0.5, F.col("n_regionkey") + 0.5).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")).alias("properties"), point.alias("geometry"))
    whole = n.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))  # the 25 nations
    got = tabular.read_geojson(spark, _lines(whole.coalesce(1), _place(spark, "shapes.json")))
    shape = F.from_json("geometry", "type string, coordinates array<double>")
    return got.select(F.col("code").cast("int").alias("code"), "name", F.to_json(shape).alias("geometry"))


@query("SELECT * FROM supplier")
def saved_json(spark, d):
    """The format comes from the path's suffix."""
    place = sinks.save_dataset(Dataset(t(spark, d, "supplier")), _place(spark, "supplier.json"))
    return spark.read.schema(t(spark, d, "supplier").schema).json(place)


@query("SELECT '<http://ex/n' || n_nationkey || '> <http://ex/label> \"' || n_name || '\"@en .' AS value FROM nation UNION ALL SELECT '<http://ex/n' || n_nationkey || '> <http://ex/key> \"' || n_nationkey || '\"^^<http://www.w3.org/2001/XMLSchema#integer> .' FROM nation")
def n_triples_sink(spark, d):
    """Each triple once, whatever was given."""
    some = nation_triples(spark, d).where(F.col("s").startswith("http://ex/n") & F.col("p").isin("http://ex/label", "http://ex/key"))
    place = _place(spark, "triples.nt")
    sinks.write_triples(some.unionByName(some), place)
    return spark.read.text(place)


@query(f"SELECT s, p, o FROM ({_TRIPLES}) WHERE p <> 'http://ex/key' UNION ALL SELECT 'http://ex/own', 'http://ex/label', 'own'")
def named_graphs(spark, d):
    """A graph is replaced by put, another grows by post, and reading without a graph gives the union as a set."""
    store = sinks.GraphStore(spark, _place(spark, "graphs"))
    n = nation_triples(spark, d).where(F.col("s").startswith("http://ex/n"))
    store.put("a", n.where(F.col("p") == "http://ex/key"))
    store.put("a", n.where(F.col("p") == "http://ex/label"))
    store.post("b", n.where(F.col("p") == _TYPE))
    own = spark.createDataFrame([("http://ex/own", "http://ex/label", "own", "literal", None, None)], n.schema)
    store.post("b", n.where(F.col("p") == _TYPE).unionByName(own))
    store.post("b", n.where(F.col("p") == "http://ex/label"))
    return store.read().select("s", "p", "o")


@query(f"SELECT replace(s, 'http://ex/', 'https://new/') AS s, replace(p, 'http://ex/', 'https://new/') AS p, replace(o, 'http://ex/', 'https://new/') AS o, (SELECT 6 * count(*) FROM nation) AS places FROM ({_TRIPLES}) WHERE p <> '{_TYPE}' UNION ALL SELECT replace(s, 'http://ex/', 'https://new/'), p, 'https://new/Nation', (SELECT 6 * count(*) FROM nation) FROM ({_TRIPLES}) WHERE p = '{_TYPE}'")
def namespace_rewrite(spark, d):
    n = nation_triples(spark, d).where(F.col("s").startswith("http://ex/n") & F.col("p").isin("http://ex/label", "http://ex/key", _TYPE))
    got, places = sinks.rewrite_namespace(n, "http://ex", "https://new/")
    return got.select("s", "p", "o", F.lit(places).cast("bigint").alias("places"))


@query("SELECT r_regionkey AS key, r_name AS name FROM region")
def dataset_renamed(spark, d):
    return Dataset(t(spark, d, "region")).with_columns_renamed({"r_regionkey": "key", "r_name": "name"}).data


@query("SELECT s_suppkey, s_name FROM supplier")
def strip_string_columns(spark, d):
    rows = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit(" \t"), "s_name", F.lit(" \n")).alias("s_name"))
    return run(rows, C.StripStringColumns())


@query("SELECT s_suppkey, 'Supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS city, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0) AS n_changed FROM supplier")
def city_and_phone_steps(spark, d):
    """A city's name, and how many phone cells a step changed."""
    s = t(spark, d, "supplier")
    plain = F.concat(F.lit("+39 "), (F.col("s_suppkey") + 1000).cast("string"))
    rows = s.select("s_suppkey", F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")).alias("city"), F.when(nth("s_suppkey", 3) == 0, plain).otherwise(F.replace(plain, F.lit("+39 "), F.lit("0039-"))).alias("phone"))
    done = Pipeline([C.NormalizeCity("city"), C.FormatItalianPhone("phone")], on_error="raise").run(Dataset(rows))
    return done.data.select("s_suppkey", "city", F.lit(done.history[-1].metrics["n_changed"]).cast("bigint").alias("n_changed"))


@query("SELECT n_nationkey FROM nation WHERE n_nationkey < 10")
def pipeline_skips_errors(spark, d):
    """A step that fails is left out and the others run."""
    rows = t(spark, d, "nation").select("n_nationkey", "n_name")
    steps = [C.DropColumns(["no_such_column"]), FilterRows(lambda x: x["n_nationkey"] < 10), C.DropColumns(["n_name"])]
    return Pipeline(steps, on_error="skip").run(Dataset(rows)).data


# streams ------------------------------------------------------------------------------------


def _events(spark, d) -> DataFrame:
    return spark.readStream.schema(t(spark, d, "events").schema).parquet(f"{d}/events.parquet*")


def _drained(spark, stream: DataFrame) -> DataFrame:
    """What the stream writes until its input ends."""
    place = _place(spark, "stream")
    running = stream.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").option("path", f"{place}/out").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/out")


@query("SELECT event_id, upper(event_type) AS kind, value * 2 AS twice FROM events WHERE value > 10")
def stream_stateless(spark, d):
    steps = [FilterRows(lambda x: x["value"] > 10), C.WithColumn("kind", F.upper("event_type")), C.WithColumn("twice", F.col("value") * 2), C.DropColumns(["ts", "user_id", "event_type", "value", "props"])]
    return _drained(spark, S.apply_steps(_events(spark, d), steps))


def _timed(spark, d) -> DataFrame:
    return _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))


_ENDED = "(SELECT date_trunc('millisecond', max(ts) - INTERVAL 1 HOUR) FROM events)"
_SESSIONS = "SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events)"


@query(
    f"SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n, round(sum(value), 4) AS total, arg_min(event_type, (ts, event_type)) AS first_kind, arg_max(event_type, (ts, event_type)) AS last_kind"
    f" FROM ({_SESSIONS}) GROUP BY user_id, session HAVING max(ts) + INTERVAL 2 HOUR <= {_ENDED}"
)
def stream_closed_sessions(spark, d):
    """A stateful operator with timers over the stream; open sessions are not there yet."""
    with stateful.state_store(spark):
        got = _drained(spark, stateful.closed_sessions(_timed(spark, d), "ts", ["user_id"], "event_type", "value", 7200, "1 hour"))
    return got.withColumns({"total": F.round("total", 4), "session_start": F.col("session_start").cast("timestamp_ntz"), "session_end": F.col("session_end").cast("timestamp_ntz")})


@query("SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 90 MINUTE WHERE c.event_type = 'click' AND p.event_type = 'purchase'")
def stream_interval_join(spark, d):
    """Two streams: the purchases of a user within 90 minutes after a click."""
    clicks = _timed(spark, d).where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("clicked"))
    bought = _timed(spark, d).where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought"))
    return _drained(spark, stateful.interval_join(clicks, bought, "clicked", "bought", [("user_id", "buyer")], "0 seconds", "90 minutes", "2 hours")).select("click_id", "purchase_id", "user_id")


@query(f"SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2 HAVING window_start + INTERVAL 6 HOUR <= {_ENDED}")
def stream_windows(spark, d):
    """Windows that the watermark has passed."""
    got = _drained(spark, S.windowed(_timed(spark, d), "ts", ["event_type"], "6 hours", "1 hour", "value"))
    return got.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"SELECT user_id, min(ts) AS session_start, count(*) AS n FROM ({_SESSIONS}) GROUP BY user_id, session HAVING max(ts) + INTERVAL 2 HOUR <= {_ENDED}")
def stream_native_sessions(spark, d):
    got = _drained(spark, S.sessions(_timed(spark, d), "ts", ["user_id"], "2 hours", "1 hour"))
    return got.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_duplicates(spark, d):
    """Keys seen once, as long as the watermark has not passed them."""
    return _drained(spark, S.drop_duplicates(_timed(spark, d), ["user_id", "event_type"], "ts", "1 hour").select("user_id", "event_type"))
