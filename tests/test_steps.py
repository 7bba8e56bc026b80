import datetime

import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset, Pipeline
from lumencube.functions import fuzzy
from lumencube.functions.numbers import java_pattern, start_year
from lumencube.functions.text import is_snake_case, normalize_text, province_key, slugify, snake_case, title_case
from lumencube.operators import columns as C
from lumencube.operators.rows import FilterRows, LeftJoinEnrich


def one(spark, values, step, kind="string"):
    got = step.apply(Dataset(spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, a {kind}")))
    return [r.a for r in got.data.orderBy("k").collect()]


def column(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, a string").orderBy("k").select(f(F.col("a"))).collect()]


def test_names(spark):
    names = {"FullName": "full_name", "ID": "id", "Full Name": "full_name", "City ": "city", "name@home": "name_home", "price($)": "price"}
    assert {n: snake_case(n) for n in names} == names
    assert is_snake_case("a_b1") and not is_snake_case("a__b") and not is_snake_case("A")
    with pytest.raises(ValueError):
        C.NormalizeColumnNames().apply(Dataset(spark.createDataFrame([(1, 2)], "`Full Name` int, FullName int")))


def test_rename_and_drop(spark):
    d = Dataset(spark.createDataFrame([(1, 2)], "a int, b int"))
    assert C.RenameColumns({"a": "b", "b": "a"}).apply(d).columns == ["b", "a"]
    with pytest.raises(ValueError):
        C.RenameColumns({"a": "b"}).apply(d)
    for step in (C.RenameColumns({"x": "y"}), C.DropColumns(["x"])):
        with pytest.raises(KeyError):
            step.apply(d)
    assert C.DropEmptyColumns().apply(Dataset(d.data.limit(0))).columns == []


def test_fill(spark):
    assert one(spark, [1.0, None, 3.0], C.FillMissing("a", "mean"), "double") == [1.0, 2.0, 3.0]
    assert one(spark, [1.0, None, float("nan"), 5.0, 3.0], C.FillMissing("a", "median"), "double") == [1.0, 3.0, 3.0, 5.0, 3.0]
    assert one(spark, ["x", None], C.FillMissing("a", "constant", "y")) == ["x", "y"]
    assert one(spark, [None], C.FillMissing("a", "mean"), "double") == [None]
    with pytest.raises(ValueError):
        C.FillMissing("a", "mode")
    with pytest.raises(ValueError):
        C.FillMissing("a", "constant")


def test_casts(spark):
    assert one(spark, ["1", "bad", "3", "nan", " 4 ", "1d", "1e3"], C.CastTypes({"a": "float"}, errors="coerce")) == [1.0, None, 3.0, None, 4.0, None, 1000.0]
    assert one(spark, ["1.9", None, "x"], C.CastTypes({"a": "Int64"}, errors="coerce")) == [1, None, None]
    assert one(spark, ["0", "", None], C.CastTypes({"a": "bool"})) == [True, False, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, ["1", "not_a_number"], C.CastTypes({"a": "int"}))
    with pytest.raises(ValueError):
        C.CastTypes({"a": "complex"})
    with pytest.raises(ValueError):
        C.CastTypes({"a": "int"}, errors="ignore")


def test_dates(spark):
    day = datetime.datetime(2024, 1, 15)
    assert one(spark, ["15/01/2024", "not_a_date", None], C.ParseDates("a", "%d/%m/%Y", errors="coerce")) == [day, None, None]
    assert one(spark, ["2024-01-15"], C.ParseDates(["a"])) == [day]
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        one(spark, ["not_a_date"], C.ParseDates("a", "%d/%m/%Y"))
    assert java_pattern("%Y-%m-%dT%H") == "yyyy-MM-dd'T'HH"
    with pytest.raises(ValueError):
        java_pattern("%Q")


def test_text_keys(spark):
    assert column(spark, ["Forlì", "Cesenà ", "Münich", "Sant’Angelo", "L`Aquila", " a \t b ", "", None, "日本"], normalize_text) == ["forli", "cesena", "munich", "sant'angelo", "l'aquila", "a b", None, None, None]
    assert column(spark, ["Verbano -Cusio-Ossola", "  Forlì  ", "Valle d’Aosta"], province_key) == ["verbano-cusio-ossola", "forli", "valle d’aosta"]
    assert column(spark, ["CAGLIARI E SUD SARDEGNA", "Valle d'Aosta/Vallée", " -x- "], slugify) == ["cagliari-e-sud-sardegna", "valle-d-aosta-vallee", "x"]
    assert column(spark, ["l'aquila", " A-b cD"], title_case) == ["L'Aquila", "A-B Cd"]
    key = C.AddNormalizedKey("a", "key").apply(Dataset(spark.createDataFrame([("Forlì",)], "a string")))
    assert key.data.first().key == "forli"


def test_italian_numbers(spark):
    step = C.ParseItalianNumbers("a")
    assert one(spark, ["1.234,56", "394.676", "0,5", "1.000.000,75", "-", "- ", "", "n.d.", "1.5", "12%"], step) == [1234.56, 394676.0, 0.5, 1000000.75, None, None, None, None, 15.0, None]
    assert one(spark, [1.5, None], step, "double") == [1.5, None]
    assert one(spark, ["MISSING", "1"], C.ParseItalianNumbers("a", ["MISSING"])) == [None, 1.0]
    auto = C.ParseItalianNumbersAuto().apply(Dataset(spark.createDataFrame([("1.000", "12,5 %", "x"), ("-", None, "1")], "a string, b string, c string")))
    assert dict(auto.data.dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert column(spark, ["Decorrenza anteriore al 31/12/1980", "2003", "Totale", "x"], start_year) == [1980, 2003, None, None]


def test_estimate_and_mapping(spark):
    d = Dataset(spark.createDataFrame([(100, 1000.0), (None, 2.0), (50, 500.0)], "n bigint, m double"))
    got = C.EstimateAnnualAmount("n", "m", "y").apply(d)
    assert sorted((r.y for r in got.data.collect()), key=str) == sorted([1300000.0, None, 325000.0], key=str)
    assert got.history[0].metrics == {"input_rows": 3, "non_null_rows": 2, "estimated_sum": 1625000.0}
    with pytest.raises(ValueError):
        C.EstimateAnnualAmount("n", "m", "y", months=0)
    codes = Dataset(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string"))
    maps = {"x": {"a": 1, "b": 2}, "y": {"a": "one"}}
    with pytest.raises(ValueError, match="z"):
        C.EnrichWithStaticMapping("c", maps).apply(codes)
    loose = C.EnrichWithStaticMapping("c", maps, raise_on_unmatched=False).apply(codes)
    assert {(r.c, r.x, r.y) for r in loose.data.collect()} == {("a", 1, "one"), ("b", 2, None), ("z", None, None), (None, None, None)}
    assert loose.history[0].metrics == {"unmatched": ["z"]}


def test_examples(spark):
    phones = ["0039 06-123", "+39 02 9", "n/a", "0612"]
    assert one(spark, phones, C.FormatItalianPhone("a")) == ["+39 06123", "+39 029", None, "+39 0612"]
    assert one(spark, ["àéî"], C.StripAccents("a")) == ["aei"]
    d = Dataset(spark.createDataFrame([("  x" * 20, 1)], "a string, b int"))
    got = Pipeline([C.StripStringColumns(), C.SmartTrim("a", {"a": 4}), C.TitleCase("a"), C.WithColumn("c", "k"), C.WithColumn("d", lambda t: t["b"] + 1)], on_error="raise").run(d)
    assert tuple(got.data.first()) == ("X  X", 1, "k", 2)


def test_join(spark):
    left = Dataset(spark.createDataFrame([("Castelnuovo", "PD"), ("Castelnuovo", "VR"), (None, "PD")], "comune string, prov string"))
    right = spark.createDataFrame([("Castelnuovo", "PD", 1, "p"), ("Castelnuovo", "VR", 2, "v"), (None, "PD", 3, "n")], "label string, sigla string, id int, prov string")
    got = LeftJoinEnrich(Dataset(right), ["comune", "prov"], ["label", "sigla"], ["id", "prov", "label"]).apply(left)
    assert got.columns == ["comune", "prov", "id", "prov_right", "label"]
    assert {(r.comune, r.prov, r.id) for r in got.data.collect()} == {("Castelnuovo", "PD", 1), ("Castelnuovo", "VR", 2), (None, "PD", 3)}
    numbers = Dataset(spark.createDataFrame([(1,), (2,), (999,)], "id int"))
    values = spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string")
    assert LeftJoinEnrich(values, "id", columns=["value"]).apply(numbers).history[0].metrics == {"matched": 2, "unmatched": 1}
    with pytest.raises(ValueError):
        LeftJoinEnrich(values, ["id"], ["id", "value"])
    with pytest.raises(KeyError):
        LeftJoinEnrich(values, "id", columns=["nope"]).apply(numbers)


def test_filter_metrics(spark):
    d = Dataset(spark.createDataFrame([(1,), (None,), (3,)], "a int"))
    got = FilterRows(lambda t: t["a"] > 1).apply(d)
    assert [r.a for r in got.data.collect()] == [3] and got.history[0].metrics == {"rows_before": 3, "rows_after": 1, "rows_removed": 2}


def test_fuzzy_ratio(spark):
    def lcs(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b, 1):
                last, best[k] = best[k], last + 1 if x == y else max(best[k], best[k - 1])
        return best[-1]

    import random

    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 12))) for _ in range(2))
        assert fuzzy.lcs_length(a, b) == lcs(a, b)
    assert fuzzy.ratio("torin", "torino") == pytest.approx(90.909, abs=1e-3)
    rows = spark.createDataFrame([("torin", "torino"), ("abc", "xyz"), (None, "x")], "a string, b string")
    got = rows.select(fuzzy.ratio_column(F.col("a"), F.col("b")).alias("s"), fuzzy.may_reach(F.col("a"), F.col("b"), 90).alias("m")).collect()
    assert got[0].s > 90 and got[0].m and got[1].s == 0 and not got[1].m and got[2].s is None


def test_best_matches(spark):
    import random

    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(60)} | {"".join(rng.choices("abcdef", k=rng.randint(15, 30))) for _ in range(20)})
    keys = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(40)} | {"", "xyz"})
    for w in words[::3]:  # and words with some letters gone or added
        keys.append("".join(c + rng.choice(["", "", "", "", "z"]) for c in w if rng.random() > 0.1))
    keys = sorted(set(keys))
    names = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "name string, i int")
    for least in (0, 20, 50, 70, 80, 85, 90, 100):
        got = {r.key: (r.name, r.i) for r in fuzzy.best_matches(spark.createDataFrame([(k,) for k in keys], "key string"), names, least, "i").collect()}
        want = {}
        for key in keys:
            score, i = min((-fuzzy.ratio(key, w), i) for i, w in enumerate(words))
            if -score >= least:
                want[key] = (words[i], i)
        assert got == want, least


def test_folding_follows_the_unicode_database(spark):
    import unicodedata

    from lumencube.functions import text

    odd = [chr(x) for x in range(0x80, 0x20000) if not (0xD800 <= x <= 0xDFFF or 0xAC00 <= x <= 0xD7A3)]
    rows = spark.createDataFrame([(k, "aé" + c + "ﬁ" * (k % 2) + "Z") for k, c in enumerate(odd)], "k int, c string")
    got = rows.select("c", text.strip_accents(F.col("c")).alias("s")).collect()
    bad = [r for r in got if r.s != unicodedata.normalize("NFKD", r.c).encode("ascii", "ignore").decode()]
    assert not bad, bad[:5]
    assert len(got) == len(odd)


def test_exact_quantiles(spark):
    import random

    import numpy as np

    from lumencube.operators.quantiles import exact_quantiles

    rng = random.Random(4)
    shares = [0.0, 0.2, 0.5, 0.777, 1.0]
    for values in ([5.0], [1.0, 2.0], [3.0] * 40, [rng.choice([0.0, 1.0, rng.random()]) for _ in range(5001)], [rng.gauss(0, 1e6) for _ in range(30_000)]):
        frame = spark.createDataFrame([(x,) for x in [*values, None, float("nan")]], "x double")
        assert np.allclose(exact_quantiles(frame, frame.x, shares), np.quantile(values, shares), rtol=1e-9, atol=1e-12)
    assert exact_quantiles(frame.limit(0), frame.x, shares) is None
