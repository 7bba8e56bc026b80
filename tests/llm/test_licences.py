import re

import pytest
from pyspark.sql import functions as F

from lumencube.llm import licences
from lumencube.llm.queries import op2_licence_scan

DATA = "/root/testdata/sf0.01"


def plain(rows, least=0.5):
    """Every line and every two or more non-blank lines in a row, scored without any gate: rows as ``found`` has them."""
    model, out, memo = licences.train(), {}, {}

    def claim(text):
        if text not in memo:
            p, own = model.probabilities(text), licences._grams(licences._words(text))
            family = model.families[int(p.argmax())]
            memo[text] = None
            if family != licences.NONE and p.max() >= model.least_probability:
                close = max(len(own & licences._grams(licences._words(t))) / len(licences._grams(licences._words(t))) for t in licences.TEMPLATES[family])
                memo[text] = (family, p.max(), close) if close >= least else None
        return memo[text]

    for doc, text in rows:
        lines = (text or "").split("\n")
        blocks, run = [], []
        for k, line in enumerate([*lines, ""]):
            if re.search(r"[^ \t\n\x0b\f\r]", line):
                run.append(k)
            elif run:
                blocks.append(run)
                run = []
        for block in blocks:
            alone = {k: claim(lines[k]) for k in block}
            out.update({(doc, k): c for k, c in alone.items() if c})
            whole = claim("\n".join(lines[k] for k in block)) if len(block) > 1 else None
            if whole and whole[0] not in {c[0] for c in alone.values() if c}:
                assert (doc, block[0]) not in out
                out[doc, block[0]] = whole
    return out


def found(frame):
    return {(r.doc_id, r.paragraph): (r.family, r.probability, r.similarity) for r in frame.collect()}


def same(got, want):
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k, v in want.items():
        assert got[k][1:] == pytest.approx(v[1:], abs=1e-6)


def test_documents_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert {f for f, _, _ in want.values()} == {"Apache-2.0", "CC-BY-NC", "GPL", "MIT", "Proprietary"}
    same(found(op2_licence_scan(spark, DATA)), want)
    lines = {(d, k): x for d, t in rows for k, x in enumerate(t.split("\n"))}
    plain_lines = {k for k, x in lines.items() if x in ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.")}
    assert plain_lines and plain_lines <= set(want)


def test_templates_and_negatives(spark):
    model = licences.train()
    assert all(any(c in t.lower() for c in licences.CUES) for ts in licences.TEMPLATES.values() for t in ts)
    for family, texts in licences.TEMPLATES.items():
        for t in texts:
            assert model.families[int(model.logits(t).argmax())] == family, t
    for t in (*licences.NEGATIVES, "The license plate was red.", "Ask the public for permission of any kind."):
        p = model.probabilities(t)
        assert p.argmax() == 0 or p.max() < model.least_probability


def test_unknown_class_is_calibrated():
    model = licences.train()
    assert 0.5 < model.least_probability < 1 and 0 < model.missed < 0.1 and model.claimed < 0.1
    other = {f: t for f, t in licences.TEMPLATES.items() if f != "ISC"}
    without = licences._fit(other, licences.NEGATIVES, 7, 8, 300, 1e-3)
    assert all(without.probabilities(t)[1:].max() < model.least_probability for t in licences.TEMPLATES["ISC"])


MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""


def test_wrapped_grant_is_one_paragraph(spark):
    docs = spark.createDataFrame([(1, f"intro words\n\n{MIT_GRANT}\n\nend")], "doc_id long, text string")
    got = found(licences.scan(docs))
    same(got, plain([(1, f"intro words\n\n{MIT_GRANT}\n\nend")]))
    assert {f for f, _, _ in got.values()} == {"MIT"} and min(got)[1] == 2


def test_edge_cases(spark):
    apache = licences.TEMPLATES["Apache-2.0"][1]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, f"some words first\n{apache}\nthen more"), (4, f"some words first\n{apache}\nthen more"), (None, "Released under the MIT License."), (5, "license license license"), (6, " ".join(f"w{k}" for k in range(100_000)) + "Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gram", F.lit("x")).withColumn("paragraph", F.lit(0)).withColumn("chars", F.lit(0))
    got = found(licences.scan(docs))
    same(got, plain(rows))
    assert got[4, 1][0] == "Apache-2.0" and got[None, 0][0] == "MIT" and (5, 0) not in got
    assert licences.scan(docs).count() == len(got)
    assert licences.scan(docs.limit(0)).count() == 0


GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_short_and_wrapped_statements(spark):
    rows = [(1, "words\n\nAll rights reserved.\n\nmore"), (2, f"first\n \n{GPL_HEADER}\n\nlast"), (None, GPL_HEADER), (3, "All rights reserved.\nSome more words follow it here."), (4, "All the rooms were reserved.\n\nShe has rights.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {k: v[0] for k, v in found(licences.scan(docs)).items()}
    assert got == {(1, 2): "Proprietary", (2, 2): "GPL", (None, 0): "GPL", (3, 0): "Proprietary"}
    assert licences.scan(docs).count() == 4


def test_short_lines_of_the_documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, k) for r in rows for k, x in enumerate(r.text.split("\n")) if x == "All rights reserved."}
    assert want and want <= {k for k, v in found(op2_licence_scan(spark, DATA)).items() if v[0] == "Proprietary"}


def test_grants_without_the_usual_words(spark):
    texts = {"This work is released under CC BY-NC 4.0.": "CC-BY-NC", "Released under GPL-3.0.": "GPL", "Released under MPL-2.0.": "MPL-2.0"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {k: v[0] for k, v in found(licences.scan(docs)).items()} == {(k, 0): f for k, f in enumerate(texts.values())}


def test_no_claim_lacks_a_cue():
    for least in (0.3, 0.5, 0.9):
        words = set(licences.cues(least))
        for text in (t for ts in licences.TEMPLATES.values() for t in ts):
            said = licences._words(text)
            grams = {tuple(said[k : k + n]) for n in licences.SIZES for k in range(len(said) - n + 1)}
            assert sum(not words & {*g, *(f"{a} {b}" for a, b in zip(g, g[1:], strict=False))} for g in grams) / len(grams) < least
