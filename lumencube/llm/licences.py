"""Licence scan: a trained paragraph classifier, DataFrame functions only on the main path.

A paragraph is a line, and also the consecutive non-blank lines together, for statements that are
wrapped. Features are its distinct word n-grams (n from 1 to 3), hashed by XXH64; a multinomial logistic regression over the licence families and ``none`` is trained
on the driver from the fixed templates below and from negatives made by rule. Its weights are a small
table (grams of the templates only, a few thousand rows), joined to the paragraphs' grams; scores,
softmax and the comparison with templates are aggregations. A paragraph is ``unknown``, and not in
the result, when no family reaches the calibrated probability, or when the best template of the
predicted family doesn't confirm it. Paragraphs without any of the cues
(words and pairs of words) are not scored; these are computed from the templates so that no template could confirm such a
paragraph, which makes this a shortcut and not a rule of its own.
"""

from __future__ import annotations

import json
import random
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, written

# What licences of each family say, one paragraph each.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under Apache-2.0.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Distributed under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under BSD-3-Clause.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Licensed under the GPL, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under GPL-3.0.",
        "Released under the GNU GPL v2.",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Released under LGPL-2.1.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Released under MPL-2.0.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "CC0": (
        "This work has been dedicated to the public domain under the CC0 1.0 Universal license.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This is free and unencumbered software released into the public domain.",
        "Released under CC0 1.0.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying is prohibited under the license agreement.",
    ),
}
# Sentences about licences and permissions that grant none.
NEGATIVES = (
    "He lost his driving licence on the way to work.", "The council granted permission to build a house.", "A fishing license costs ten dollars for the season.",
    "She asked for permission to leave the room.", "The warranty covers repairs for two years.", "The copyright debate went on for many years in parliament.",
    "They discussed the license fee of the public broadcaster.", "Conditions were met by the new version of the plan.", "The software was free and came without a manual.",
    "The new version is out and the work goes on.", "Creative people are common in this city.", "The public library is open under new terms.", "You may obtain a copy at the front desk.",
    "This program is on television and it will be useful.", "The university at MIT released a new work.", "A general public meeting was held by the foundation.",
)
NONE = "none"
WORD = "[a-z0-9]+"
SIZES = (1, 2, 3)


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _grams(words: list[str]) -> set[int]:
    return {xxhash.xxh64_intdigest(" ".join(words[k : k + n]), 42) for n in SIZES for k in range(len(words) - n + 1)}


#: Words so common that a cue of them spares little.
COMMON = frozenset("a above all an and any are as at be been but by can do either for free from has have in into is it its may more must no not of on or see shall that the this to under use will with without work you your mit 0 1 2 3 4".split())


@cache
def cues(least_similarity: float) -> tuple[str, ...]:
    """Words and pairs of words of which every paragraph that shares ``least_similarity`` of some template's grams has one.

    For each template cues are taken until its grams without any of them are too few, those first that
    drop the most grams and are rare or taken already.
    """
    if least_similarity <= 0:
        return ()
    taken: set[str] = set()
    for text in (t for ts in TEMPLATES.values() for t in ts):
        words = _words(text)
        grams = {tuple(words[k : k + n]) for n in SIZES for k in range(len(words) - n + 1)}
        size = len(grams)
        while len(grams) / size >= least_similarity:
            dear = {c: 0.1 if c in taken else 1000.0 if c in COMMON else (50.0 if set(c.split()) <= COMMON else 2.0) if " " in c else 1.0 for g in grams for c in _parts(g)}
            cue = min(sorted(dear), key=lambda c: dear[c] / sum(c in _parts(g) for g in grams))
            grams = {g for g in grams if cue not in _parts(g)}
            taken.add(cue)
    return tuple(sorted(taken))


def _parts(gram: tuple[str, ...]) -> set[str]:
    return {*gram, *map(" ".join, zip(gram, gram[1:], strict=False))}


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@dataclass
class Classifier:
    families: list[str]
    bias: np.ndarray
    weights: dict[int, np.ndarray]  # of each gram's hash
    least_probability: float = 0.0
    #: at least_probability: the share of known statements that are missed, and of unknown ones that are claimed
    missed: float = 0.0
    claimed: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        out = self.bias.copy()
        for g in _grams(_words(text)):
            if g in self.weights:
                out = out + self.weights[g]
        return out

    def probabilities(self, text: str) -> np.ndarray:
        z = self.logits(text)
        p = np.exp(z - z.max())
        return p / p.sum()


def _examples(seed: int, copies: int, templates: dict[str, tuple[str, ...]], negatives: tuple[str, ...]) -> list[tuple[str, str]]:
    """Templates, whole and in windows, within other words; and negatives: prose and template words in any order."""
    rng = random.Random(seed)
    filler = _words(" ".join(negatives))
    loose = sorted({w for ts in templates.values() for t in ts for w in _words(t)})
    out = []
    for family, paragraphs in templates.items():
        for text in paragraphs:
            words = _words(text)
            for k in range(copies):
                part = words
                if k and len(words) > 12:
                    n = rng.randint(10, len(words))
                    s = rng.randint(0, len(words) - n)
                    part = words[s : s + n]
                around = [rng.choices(filler, k=rng.randint(0, 8)) if k > 1 else [] for _ in range(2)]
                out.append((family, " ".join([*around[0], *part, *around[1]])))
    for text in negatives:
        out += [(NONE, text)] * copies
    for _ in range(copies * 60):
        out.append((NONE, " ".join(rng.choices(rng.choice([loose, filler, loose + filler]), k=rng.randint(3, 30)))))
    return out


def _fit(templates: dict[str, tuple[str, ...]], negatives: tuple[str, ...], seed: int, copies: int, rounds: int, l2: float) -> Classifier:
    """Gradient descent with momentum on the log loss, families weighted alike."""
    families = [NONE, *templates]
    known = sorted({g for ts in [*templates.values(), negatives] for t in ts for g in _grams(_words(t))})
    place = {g: k for k, g in enumerate(known)}
    examples = _examples(seed, copies, templates, negatives)
    x = np.zeros((len(examples), len(known)), np.float32)
    for k, (_, text) in enumerate(examples):
        x[k, [place[g] for g in _grams(_words(text)) if g in place]] = 1
    y = np.array([families.index(f) for f, _ in examples])
    goal = np.eye(len(families), dtype=np.float32)[y]
    balance = (1 / np.bincount(y, minlength=len(families)))[y][:, None].astype(np.float32)
    balance /= balance.sum()
    w, b = np.zeros((len(known), len(families)), np.float32), np.zeros(len(families), np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - goal) * balance
        vw = 0.9 * vw - 0.5 * (x.T @ d + l2 * w)
        vb = 0.9 * vb - 0.5 * d.sum(axis=0)
        w, b = w + vw, b + vb
    return Classifier(families, b.astype(np.float64), {g: w[k].astype(np.float64) for g, k in place.items()})


@cache
def train(seed: int = 7, copies: int = 8, rounds: int = 300, l2: float = 1e-3, folds: int = 4) -> Classifier:
    """The classifier of all families, with its unknown class calibrated on what its fits have not seen.

    Unknown statements are those of each family, scored by a fit without that family, and each negative,
    scored by a fit without it (``folds`` of them). Known ones are templates in windows and words of another
    seed. ``least_probability`` is where the share of known statements under it and the share
    of unknown ones at or over it are least in sum.
    """
    model = _fit(TEMPLATES, NEGATIVES, seed, copies, rounds, l2)
    unknown = []
    for family, texts in TEMPLATES.items():
        part = _fit({f: ts for f, ts in TEMPLATES.items() if f != family}, NEGATIVES, seed, copies, rounds, l2)
        unknown += [part.probabilities(t)[1:].max() for t in texts]
    for k in range(folds):
        part = _fit(TEMPLATES, tuple(t for i, t in enumerate(NEGATIVES) if i % folds != k), seed, copies, rounds, l2)
        unknown += [part.probabilities(t)[1:].max() for t in NEGATIVES[k::folds]]
    known = [model.probabilities(t)[model.families.index(f)] for f, t in _examples(seed + 1, copies, TEMPLATES, NEGATIVES) if f != NONE]
    known, unknown = np.sort(known), np.sort(unknown)
    at = np.unique(np.concatenate([known, unknown]))
    missed = np.searchsorted(known, at) / len(known)
    claimed = 1 - np.searchsorted(unknown, at) / len(unknown)
    best = int((missed + claimed).argmin())
    model.least_probability, model.missed, model.claimed = float(at[best]), float(missed[best]), float(claimed[best])
    return model


#: The cues of the default similarity.
CUES = cues(0.5)


def _alternatives(words: tuple[str, ...]) -> str:
    """A pattern of the words that shares their beginnings, so that few branches are tried at a place."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[:1], []).append(w[1:])
    done = groups.pop("", None) is not None
    parts = [(" " if c == " " else c).replace(" ", "[^a-z0-9]+") + _alternatives(tuple(rest)) for c, rest in sorted(groups.items())]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + ("?" if done else "") if done or len(parts) > 1 else parts[0]


def has_cue(text: Column, words: tuple[str, ...] = CUES) -> Column:
    """Whether the text has one of the words, whole. Most places fail at the first letter's class."""
    first = "".join(sorted({w[0] for w in words}))
    return F.rlike(F.lower(text), F.lit(f"(?<![a-z0-9])(?=[{first}]){_alternatives(words)}(?![a-z0-9])")) if words else F.lit(True)


def _gram_hashes(paragraph: Column) -> Column:
    """The distinct grams of a paragraph, as hashes."""
    words = F.regexp_extract_all(F.lower(paragraph), F.lit(f"({WORD})"))

    def of(w: Column) -> Column:
        parts = [F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), _window(w, n)) for n in SIZES]
        return F.array_distinct(F.concat(*[F.when(F.size(w) >= n, p).otherwise(F.array().cast("array<bigint>")) for p, n in zip(parts, SIZES, strict=True)]))

    return _once(words, of)


def _window(words: Column, n: int):
    return lambda k: F.xxhash64(F.array_join(F.slice(words, k, n), " "))


def _table(spark: SparkSession, rows: list[dict], kinds: str, path: str) -> DataFrame:
    """A small table from the driver, read from one literal by a built-in function and written, so that no Python worker makes it."""
    text = F.lit(json.dumps(rows))
    made = spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{kinds}>>")))
    return written(made, path)


def _tables(spark: SparkSession, model: Classifier) -> tuple[DataFrame, DataFrame, DataFrame]:
    home = shared_dir(spark)
    texts = [(k, f, t) for k, (f, t) in enumerate((f, t) for f, ts in TEMPLATES.items() for t in ts)]
    weights = [{"gram": _signed(g), "w": [float(x) for x in w]} for g, w in model.weights.items()]
    grams = [{"template": k, "gram": _signed(g)} for k, _, t in texts for g in sorted(_grams(_words(t)))]
    sizes = [{"template": k, "t_family": f, "template_text": t, "n_grams": len(_grams(_words(t)))} for k, f, t in texts]
    return (
        _table(spark, weights, "gram:bigint,w:array<double>", f"{home}/weights"),
        _table(spark, grams, "template:int,gram:bigint", f"{home}/grams"),
        _table(spark, sizes, "template:int,t_family:string,template_text:string,n_grams:int", f"{home}/templates"),
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is computed once and not in each place that names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _paragraphs(text: Column, words: tuple[str, ...] = CUES) -> Column:
    """Each line, and each two or more consecutive non-blank lines joined: array<struct<block, paragraph, joined, said>>.

    Lines carry their numbers through the split into blocks; block and paragraph are numbers of first lines.
    """
    lines = F.transform(F.split(text, "\n", -1), lambda x, k: F.concat(k.cast("string"), F.lit(":"), x))
    blocks = F.split(F.array_join(lines, "\n"), r"\n(?=[0-9]+:[ \t\r\f\x0B]*(?:\n|\z))", -1)

    def number(line: Column) -> Column:
        return F.substring_index(line, ":", 1).cast("int")

    def said(line: Column) -> Column:
        return F.regexp_replace(line, "^[0-9]+:", "")

    def listed(full: Column, first: Column) -> Column:
        alone = F.transform(full, lambda x: F.struct(first.alias("block"), number(x).alias("paragraph"), F.lit(False).alias("joined"), said(x).alias("said")))
        whole = F.struct(first.alias("block"), first.alias("paragraph"), F.lit(True).alias("joined"), F.array_join(F.transform(full, said), "\n").alias("said"))
        return F.when(F.size(full) > 1, F.concat(alone, F.array(whole))).otherwise(alone)

    def of(block: Column) -> Column:
        full = F.filter(F.split(block, "\n", -1), lambda x: F.rlike(x, F.lit(r"^[0-9]+:[\s\S]*\S")))
        return _once(full, lambda f: _once(number(F.get(f, F.lit(0))), lambda first: listed(f, first)))

    return F.flatten(F.transform(F.filter(blocks, lambda x: has_cue(x, words)), of))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_similarity: float = 0.5, model: Classifier | None = None) -> DataFrame:
    """Paragraphs that a licence family claims.

    Returns doc_id, paragraph (the number of its first line, from 0), family, probability, similarity (the share of the best
    template's grams that the paragraph has), template_text, chars (of the paragraph). Joined lines
    are in the result where no line of theirs alone is claimed by the family. Null and empty texts have no such
    paragraphs; a null id stays; repeated rows of one id give their paragraphs once; other columns are not read; an
    empty table gives an empty result. The three tables of the model are broadcast; their size is fixed
    by the templates.
    """
    spark = docs.sparkSession
    model = model or train()
    weights, grams, templates = _tables(spark, model)
    text, some = F.col(text_col).cast("string"), cues(least_similarity)
    rows = docs.where(text.isNotNull() & has_cue(text, some)).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc"), F.explode(_paragraphs(text, some)).alias("p"))
    rows = rows.select("doc_id", "doc", "p.*").where(has_cue(F.col("said"), some)).withColumns({"chars": F.char_length("said").cast("long"), "print": F.xxhash64("said")})
    key = ["doc_id", "doc", "block", "paragraph", "joined", "chars", "print"]  # never the text itself, which each gram would carry
    each = rows.select(*key, F.explode(_gram_hashes(F.col("said"))).alias("gram"))
    each = each.join(F.broadcast(weights.select("gram")), "gram", "left_semi").distinct()  # the grams of templates among them
    k = len(model.families)
    sums = [F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(k)]
    scored = each.join(F.broadcast(weights), "gram").groupBy(*key).agg(*sums)
    logits = F.array(*[F.round(F.col(f"s{i}") + F.lit(float(model.bias[i])), 9) for i in range(k)])
    scored = scored.select(*key, logits.alias("z"))
    top = F.array_max("z")
    best = F.array_position("z", top)
    p = 1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    named = scored.select(*key, F.element_at(F.array(*map(F.lit, model.families)), best.cast("int")).alias("family"), p.alias("probability"))
    named = named.where((F.col("family") != NONE) & (F.col("probability") >= model.least_probability))
    shared = each.join(F.broadcast(grams), "gram").groupBy(*key, "template").agg(F.count(F.lit(1)).alias("n"))
    shared = shared.join(F.broadcast(templates), "template").select(*key, "t_family", "template_text", (F.col("n") / F.col("n_grams")).alias("similarity"))
    close = shared.groupBy(*key, "t_family").agg(F.max(F.struct("similarity", "template_text")).alias("t"))
    same = [named[c].eqNullSafe(close[c]) for c in key]
    joined = named.join(close, [*same, named.family == close.t_family])
    out = joined.select(*[named[c] for c in key[:5]], "family", "probability", F.col("t.similarity").alias("similarity"), F.col("t.template_text").alias("template_text"), named.chars)
    alone = F.min("joined").over(Window.partitionBy("doc_id", "doc", "block", "family"))
    out = out.where(F.col("similarity") >= least_similarity).withColumn("one", ~alone).where(~(F.col("joined") & F.col("one")))
    return out.drop("doc", "block", "joined", "one").distinct()
