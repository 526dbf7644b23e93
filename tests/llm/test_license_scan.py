"""Held-out windows, notices in every surrounding, unknown licences, and a plain scorer as brute force."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.llm import license_scan as L
from curata.llm.hashing import Words, mix

NOTICES = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.", "cc": "Licensed under CC BY-NC 4.0.",
           "gpl": "This work is licensed under the GNU General Public License, version 3.", "bsd": "Distributed under the BSD 3-Clause License"}


def docs_of(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def rows(spark):
    return L.training_rows(docs_of(spark), "doc_id", "text", L.SAMPLE_DOCS, L.SAMPLE_PARAGRAPHS)


@pytest.fixture(scope="module")
def model(rows):
    return L.train(*rows)


@pytest.fixture(scope="module")
def prose(spark):
    texts = [r.text for r in docs_of(spark).orderBy("doc_id").limit(60).collect()]
    return [t for t in texts if not any(w in t.lower() for w in ("licen", " cc by"))]


def confirmed(model, text, templates=L.Templates()):
    return {f for _, f, _, _, _, ok in L.find(model, templates, L.paragraphs(text), L.MIN_TEMPLATE) if ok}


def test_held_out_accuracy(rows):
    texts, labels, unseen = rows
    test = np.arange(len(texts)) % 4 == 1
    began = time.perf_counter()
    model = L.train([t for t, x in zip(texts, test) if not x], labels[~test], unseen)
    assert time.perf_counter() - began < 60
    p = L._softmax(L._scores(model, [t for t, x in zip(texts, test) if x]) / model.temperature)
    right = p.argmax(axis=1) == labels[test]
    assert right.mean() > 0.97 and np.allclose(p.sum(axis=1), 1)
    assert right[p.max(axis=1) > 0.9].mean() > 0.98                # calibrated: sure rows are right


def test_a_plain_scorer_gives_the_same(model, prose):
    text = prose[0][:900] + " " + NOTICES["gpl"] + " " + prose[1][:500]
    of, lo, hi, p = model.probabilities(["", text, "one", NOTICES["cc"]])
    doc = Words([text], plain=True)
    for i in np.flatnonzero(of == 1):
        h = doc.hash[lo[i]:hi[i]]
        grams = [*h, *(mix(np.array([(int(a) * 31 + int(b)) % 2**64], dtype=np.uint64))[0] for a, b in zip(h, h[1:]))]
        score = sum(model.weights[int(g % np.uint64(L.FEATURES))].astype(float) for g in grams) / math.sqrt(len(grams)) + model.bias
        assert np.allclose(p[i], L._softmax(score[None] / model.temperature)[0], atol=1e-6)
    covered = np.zeros(len(doc.hash), dtype=bool)
    for i in np.flatnonzero(of == 1):
        covered[lo[i]:hi[i]] = True
    assert covered.all() and (of == 0).sum() == 0 and (of == 2).sum() == 1


@pytest.mark.parametrize("n", [0, 10, 50, 100, 200, 400])
def test_notices_inside_long_lines(model, prose, n):
    words = " ".join(prose[0].split() + prose[1].split() + prose[2].split()).split()
    for family, notice in NOTICES.items():
        line = " ".join([*words[:n // 2], notice, *words[n // 2:n]])
        assert confirmed(model, line) == {family}, (family, n)
        assert confirmed(model, line.upper()) == {family}


def test_several_families_wrapped_notices_and_unknown_licences(model):
    assert confirmed(model, "This may be used, at your option, under the MIT License. It is also licensed under the Apache License, Version 2.0, as you like.") == {"mit", "apache"}
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    assert confirmed(model, bsd) == {"bsd"}
    gpl = ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License.")
    assert confirmed(model, gpl) == {"gpl"}
    for unknown in ("This program is made available under the terms of the Eclipse Public License v 2.0.",
                    "This software is proprietary; permission to use, copy or modify it is not granted.", "All rights reserved. No part may be copied without permission.",
                    "The general public was under the impression that a license of this kind was free."):
        assert confirmed(model, unknown) == set(), unknown


def test_clean_documents_hold_none(model, prose):
    assert sum(bool(confirmed(model, t)) for t in prose) == 0 and len(prose) > 20


def test_planted_notices(spark, prose):
    rows, want = [(i, t) for i, t in enumerate(prose)], {}
    for k, (family, notice) in enumerate(NOTICES.items()):
        i = len(rows)
        rows += [(i, prose[k] + "\n\n" + notice + "\nmore text"), (i + 1, notice.upper() + "!!")]
        want[i] = want[i + 1] = {family}
    i = len(rows)
    rows += [(i, None), (i + 1, ""), (i + 2, "\n \n"), (i + 3, "word " * 50000 + "\n" + NOTICES["mit"]), (None, NOTICES["cc"]), (0, prose[0])]
    want[i + 3], want[None] = {"mit"}, {"cc"}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit("clash")).withColumn("paragraph", F.lit(0.5))
    got = {}
    for r in L.scan(df).where("confirmed").collect():
        got.setdefault(r.doc_id, set()).add(r.family)
        assert 0.5 <= r.probability <= 1 and r.similarity >= L.MIN_TEMPLATE
    assert got == want


def test_given_notices_are_found(spark):
    docs = docs_of(spark)
    got = {(r.doc_id, r.family) for r in L.scan(docs).where("confirmed").select("doc_id", "family").collect()}
    pattern = {"mit": "under the mit license", "apache": "under the apache license", "gpl": "gnu general public license", "cc": "under cc by"}
    flat = F.regexp_replace(F.lower("text"), r"\s+", " ")
    want = {(r.doc_id, f) for f, p in pattern.items() for r in docs.where(flat.contains(p)).select("doc_id").collect()}
    assert want and got == want


def test_empty(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
