"""Licence families of paragraphs by a trained classifier, confirmed by templates (operator 8).

Paragraphs are separated by blank lines, so a notice may be wrapped over
lines. A softmax (logistic) regression over hashed word 1- and 2-grams is
applied to overlapping windows (of 24 and of 8 words) of every whole paragraph,
so a notice is found wherever it stands, and a paragraph may hold several
families:

* training windows: every template's wordings (written out from small parts
  by rule) with words of the corpus around them, labelled with their family;
  notices of licences that are no family (``OTHER``), labelled ``other``; and
  a bounded sample of the corpus' own paragraphs, labelled ``none``. The
  sample are the ``SAMPLE_PARAGRAPHS`` paragraphs with the smallest hashes
  among those of the ``SAMPLE_DOCS`` documents with the smallest hashed ids, of
  each the first ``SAMPLE_CHARS`` characters; only the training sees a
  sample, every paragraph is scored whole;
* the probabilities are calibrated by a temperature chosen on held-out
  windows; the least probability that reports a family is chosen so that
  ``UNKNOWN_ERROR`` of the windows of licences the training has never seen
  (``UNSEEN``) reach it at most. Windows under it are of unknown class;
* a predicted window, with the words around it, is compared with its family's
  templates: the largest share of a wording's word 2-grams in it.
  ``confirmed`` needs ``MIN_TEMPLATE`` of them and the wording's own name.

The weights are one small array, broadcast; texts are scored in place,
vectorised over a slice's words.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curata.llm.hashing import Words, mix, text_slices

FEATURES = 1 << 15
SAMPLE_DOCS = 400          # documents whose paragraphs serve as examples of "none"
SAMPLE_PARAGRAPHS = 3000   # at most so many of them
SAMPLE_CHARS = 2000        # the characters of one that are used
WINDOWS = ((24, 6), (8, 2))    # words of a window, and between the begins of two; the short ones tell notices apart that stand close together
WINDOW = 24
SHORT_NOTICE = 12          # words up to which a wording is also learnt from short windows
LEAST_PROBABILITIES = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98)
UNKNOWN_ERROR = 0.02
MIN_TEMPLATE = 0.6
STEPS = 120

#: How the licences name themselves in short notices, by family. Bracketed words vary (see ``wordings``).
TEMPLATES = {
    "mit": ["[released|licensed|distributed|available] under the [terms of the|] mit license", "this project uses the mit license", "spdx license identifier mit",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
            "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"],
    "apache": ["licensed under the apache license version 2 0", "[released|distributed|available] under the apache [2 0|] license", "spdx license identifier apache 2 0",
               "you may not use this file except in compliance with the license you may obtain a copy of the license at",
               "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"],
    "gpl": ["this [work|program|software] is licensed under the gnu general public license version [2|3]", "[released|distributed] under the gnu [gpl|lgpl|agpl] [v2|v3]",
            "spdx license identifier [gpl|lgpl|agpl] [2|3] 0 or later",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
            "you should have received a copy of the gnu [lesser|affero|general] public license along with this program"],
    "cc": ["[licensed|released|shared] under cc by [nc|sa|nd] [3|4] 0", "[licensed|released|shared] under cc by [3|4] 0",
           "this work is licensed under a creative commons attribution [noncommercial|sharealike|noderivatives] [3|4] 0 international license",
           "licensed under cc by [nc sa|nc nd] [3|4] 0", "[released|dedicated] to the public domain under cc0 1 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
            "[released|licensed|distributed] under the bsd [2|3] clause license", "[released|licensed|distributed] under the bsd license", "spdx license identifier bsd [2|3] clause",
            "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0", "[released|licensed] under the mozilla public license version 2 0",
            "spdx license identifier mpl 2 0"],
    "isc": ["[released|licensed|distributed] under the isc license",
            "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "[released|licensed] under the unlicense"],
    "zlib": ["[released|licensed|distributed] under the zlib license",
             "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"],
}
#: What a wording must share besides its 2-grams, if it has it.
NAMES = frozenset("mit apache gnu gpl lgpl agpl cc creative cc0 bsd mozilla mpl isc unlicense zlib".split())
#: Notices of licences that are no family: for the training, and (never trained on) for the calibration.
OTHER = ["[released|licensed|distributed] under the [eclipse|european union|academic free|common development and distribution] public license version [1|2] 0",
         "this software is proprietary all rights reserved and no part of it may be copied without permission",
         "permission to copy or distribute this software is not granted without a written agreement", "use of this software is governed by the [commercial|enterprise|evaluation] license agreement",
         "[released|licensed] under the artistic license 2 0", "by installing this product you accept the terms of the end user license agreement",
         "the accompanying materials are made available under the terms of the [eclipse|common] public license v 1 0", "this license does not grant permission to use the trade names",
         "source available license for non production use only", "licensed under the [boost|python|ruby|open] software license"]
UNSEEN = ["this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0",
          "this software is proprietary and confidential permission to use copy or modify it is not granted", "licensed under the microsoft public license",
          "[released|distributed] under the server side public license version 1", "you may use this software only under a commercial license from the vendor",
          "licensed under the open font license version 1 1", "released under the do what you want public license", "licensed under the business source license 1 1",
          "copies of this document may not be distributed without prior written consent", "this work is under the common public attribution license version 1 0"]
FAMILIES = ["none", *TEMPLATES, "other"]
_BLANK_LINES = re.compile(r"\n[^\S\n]*\n\s*")


def wordings(template: str) -> list[str]:
    """All readings of a template's bracketed choices."""
    parts = [p.split("|") for p in template.replace("]", "[").split("[")]
    return list(dict.fromkeys(" ".join("".join(x).split()) for x in itertools.product(*parts)))


def paragraphs(text: str) -> list[str]:
    """A text's paragraphs: what stands between blank lines."""
    return [p for p in _BLANK_LINES.split(text) if p.strip()]


class Grams:
    """Hashed word 1- and 2-grams of texts; gram 2i is word i alone, 2i + 1 the pair of it and the next word."""

    def __init__(self, doc: Words):
        two = np.zeros(len(doc.hash), dtype=np.uint64)
        if len(doc.hash):
            two[:-1] = mix(doc.hash[:-1] * np.uint64(31) + doc.hash[1:])
        self.at = np.column_stack((doc.hash, two)).ravel() % np.uint64(FEATURES)
        self.first = doc.first

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, first word, word behind the last)`` of every window; the last one of a text ends it, and a short text is one window."""
        n = np.diff(self.first)
        out = []
        for size, stride in WINDOWS:
            count = np.where(n > (size if out else 0), 1 + np.maximum(0, -(-(n - size) // stride)), 0)
            text = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            lo = np.minimum(k * stride, np.maximum(n[text] - size, 0)) + self.first[:-1][text]
            out.append((text, lo, np.minimum(lo + size, self.first[1:][text])))
        return tuple(np.concatenate(x) for x in zip(*out))


class Model:
    """Softmax regression over hashed grams; a window's features are its grams, weighted 1 / sqrt(number of grams)."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0, least: float = LEAST_PROBABILITIES[0]):
        self.weights, self.bias, self.temperature, self.least = weights, bias, temperature, least

    def scores(self, grams: Grams, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of the windows from word ``lo`` to ``hi``: prefix sums over the grams, so that overlapping windows cost a difference each."""
        total = np.zeros((len(grams.at) + 1, len(self.bias)))
        np.cumsum(self.weights[grams.at.astype(np.int64)], axis=0, out=total[1:])
        end = 2 * hi - 1                       # the pair that begins with the last word isn't inside
        return (total[end] - total[2 * lo]) / np.sqrt(end - 2 * lo)[:, None] + self.bias

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, first word, word behind the last, probabilities)`` of all windows of ``texts``; words count from each text's first."""
        grams = Grams(Words(texts, plain=True))
        text, lo, hi = grams.windows()
        p = _softmax(self.scores(grams, lo, hi) / self.temperature) if len(text) else np.zeros((0, len(self.bias)))
        return text, lo - grams.first[text], hi - grams.first[text], p


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: np.ndarray, unseen: list[str], steps: int = STEPS, rate: float = 30.0, decay: float = 1e-4) -> Model:
    """Gradient steps with momentum over all rows (windows of ``WINDOW`` words at most), classes weighted alike.

    Every fifth row is held out to choose the temperature; ``unseen`` windows
    are of unknown licences and choose the least probability.
    """
    held = np.arange(len(texts)) % 5 == 4
    fit = [t for t, h in zip(texts, held) if not h]
    y = labels[~held]
    grams = Grams(Words(fit, plain=True))
    n_words = np.diff(grams.first)
    keep = np.arange(2 * grams.first[-1]) != np.repeat(2 * grams.first[1:] - 1, 2 * n_words)      # without the pair behind a text's last word
    row, at = np.repeat(np.arange(len(fit)), 2 * n_words)[keep], grams.at.astype(np.int64)[keep]
    value = (1 / np.sqrt(np.maximum(2 * n_words - 1, 1)))[row]
    used, place = np.unique(at, return_inverse=True)
    by_row = np.searchsorted(row, np.arange(len(fit)))
    order = np.argsort(place, kind="stable")
    by_place = np.searchsorted(place[order], np.arange(len(used)))
    empty = np.bincount(row, minlength=len(fit)) == 0
    k = len(FAMILIES)
    share = np.bincount(y, minlength=k)
    weight = (1 / np.maximum(share, 1))[y]
    weight /= weight.sum()
    target = np.eye(k)[y]
    w, b = np.zeros((len(used), k)), np.zeros(k)
    dw, db = np.zeros_like(w), np.zeros_like(b)
    by_row = np.minimum(by_row, max(len(row) - 1, 0))
    for _ in range(steps):
        score = np.add.reduceat(w[place] * value[:, None], by_row, axis=0)
        score[empty] = 0
        error = (_softmax(score + b) - target) * weight[:, None]
        grad = np.add.reduceat((value[:, None] * error[row])[order], by_place, axis=0)
        dw = 0.9 * dw - rate * (grad + decay * w)
        db = 0.9 * db - 0.1 * rate * error.sum(axis=0)
        w, b = w + dw, b + db
    weights = np.zeros((FEATURES, k), dtype=np.float32)
    weights[used] = w
    model = Model(weights, b)
    rest, truth = [t for t, h in zip(texts, held) if h], labels[held]
    logits = _scores(model, rest)
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(rest)), truth] + 1e-12).mean() for t in (0.3, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0)}
    model.temperature = min(loss, key=loss.get)
    wrong = _softmax(_scores(model, unseen) / model.temperature)[:, 1:-1].max(axis=1)
    model.least = next((p for p in LEAST_PROBABILITIES if (wrong >= p).mean() <= UNKNOWN_ERROR), LEAST_PROBABILITIES[-1])
    return model


def _scores(model: Model, texts: list[str]) -> np.ndarray:
    """Of texts as they are, each one window."""
    grams = Grams(Words(texts, plain=True))
    out = np.tile(model.bias, (len(texts), 1)).astype(float)
    some = np.flatnonzero(np.diff(grams.first) > 0)
    if len(some):
        out[some] = model.scores(grams, grams.first[some], grams.first[some + 1])
    return out


class Templates:
    """The 2-grams of every wording, by family."""

    def __init__(self):
        self.of = {f: [(x, np.unique(_pairs(x)), NAMES.intersection(x.split())) for t in ts for x in wordings(t)] for f, ts in TEMPLATES.items()}

    def best(self, family: str, text: str) -> tuple[float, str | None]:
        """The largest share of a template wording's 2-grams that the text contains, and that wording; none without the wording's own name."""
        own = _pairs(text)
        words = set(re.findall(r"[^\W_]+", text.lower()))
        found = [(float(np.isin(grams, own).mean()), name) for name, grams, named in self.of[family] if named <= words]
        return max(found, default=(0.0, None))


def _pairs(text: str) -> np.ndarray:
    return Words([text], plain=True).shingles(2)[0]


def _around(wording: str, context: list[str], rng: np.random.Generator) -> list[str]:
    """Windows over a wording with words of the corpus around it that hold most of the wording (or of what a window can hold)."""
    words = wording.split()
    left, right = (context[rng.integers(0, len(context) - WINDOW):][:WINDOW] for _ in range(2))
    text = left + words + right
    out = [wording]
    for size, stride in WINDOWS if len(words) <= SHORT_NOTICE else WINDOWS[:1]:
        for lo in range(0, len(text) - size + 1, max(1, stride // 2)):
            inside = min(lo + size, len(left) + len(words)) - max(lo, len(left))
            if inside >= 0.9 * min(len(words), size):
                out.append(" ".join(text[lo:lo + size]))
    return out


def training_rows(docs: DataFrame, doc_id: str, text: str, sample_docs: int, sample_paragraphs: int) -> tuple[list[str], np.ndarray, list[str]]:
    """``(windows, labels, windows of unseen licences)``."""
    # the ids alone are ranked, so no task sends texts that another's outrank; then paragraphs are ranked by their hash
    ids = docs.select(F.col(doc_id).alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(sample_docs).distinct()
    cut = F.explode(F.split(F.col(text).cast("string"), r"\n[^\S\n]*\n\s*")).alias("p")
    rows = docs.join(F.broadcast(ids), docs[doc_id] == ids["id"], "left_semi").select(cut).where(F.col("p").rlike(r"\S")).distinct()
    rows = rows.orderBy(F.xxhash64("p"), "p").limit(sample_paragraphs).select(F.substring("p", 1, SAMPLE_CHARS).alias("p"))
    templates, rng = Templates(), np.random.default_rng(11)
    none, context = [], []
    for p in sorted(r.p for r in rows.collect()):
        words = re.findall(r"[^\W_]+", p.lower())
        if not re.search(r"licen[sc]|warrant|copyright|public domain|\bcc.by\b", p, re.I) and max(templates.best(f, p)[0] for f in TEMPLATES) < 0.3:
            context += words
            at = int(rng.integers(0, max(1, len(words) - WINDOW + 1)))
            none.append(" ".join(words[at:at + (WINDOW if len(none) % 3 else 8)]))
    context = (context or ["word"]) * (1 + 4 * WINDOW // max(len(context), 1))
    none += ["", "the license plate of the car", "under the bridge", "public notice", "version 2 0 of the report", "all rights reserved", "copyright 2020 the authors",
             "see the file for details", "the text below is", "the general public was under the impression", "a driving license is required", "the software is free"]
    texts, labels = list(none), [0] * len(none)
    for k, family in enumerate(FAMILIES[1:], 1):
        own = [w for t in (OTHER if family == "other" else TEMPLATES[family]) for x in wordings(t) for _ in range(6) for w in _around(x, context, rng)]
        texts += own
        labels += [k] * len(own)
    unseen = [w for t in UNSEEN for x in wordings(t) for _ in range(4) for w in _around(x, context, rng)]
    order = rng.permutation(len(texts))
    return [texts[i] for i in order], np.array(labels)[order], unseen


def find(model: Model, templates: Templates, texts: list[str], min_template: float) -> list[tuple]:
    """``(paragraph of texts, family, probability, template, similarity, confirmed)`` for every family found in a paragraph.

    The window of the highest probability speaks for a family; the template
    is looked for in it and ``WINDOW`` words to both sides, in lines joined.
    """
    text, lo, hi, p = model.probabilities(texts)
    best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=int)
    sure = np.flatnonzero((best > 0) & (best < len(FAMILIES) - 1) & (p.max(axis=1, initial=0) >= model.least))
    top: dict[tuple[int, int], int] = {}
    for i in sure:
        key = (int(text[i]), int(best[i]))
        if key not in top or p[i, best[i]] > p[top[key], best[i]]:
            top[key] = int(i)
    out, words_of = [], {}
    for (k, family), i in sorted(top.items()):
        if k not in words_of:
            doc = Words([texts[k]], plain=True)
            words_of[k] = (doc.start, doc.end, bytes(doc.data))
        start, end, data = words_of[k]
        a, z = max(0, int(lo[i]) - WINDOW), min(len(start), int(hi[i]) + WINDOW)
        region = " ".join(data[s:e].decode("utf-8", "replace") for s, e in zip(start[a:z], end[a:z]))
        similarity, name = templates.best(FAMILIES[family], region)
        out.append((k, FAMILIES[family], round(float(p[i, family]), 6), name, round(similarity, 6), similarity >= min_template))
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_template: float = MIN_TEMPLATE,
         sample_docs: int = SAMPLE_DOCS, sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> DataFrame:
    """One row per paragraph and licence family found in it: doc_id, paragraph (from 0), family, probability, template, similarity, confirmed.

    ``template`` is null if no wording's own name stands near. Paragraphs of
    unknown class and documents without licence paragraphs give no row; so do null and empty texts. Repeated rows give repeated rows;
    other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(*training_rows(docs, doc_id, text, sample_docs, sample_paragraphs)))
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = src.select("doc_id", F.lit(0).cast("long").alias("paragraph"), F.lit("").alias("family"), F.lit(0.0).alias("probability"),
                        F.lit(None).cast("string").alias("template"), F.lit(0.0).alias("similarity"), F.lit(True).alias("confirmed")).schema
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        import pyarrow as pa

        templates = Templates()
        for b in batches:
            for lo, hi in text_slices(b.column(1), 1 << 20):
                place, texts = [], []
                for k, t in enumerate(b.column(1).slice(lo, hi - lo).to_pylist()):
                    own = paragraphs(t or "")
                    place += [(lo + k, n) for n in range(len(own))]
                    texts += own
                found = find(model.value, templates, texts, min_template) if texts else []
                if found:
                    rows = [(place[k][1], *rest) for k, *rest in found]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([place[f[0]][0] for f in found])), *(pa.array([r[j] for r in rows], kinds[j + 1]) for j in range(6))], schema.names)

    return src.mapInArrow(run, schema)
