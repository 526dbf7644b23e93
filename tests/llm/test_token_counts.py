"""Sections against token spans found by decoding every prefix; the three rules against a loop."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.llm.token_counts import TOKENIZER, allocate, section_tokens, tokenizer

TEXTS = [None, "", "\n", "\n\n\n", "one line", "two\nlines", "a\n\n\nb\n", "  x \n \n\t y\r\nz", "é日本🙂\nмир\n🙂", "x" * 3000 + "\n" + "ab" * 2000,
         "word " * 30000 + "\n\n end", "tab\t\n   \n   indented"]


def brute(text, rule):
    """Per line: (start, end, tokens); a token's span by the lengths of the decoded bytes before it."""
    encoding, _ = tokenizer(TOKENIZER)
    data = (text or "").encode()
    spans, at = [], 0
    for token in encoding.decode_tokens_bytes(encoding.encode_ordinary(text or "")):
        spans.append((at, at + len(token)))
        at += len(token)
    assert at == len(data)
    cuts = [0, *[i + 1 for i, c in enumerate(data) if c == 10], len(data)]
    sections = list(zip(cuts, cuts[1:]))
    counts = [Fraction(0)] * len(sections)
    k = 0
    for s, e in spans:
        while sections[k][1] <= s:
            k += 1
        inside = []
        for j in range(k, len(sections)):
            if sections[j][0] >= e:
                break
            inside.append(max(0, min(e, sections[j][1]) - max(s, sections[j][0])))
        if rule == "split":
            for j, n in enumerate(inside):
                counts[k + j] += Fraction(n, e - s)
        else:
            counts[k + (inside.index(max(inside)) if rule == "most" else 0)] += 1
    chars = [len(data[:c].decode()) for c in cuts]
    return [(a, b, float(n)) for a, b, n in zip(chars, chars[1:], counts)], len(spans)


@pytest.mark.parametrize("rule", ["most", "start", "split"])
def test_matches_brute_force(spark, rule):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "x\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("section", F.lit("clash")).withColumn("start", F.lit(1))
    want = []
    for i, t in rows:
        sections, n = brute(t, rule)
        want += [(i, k, s, e, c, n) for k, (s, e, c) in enumerate(sections)]
    got = [tuple(r) for r in section_tokens(docs, rule=rule).collect()]
    key = lambda r: [str(x) for x in r[:4]]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and g[5] == w[5] and abs(g[4] - w[4]) < 1e-9


def test_sections_sum_to_the_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = section_tokens(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("doc_tokens").alias("d"), F.max("end").alias("e"))
    rows = got.join(docs.select("doc_id", F.length("text").alias("l")), "doc_id").collect()
    assert len(rows) == docs.count() and all(r.n == r.d and r.e == r.l for r in rows)


def test_ties_go_to_the_earliest():
    assert allocate(np.array([0, 4]), np.array([0, 2, 4]), "most").tolist() == [1, 0]
    assert allocate(np.array([0, 5]), np.array([0, 2, 2, 5]), "most").tolist() == [0, 0, 1]


def test_empty_and_bad_rule(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert section_tokens(none).count() == 0
    with pytest.raises(ValueError):
        section_tokens(none, rule="other")
