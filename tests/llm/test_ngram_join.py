"""Near duplicates against brute force: every pair of texts, exact shingle sets."""

import random

import pytest
from pyspark.sql import functions as F

from curata.llm.ngram_join import keep_one, least_matches, near_duplicates


def shingles(text, n=5):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, t=0.8):
    """(doc_id, class_id, n_copies, n_links) of every row."""
    texts = sorted({r[1] or "" for r in rows})
    sets = [shingles(x) for x in texts]
    links = {x: set() for x in range(len(texts))}
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    group = {}
    for a in links:
        if a not in group:
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = a
                    todo += links[x]
    ids, at = {}, {x: i for i, x in enumerate(texts)}
    for d, x in rows:
        if d is not None:
            g = group[at[x or ""]]
            ids[g] = min(ids.get(g, d), d)
    n = [sum((r[1] or "") == x for r in rows) for x in texts]
    return sorted(((d, ids.get(group[at[x or ""]]), n[at[x or ""]], len(links[at[x or ""]])) for d, x in rows), key=str)


def made(seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, k = [], 0
    for _ in range(12):
        base = r.choices(vocabulary, k=r.randint(60, 200))
        for _ in range(r.choice([1, 2, 5])):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append((k, " ".join(w)))
            k += 1
    # one large group of near copies: each differs from the base in one word
    base = r.choices(vocabulary, k=120)
    for n in range(90):
        w = list(base)
        w[r.randrange(len(w))] = f"x{n}"
        rows.append((k, "\n".join(w)))
        k += 1
    rows += [(k, rows[0][1]), (k + 1, rows[0][1]), (k + 1, rows[0][1]), (None, "just one"), (k + 2, "just one"), (k + 3, ""), (k + 4, None),
             (k + 5, "a b c d e"), (k + 6, " a b\tc d e "), (k + 7, "long " * 30000)]
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_matches_brute_force(spark, block):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash")).withColumn("digest", F.lit(1))
    got = sorted((tuple(r) for r in near_duplicates(docs, block=block).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("cell_bytes", [4 << 20, 20_000])
def test_keep_one(spark, cell_bytes):
    rows = made(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["digest", "_digest", "_first", "_n", "row", "own_id", "first_id", "n_copies", "best_digest", "a b"]
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in clash])
    kept = keep_one(docs, cell_bytes=cell_bytes)
    assert kept.columns == ["doc_id", "text", *clash]
    classes = [x[1] for x in brute(rows)]
    got = kept.collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(set(classes), key=str)
    assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in clash if r.doc_id is not None)


def test_classes_equal_groups_when_the_representative_links_to_few(spark):
    """Chains: each text is near the next one only, so most links are not with a bucket's smallest text."""
    r = random.Random(4)
    rows, k = [], 0
    for _ in range(4):
        w = r.choices([f"w{i}" for i in range(500)], k=150)
        for _ in range(25):
            for _ in range(2):
                w[r.randrange(len(w))] = f"n{k}"
            rows.append((k, " ".join(w)))
            k += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted({c[1] for c in brute(rows)})
    for cell_bytes in (4 << 20, 9_000):
        assert sorted(x.doc_id for x in keep_one(docs, cell_bytes=cell_bytes).collect()) == want


def test_equal_rows_but_for_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "z"), (1, "a b c d e f", "y"), (2, "a b c d e f", "x")], "doc_id long, text string, digest string")
    assert [tuple(x) for x in keep_one(docs).collect()] == [(1, "a b c d e f", "y")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0


def test_prune_table_keeps_likely_pairs():
    keep = least_matches(0.8, 1e-6, 160)
    assert list(keep) == list(range(16, 161, 16))
    assert all(m < 0.8 * n for n, m in keep.items()) and keep[160] > 80
