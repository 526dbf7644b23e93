"""Planted benchmark passages against brute force over every window."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from curata.llm import decontaminate as D


def plain(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", (text or "").lower()).split()


def shingles(w, n=5):
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)])


def brute(docs, items, t=0.8):
    out = {}
    for d, text in docs:
        w = plain(text)
        for i, item in items:
            x = plain(item)
            if not x or not w:
                continue
            size = min(len(w), len(x))
            best = 0
            for s in range(len(w) - size + 1):
                a, b = shingles(w[s:s + size], min(5, len(x))), shingles(x, min(5, len(x)))
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= t - 1e-9:
                out[d, i] = round(best, 9)
    return out


def made():
    r = random.Random(4)
    word = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(word, k=n))) for i, n in enumerate([15, 22, 22, 37, 60, 60, 3, 5, 90])]
    items += [(20, items[0][1]), (21, None), (22, ""), (23, " ... "), (None, items[3][1].upper())]
    docs, k = [], 0
    for i, item in items[:9]:
        for change in (0, 1, 3, 12):
            w = item.split()
            for _ in range(change):
                w[r.randrange(len(w))] = r.choice(word)
            around = r.choices(word, k=r.randint(0, 300))
            docs.append((k, " ".join(around[:100]) + "\n" + "!! ".join(w).upper() + ", " + " ".join(around[100:])))
            k += 1
    docs += [(k + n, " ".join(r.choices(word, k=200))) for n in range(20)]
    docs += [(100, None), (101, ""), (102, items[4][1][:-9]), (103, items[4][1]), (103, items[4][1]), (None, items[1][1]),
             (104, "filler " * 50000 + items[8][1]), (105, " ".join([items[0][1]] * 4))]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute([x for x in docs if x[0] != 104], items)
    for block in (20000, 3):
        rows = D.find_leaks(d, b, block_items=block).collect()
        got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows if r.doc_id != 104}
        assert got == want
        assert sum(r.doc_id == 103 for r in rows) == 2 * len({i for x, i in want if x == 103})
        assert (104, 8) in {(r.doc_id, r.item_id) for r in rows}
    kept = D.drop_leaks(d, b)
    assert kept.columns == d.columns
    leaked = {x for x, _ in want} | {104}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((x for x, _ in docs if x not in leaked), key=str)


def test_index_finds_all_within_radius():
    r = np.random.default_rng(3)
    index = D.ItemIndex([(i, " ".join(f"x{v}" for v in r.integers(0, 1000, 30))) for i in range(300)])
    prints = []
    for i in range(300):
        bits = np.unpackbits(index.prints[i].view(np.uint8))
        flip = r.choice(128, r.integers(0, D.RADIUS + 8), replace=False)
        bits[flip] ^= 1
        prints.append(np.packbits(bits).view(np.uint16))
    prints = np.array(prints)
    distance = np.unpackbits((prints[:, None] ^ index.prints[None]).view(np.uint8), axis=2).sum(axis=2)
    assert sorted((w, i) for w, i, _ in index.near(prints)) == sorted(zip(*map(list, np.nonzero(distance <= D.RADIUS))))


def test_empty_tables(spark):
    docs, items = made()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert D.find_leaks(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    d = spark.createDataFrame(docs, "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(d, no_items).count() == 0 and D.drop_leaks(d, no_items).count() == len(docs)
