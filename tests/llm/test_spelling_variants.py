"""Spelling variants against brute force: the scan over all pairs, and the whole operator with shards of a few words."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from curata.llm import spelling_variants as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("seed", range(12))
def test_scan_finds_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(S, "JUMP_DEPTH", [48, 3][seed % 2])
    monkeypatch.setattr(S, "QUERY_CELLS", [1 << 20, 40][seed % 3 == 0])
    rng = random.Random(seed)
    words = sorted({bytes(rng.choice([b"ab\xc3", b"abcdefgh"][seed % 2]) for _ in range(rng.randint(2, [9, 60][seed % 4 == 0]))) for _ in range(150)})
    words = sorted({*words, *(w[:-1] for w in words if len(w) > 2)})
    fixed = np.array([S._fixed(len(w), 0) for w in words])
    got = sorted((words[a], words[b]) for x, y, z in S.SortedList(words).near(words, fixed) for a, b, same in zip(x, y, z) if same)
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b) and shared(a, b) >= min(len(a), len(b)) // 2)


def test_shards_that_may_hold_a_near_word():
    rng = random.Random(2)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    for a in words:
        for b in words:
            if a == b or one_edit(a, b):
                assert all(S.may_follow(a, b[:k]) for k in range(len(b) + 1))
    assert not S.may_follow(b"thing", b"theab") and not S.may_follow(b"ab", b"abcd")


def expected(rows, misspelt=97):
    n = Counter()
    for d, text in rows:
        for run in S.RUN.findall((text or "").encode("latin-1", "replace").lower()):
            run = run.decode("latin-1")
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            if h % misspelt == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def result(spark, rows, schema="doc_id long, text string", **more):
    got = S.group_variants(spark.createDataFrame(rows, schema), **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("shard_words", [30_000, 7])
def test_against_brute_force(spark, shard_words, monkeypatch):
    rng = random.Random(shard_words)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    rows = [(k % 17 if k % 13 else None, " ".join(rng.choice(base).capitalize() if rng.random() < 0.3 else rng.choice(base) for _ in range(60))) for k in range(40)]
    rows += [(k, None if k % 2 else "") for k in range(5)] + [(1, "x" * 3000 + " " + "x" * 2999 + " " + "y" * 40)] * 4 + [(2, "\u00c0bcdef \u00e0bcdef ab\u00d7cde")] * 3
    assert result(spark, rows, shard_words=shard_words, misspelt=5) == expected(rows, 5)


def test_chains_ties_and_clashing_columns(spark):
    counts = {"aaaaaa": 64, "aaaaab": 32, "aaaabb": 16, "aaabbb": 8, "aabbbb": 4, "zzzzz": 3, "zzzzy": 6, "zzzzx": 6, "qqqqq": 3, "qqqqqq": 5}
    rows = [(k, f"{w} ", 1, "w") for w, n in counts.items() for k in range(1000, 1000 + n)]
    got = {r[0]: r[1:3] for r in result(spark, rows, "doc_id long, text string, n int, best string", misspelt=0)}
    assert got["aabbbb"] == ("aaabbb", "aaaaaa") and got["aaaaaa"] == (None, "aaaaaa")
    assert got["zzzzz"] == ("zzzzx", "zzzzx") and got["zzzzy"] == (None, "zzzzy") and got["qqqqq"] == (None, "qqqqq")


def test_texts_longer_than_a_part(spark, monkeypatch):
    rows = [(k, "abcde vwxyz " * 50) for k in range(3)]
    parts = S.TEXT_PART
    try:
        S.TEXT_PART = 7
        assert result(spark, rows) == expected(rows)
    finally:
        S.TEXT_PART = parts


def test_empty_table(spark):
    assert result(spark, []) == []
