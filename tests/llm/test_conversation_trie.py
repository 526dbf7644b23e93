"""Conversation trie against a plain dictionary of prefixes, with segments and shards so small that every kind of seam occurs."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from curata.llm import conversation_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            key = hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, key, r, t))
    convs = {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def walk(p):
        saved, leaves = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0, 0
        for q in children.get(p, []):
            s, n = walk(q)
            saved, leaves = saved + s, leaves + n
        leaves = leaves or 1
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
        return saved, leaves

    if members:
        walk(())
    return sorted(out, key=str)


def result(spark, rows, **sizes):
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = T.prefix_trie(T.spliced(T.numbered(turns)), **sizes)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 2, 3, longest])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, held", [(2, 400_000), (2, 3), (64, 5)])
def test_against_brute_force(spark, segment, held):
    rows = conversations(segment * 7 + held, 60, 9) + [(200 + k, t, "user", "same") for k in range(40) for t in range(5)]
    assert result(spark, rows, segment=segment, held_turns=held) == brute(rebuilt(rows))


def test_copies_of_long_conversations(spark):
    rows = [(c, t, "user", str(t)) for c in (5, 10, 15, 20) for t in range(12)] + [(25, t, "user", str(t)) for t in range(6)]
    assert result(spark, rows, segment=3, held_turns=4) == brute(rebuilt(rows))


def test_nulls_repeats_and_one_conversation(spark):
    rows = [(5, None, None, None), (5, 1, "u", "x"), (5, 1, "u", "x"), (None, 1, "u", "x"), (-4, 1, "", ""), (7, 2, "u", "y" * 5000)]
    assert result(spark, rows) == brute(rebuilt(rows))
    assert result(spark, [(5, 1, "u", "x")]) == brute(rebuilt([(5, 1, "u", "x")]))


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("seed", range(5))
def test_parentheses(seed):
    rng = np.random.default_rng(seed)
    parent = [-1]
    for k in range(1, 1500):                        # some deep, some broad
        parent.append(int(rng.integers(max(0, k - 3), k)) if seed % 2 else int(rng.integers(0, k)))
    kids = {}
    for k, p in enumerate(parent):
        kids.setdefault(p, []).append(k)
    bits, order, above, size = [], [], [], {}

    stack = [(0, -1, False)]
    while stack:
        node, up, closing = stack.pop()
        if closing:
            bits.append(0)
            size[node] = len(order) - order.index(node)
            continue
        bits.append(1)
        above.append(up)
        order.append(node)
        me = len(order) - 1
        stack.append((node, up, True))
        stack.extend((c, me, False) for c in reversed(kids.get(node, [])))
    tree = T.Parens(np.array(bits, dtype=np.int8))
    assert tree.parents().tolist() == above
    assert tree.sizes().tolist() == [size[n] for n in order]
    assert tree.leaf.tolist() == [n not in kids for n in order]


def test_first_below_ranges():
    values = np.cumsum(np.random.default_rng(3).choice([-1, 1], 20_000)).astype(np.int32)
    place = np.arange(0, 15_000, 7)
    goal = values[place] - 1
    ok = [k for k, (p, g) in enumerate(zip(place, goal)) if (values[p + 1:] <= g).any()]
    got = T.FirstBelow(values).after(place[ok], goal[ok])
    assert got.tolist() == [int(p + 1 + np.argmax(values[p + 1:] <= g)) for p, g in zip(place[ok], goal[ok])]
