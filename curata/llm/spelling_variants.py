"""Grouping of spelling variants by one edit, sorted-list dynamic programming (operator 13).

Words one insertion, deletion or replacement apart are found by scanning the
sorted vocabulary with the rows of the edit matrix of a query word: a band of
three cells a row holds every value up to one edit. The rows up to the prefix
that the next word shares with the last one stay as they are; where a row
exceeds one edit, all words with that prefix are skipped. A row is one of 27
codes, so numpy advances thousands of query words a step by table lookup.

An edit lies in one half of the shorter word, so every pair either shares the
first half or is found by the same scan over reversed words. Both lists are
range-partitioned into shards; a query goes to the shards that overlap the
range of its own first half and whose common prefix is still within one edit.
Pairs are counted where they are found: only a count and the best partner of
each word leave a task.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.hashing import text_slices
from curata.operators.joins import join_on_keys
from curata.session import checkpoint_dir

MIN_LENGTH, MIN_COUNT = 5, 3        # of a vocabulary word
FORM_TIMES = 2                      # a form has so many times the word's occurrences
SHARD_WORDS = 30_000                # aimed at: vocabulary words of a shard
HELD_WORDS = 200_000                # distinct words that a counting task holds
TEXT_PART = 4 << 20                 # characters of a text that are split into words at a time
QUERY_CELLS = 2 << 20               # rows of all queries that are scanned together
JUMP_DEPTH = 48                     # prefixes up to here have their skips in a table

#: Runs of letters; in Latin-1 each code point of the class is one byte, and all else is not in it.
RUN = re.compile(rb"[a-z\xc0-\xff]+")


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """``(next row, cells)``: rows are codes 9a + 3b + c of the cells left of, on and right of the diagonal, capped at 2.

    The next row depends on whether the new character equals the query's
    characters before, on and after the diagonal (bits 1, 2 and 4).
    """
    cells = np.array([(x // 9, x // 3 % 3, x % 3) for x in range(27)], dtype=np.uint8)
    after = np.zeros((27, 8), dtype=np.uint8)
    for x, (a, b, c) in enumerate(cells.tolist()):
        for m in range(8):
            left = min(2, a + 1 - (m & 1), b + 1)
            mid = min(2, b + 1 - (m >> 1 & 1), c + 1, left + 1)
            right = min(2, c + 1 - (m >> 2 & 1), mid + 1)
            after[x, m] = 9 * left + 3 * mid + right
    return after, cells


NEXT, CELLS = _transitions()
SAME, DEAD = 9 * 1 + 0 + 1, 26      # the row behind equal prefixes; a row without a cell up to one edit


class SortedList:
    """A sorted list of distinct byte strings with the prefixes that neighbours share."""

    def __init__(self, words: list[bytes]):
        self.words, n = words, len(words)
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        self.at = np.cumsum(self.size) - self.size
        self.shared = np.zeros(n + 1, dtype=np.int64)               # with the word before; nothing behind the last
        on, j = np.arange(1, n), 0
        while len(on):
            on = on[(self.size[on] > j) & (self.size[on - 1] > j)]
            on = on[self.flat[self.at[on] + j] == self.flat[self.at[on - 1] + j]]
            j += 1
            self.shared[on] = j
        # jump[d, i]: the first word behind i that doesn't share d characters with it
        depth = min(int(self.size.max(initial=0)), JUMP_DEPTH)
        self.jump = np.empty((depth + 1, n), dtype=np.int32)
        for d in range(depth + 1):
            stop = np.where(self.shared[1:] < d, np.arange(1, n + 1), n)
            self.jump[d] = np.minimum.accumulate(stop[::-1])[::-1]

    def skip(self, i: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first word behind each ``i`` that doesn't share ``depth`` characters with it."""
        out = self.jump[np.minimum(depth, len(self.jump) - 1), i].astype(np.int64)
        deep = np.flatnonzero(depth >= len(self.jump))
        out[deep] = i[deep] + 1
        while len(deep):                                             # prefixes beyond the table: word by word
            deep = deep[self.shared[out[deep]] >= depth[deep]]
            out[deep] += 1
        return out

    def near(self, queries: list[bytes], fixed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of ``(query, word, same)``: all pairs exactly one edit apart whose first ``fixed`` characters are equal.

        ``same``: whether they share the first half of the shorter one.
        """
        size = np.array([len(q) for q in queries], dtype=np.int64)
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):
            longest = lambda hi: int(size[order[hi - 1]]) + 4
            hi = lo + max(1, QUERY_CELLS // longest(lo + 1))
            hi = min(len(order), hi)
            while hi > lo + 1 and (hi - lo) * longest(hi) > 2 * QUERY_CELLS:
                hi = lo + max(1, (hi - lo) // 2)
            yield from self._scan([queries[k] for k in order[lo:hi]], order[lo:hi], size[order[lo:hi]], fixed[order[lo:hi]], longest(hi))
            lo = hi

    def _scan(self, queries, number, size, fixed, width):
        char = np.zeros((len(queries), width), dtype=np.uint8)
        for k, q in enumerate(queries):
            char[k, :len(q)] = np.frombuffer(q, dtype=np.uint8)
        char = char.ravel()
        row = np.zeros(len(queries) * width, dtype=np.uint8)         # row[q, d]: the edit matrix behind d characters
        base = np.arange(len(queries)) * width
        first = np.array([bisect_left(self.words, q[:f]) for q, f in zip(queries, fixed.tolist())], dtype=np.int64)
        inside = [i < len(self.words) and self.words[i].startswith(q[:f]) for i, q, f in zip(first.tolist(), queries, fixed.tolist())]
        for d in range(width):                                       # rows of equal prefixes, which the half test reads
            row[base[fixed >= d] + d] = SAME
        q = np.flatnonzero(inside)
        i, d = first[q], fixed[q].copy()
        while len(q):
            end = d >= self.size[i]
            k = np.flatnonzero(end)
            nxt = i + 1
            if len(k):
                gap = size[q[k]] - self.size[i[k]] + 1
                hit = k[(gap >= 0) & (gap <= 2)]
                gap = size[q[hit]] - self.size[i[hit]] + 1
                hit = hit[CELLS[row[base[q[hit]] + d[hit]], gap] == 1]
                if len(hit):
                    half = np.minimum(size[q[hit]], self.size[i[hit]]) // 2
                    yield number[q[hit]], i[hit], CELLS[row[base[q[hit]] + half], 1] == 0
            k = np.flatnonzero(~end)
            place = base[q[k]] + d[k]
            c = self.flat[self.at[i[k]] + d[k]]
            m = (c == char[place - 1]) * np.uint8(1) + (c == char[place]) * np.uint8(2) + (c == char[place + 1]) * np.uint8(4)
            code = NEXT[row[place], m]
            row[place + 1] = code
            d[k] += 1
            dead = k[code == DEAD]
            nxt[dead] = self.skip(i[dead], d[dead])
            move = end
            move[dead] = True
            i = np.where(move, nxt, i)
            d = np.where(move, self.shared[i], d)
            on = (i < len(self.words)) & (d >= fixed[q])
            if not on.all():
                q, i, d = q[on], i[on], d[on]


def may_follow(query: bytes, prefix: bytes) -> bool:
    """Whether a word that begins with ``prefix`` can be within one edit of ``query``."""
    if query.startswith(prefix):
        return True
    k = next((k for k, (a, b) in enumerate(zip(query, prefix)) if a != b), min(len(query), len(prefix)))
    return query[k + 1:].startswith(prefix[k + 1:]) or query[k:].startswith(prefix[k + 1:]) or query[k + 1:].startswith(prefix[k:])


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", misspelt: int = 97) -> DataFrame:
    """``(word, n)``: the letter runs of all whole texts, A-Z lower-cased, with planted typing errors.

    Where the CRC-32 of ``<doc_id>:<run>`` is a multiple of ``misspelt``, the
    run loses the character at that CRC modulo its length (0: no errors are
    planted). A null text has no runs; a null id is written as nothing.
    Counts are summed within a task before they are shuffled.
    """
    src = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")

    def count(batches):
        import pyarrow as pa

        held: Counter[bytes] = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in batches:
            for lo, hi in text_slices(b.column(1)):
                for own, t in zip(b.column(0)[lo:hi].to_pylist(), b.column(1)[lo:hi].to_pylist()):
                    seed = crc32(f"{own}:".encode())
                    data = t.encode("latin-1", "replace").lower()        # bytes.lower() changes A-Z alone
                    at = 0
                    while at < len(data):
                        to = at + TEXT_PART
                        while to < len(data) and RUN.match(data, to):
                            to += 1
                        for word, n in Counter(RUN.findall(data, at, to)).items():
                            h = crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                            if misspelt and h % misspelt == 0:
                                h %= len(word)
                                word = word[:h] + word[h + 1:]
                            held[word] += n
                        at = to
                        if len(held) > HELD_WORDS:
                            yield rows()
        if held:
            yield rows()

    return src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(word, n_near, best, best_n)`` of every word of ``vocabulary (word, n)`` that has words one edit away.

    ``best`` is the near word of largest n, the smallest in code-point order
    at a tie. Words are distinct, of at least two Latin-1 characters.
    """
    spark = vocabulary.sparkSession
    checkpoint_dir(spark)
    key = F.col("word")
    both = vocabulary.select(F.lit(0).alias("way"), key.alias("key"), "n").unionByName(vocabulary.select(F.lit(1).alias("way"), F.reverse(key).alias("key"), "n"))
    n_shards = max(1, -(-2 * vocabulary.count() // shard_words))
    lists = both.repartitionByRange(n_shards, "way", "key").sortWithinPartitions("way", "key").withColumn("shard", F.spark_partition_id()).checkpoint()
    # the shards of each list: first and last word, cut to 64 characters; a row for some shard_words words
    edge = lists.groupBy("way", "shard").agg(F.substring(F.min("key"), 1, 64).alias("first"), F.substring(F.max("key"), 1, 64).alias("last"))
    known: dict[int, list[tuple[bytes, int, bytes]]] = {0: [], 1: []}
    for r in edge.orderBy("way", "first", "shard").toLocalIterator():
        a, z = r.first.encode("latin-1"), r.last.encode("latin-1")
        same = next((k for k, (x, y) in enumerate(zip(a, z)) if x != y), min(len(a), len(z)))
        known[r.way].append((a, r.shard, a[:same]))

    def deal(batches):
        import pyarrow as pa

        firsts = {w: [x[0] for x in known[w]] for w in known}
        for b in batches:
            ways, keys, shards = [], [], []
            for way, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                q = word.encode("latin-1")
                start = q[:_fixed(len(q), way)]
                # from the last shard that begins before the range to the last that begins inside it
                lo = max(0, bisect_left(firsts[way], start[:64]) - 1)
                hi = bisect_right(firsts[way], start[:64] + b"\xff" * 64)
                for _, shard, prefix in known[way][lo:hi]:
                    if may_follow(q, prefix):
                        ways.append(way)
                        keys.append(word)
                        shards.append(shard)
            yield pa.RecordBatch.from_arrays([pa.array(ways, pa.int32()), pa.array(keys, pa.string()), pa.array(shards, pa.int32())], ["way", "key", "shard"])

    asked = lists.select("way", "key").mapInArrow(deal, "way int, key string, shard int").withColumn("n", F.lit(None).cast("long"))
    rows = lists.select("way", "key", "shard", "n").unionByName(asked).withColumn("asks", F.col("n").isNull())
    rows = rows.repartition("way", "shard").sortWithinPartitions("way", "shard", "asks", "key")

    def scan(batches):
        import pyarrow as pa

        now, listed, counts, words, questions = None, None, [], [], []

        def answer():
            queries = [q.encode("latin-1") for q in questions]
            found: dict[int, list] = {}
            fixed = np.array([_fixed(len(q), now[0]) for q in queries], dtype=np.int64)
            for who, what, half in listed.near(queries, fixed):
                for k, i, same in zip(who.tolist(), what.tolist(), half.tolist()):
                    other = words[i]
                    if now[0]:                                       # a reversed pair counts if it doesn't share the first half
                        h = min(len(other), len(queries[k])) // 2
                        if other[-h:] == questions[k][-h:]:
                            continue
                    elif not same:
                        continue
                    n = counts[i]
                    had = found.get(k)
                    other = other[::-1] if now[0] else other
                    if had is None:
                        found[k] = [1, n, other]
                    else:
                        had[0] += 1
                        if (-n, other) < (-had[1], had[2]):
                            had[1:] = n, other
            out = [(questions[k][::-1] if now[0] else questions[k], *v) for k, v in found.items()]
            questions.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                              ["word", "n_near", "best_n", "best"])

        for b in batches:
            for way, word, shard, n, asks in zip(*(c.to_pylist() for c in b.columns)):
                if (way, shard) != now:
                    if questions:
                        yield answer()
                    now, listed, counts, words = (way, shard), None, [], []
                if not asks:
                    words.append(word)
                    counts.append(n)
                    continue
                if listed is None:
                    listed = SortedList([w.encode("latin-1") for w in words])
                questions.append(word)
                if len(questions) >= 100_000:
                    yield answer()
        if questions:
            yield answer()

    parts = rows.mapInArrow(scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.w").alias("best"), (-F.col("b.n")).alias("best_n"))


def _fixed(size: int, way: int) -> int:
    """Characters at the begin that a pair found this way shares at least: half of a word one shorter."""
    return size // 2 if way else (size - 1) // 2


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                   form_times: int = FORM_TIMES, misspelt: int = 97, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per vocabulary word of ``docs``: word, form, root, n, n_near, form_n.

    Words are the distinct results of ``word_counts`` with ``min_length``
    characters and ``min_count`` occurrences at least. ``form`` is the near
    word of largest n (ties: smallest), if that is ``form_times`` times the
    word's n or more, else null; ``root`` follows forms to the last. Null and
    empty texts add nothing, repeated rows count again, other columns are
    ignored, and an empty table gives none.
    """
    if form_times < 2 or min_length < 2:
        raise ValueError("form_times and min_length must be 2 at least")
    checkpoint_dir(docs.sparkSession)
    vocabulary = word_counts(docs, doc_id, text, misspelt).where((F.col("n") >= min_count) & (F.length("word") >= min_length)).checkpoint()
    near = near_words(vocabulary, shard_words)
    is_form = F.col("best_n") >= form_times * F.col("n")
    words = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")).checkpoint()
    roots = _roots(words.where("form is not null").select("word", F.col("form").alias("root")))
    return words.join(roots.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: the end of every chain, by doubling steps. n at least doubles along a chain, so six rounds cover any count."""
    while True:
        step = links.select(F.col("word").alias("at"), F.col("root").alias("on"))
        links = join_on_keys(links, step, [("root", "at")], "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")).checkpoint()
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")
