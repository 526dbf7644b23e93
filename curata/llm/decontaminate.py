"""Benchmark decontamination by SimHash of item-sized windows (operator 1).

For every benchmark item, every run of as many words as the item has is a
window of a document. A window's fingerprint is the 128-bit SimHash of its
word shingles. Item fingerprints sit in a multi-index: eight tables of 16-bit
blocks; two fingerprints that differ in at most ``RADIUS`` = 36 bits differ
in at most 4 bits of some block, so probing every block with all patterns of
up to 4 flipped bits finds every item within the radius. The candidates are
then verified on the whole shingle multisets: the sum of minima over the sum
of maxima must reach the threshold.

A window whose similarity to an item of its size reaches t must hold at
least t times the item's number of shingles out of those of all items of that
size. Windows with fewer are skipped before fingerprinting: they can't be
verified, so nothing is lost.

Texts are compared in lower case with ASCII punctuation as white space, so
that case and marks glued to words don't hide a leak. Documents are scanned in
place, whole, one pass for each block of items
(``block_items``); only a block of items, not the benchmark, is broadcast.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curata.llm.hashing import SHINGLE_WORDS, SIMILARITY, Words, mix, text_slices

BLOCKS = 8                 # of 16 bits each
RADIUS = 36                # bits of 128; SimHash of shingle sets at 0.8 differs in about 19, with a deviation of 4
FLIPS = RADIUS // BLOCKS   # by the pigeonhole principle
BLOCK_ITEMS = 20_000       # items of one pass over the documents
BLOCK_CHARS = 16 << 20     # and their characters
RUN = 512                  # windows fingerprinted at a time

_SECOND = np.uint64(0xA0761D6478BD642F)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """One row of 128 signs (+1 or -1) for every shingle."""
    both = np.stack([shingles, mix(shingles ^ _SECOND)], axis=1).view(np.uint8).reshape(len(shingles), 16)
    return np.unpackbits(both, axis=1).astype(np.int8) * 2 - 1


def fingerprints(shingles: np.ndarray, size: int) -> np.ndarray:
    """SimHash (8 blocks of 16 bits) of every run of ``size`` shingles; a shingle weighs as often as it occurs."""
    total = np.zeros((len(shingles) + 1, 128), dtype=np.int32)
    np.cumsum(_signs(shingles), axis=0, dtype=np.int32, out=total[1:])
    return np.packbits(total[size:] - total[:-size] > 0, axis=1).view(np.uint16)


def _flip_masks() -> np.ndarray:
    every = np.arange(1 << 16, dtype=np.uint32)
    bits = np.unpackbits(every.astype(">u2").view(np.uint8).reshape(-1, 2), axis=1).sum(axis=1)
    return every[bits <= FLIPS].astype(np.uint16)


class ItemIndex:
    """The items of one block: shingles by window size, and the multi-index of their fingerprints."""

    def __init__(self, items: list[tuple], words: int = SHINGLE_WORDS):
        w = Words([t for _, t in items], plain=True)
        self.words = words
        self.ids, self.size, self.shingles, prints = [], [], [], []
        for k, (item_id, _) in enumerate(items):
            n = int(w.first[k + 1] - w.first[k])
            if n:
                part = Words([items[k][1]], plain=True).shingles(min(words, n))[0]
                self.ids.append(item_id)
                self.size.append(n)
                self.shingles.append(np.sort(part))
                prints.append(fingerprints(part, len(part))[0])
        self.size = np.array(self.size, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint16).reshape(-1, BLOCKS)
        self.of_size = {int(n): np.unique(np.concatenate([s for s, m in zip(self.shingles, self.size) if m == n])) for n in np.unique(self.size)}
        # per run length of words (shorter items have shorter shingles): all shingles, and a bit table that most others miss
        self.all = {}
        for n in {min(words, s) for s in self.of_size}:
            every = np.unique(np.concatenate([v for s, v in self.of_size.items() if min(words, s) == n]))
            table = np.zeros(1 << 22, dtype=bool)
            table[(every & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.all[n] = (every, table)
        self.masks = _flip_masks()
        self.order = [np.argsort(self.prints[:, b], kind="stable") for b in range(BLOCKS)]
        self.start = [np.searchsorted(self.prints[o, b], np.arange((1 << 16) + 1)) for b, o in enumerate(self.order)]

    def near(self, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """``(window, item, bits)`` for every item fingerprint within the radius of a window's."""
        found = set()
        for b in range(BLOCKS):
            value = prints[:, b, None] ^ self.masks
            lo, hi = self.start[b][value], self.start[b][value.astype(np.int64) + 1]
            for window, probe in zip(*np.nonzero(hi > lo)):
                found.update((int(window), int(i)) for i in self.order[b][lo[window, probe]:hi[window, probe]])
        if not found:
            return []
        pairs = np.array(sorted(found))
        bits = np.unpackbits((prints[pairs[:, 0]] ^ self.prints[pairs[:, 1]]).view(np.uint8), axis=1).sum(axis=1)
        return [(int(w), int(i), int(n)) for (w, i), n in zip(pairs, bits) if n <= RADIUS]

    def search(self, texts: list[str | None], threshold: float) -> list[tuple]:
        """``(text, item_id, similarity, bits, n_windows, first_word, n_words)`` for every text and item that is in it; the best window's figures."""
        best = {}
        doc = Words(texts, plain=True)
        for n, (every, table) in self.all.items():
            sh, first = doc.shingles(n)
            hit = np.flatnonzero(table[(sh & np.uint64((1 << 22) - 1)).astype(np.int64)])
            hit = hit[np.isin(sh[hit], every)]
            of = np.searchsorted(first, hit, side="right") - 1
            for text in np.unique(of):
                own = sh[first[text]:first[text + 1]]
                at = hit[of == text] - first[text]
                length = int(doc.first[text + 1] - doc.first[text])
                for size, wanted in self.of_size.items():
                    if min(self.words, size) == n:
                        self._windows(best, int(text), own, at[np.isin(own[at], wanted)], size, n, length, threshold)
        return [(text, self.ids[i], *row) for (text, i), row in sorted(best.items())]

    def _windows(self, best: dict, text: int, own: np.ndarray, at: np.ndarray, size: int, n: int, length: int, threshold: float) -> None:
        """Verify the windows of ``size`` words (the whole text if it is shorter) that hold enough shingles ``at`` which items of that size have."""
        span = min(size, length) - n + 1 if length >= n else 1
        need = max(1, int(np.ceil(threshold * (size - n + 1) - 1e-9)))
        if len(at) < need:
            return
        low = np.maximum(at[need - 1:] - span + 1, 0)
        high = np.minimum(at[:len(at) - need + 1], len(own) - span)
        ok = low <= high
        edges = np.zeros(len(own) - span + 2, dtype=np.int32)
        np.add.at(edges, low[ok], 1)
        np.add.at(edges, high[ok] + 1, -1)
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for lo in range(0, len(run), RUN):
                s, e = int(run[lo]), int(run[min(lo + RUN, len(run)) - 1])
                part = own[s:e + span]
                for window, item, bits in self.near(fingerprints(part, span)):
                    if self.size[item] != size:
                        continue
                    similarity = weighted_similarity(part[window:window + span], self.shingles[item])
                    if similarity >= threshold - 1e-9:
                        old = best.get((text, item), (0.0, 0, 0, 0, 0))
                        row = (similarity, bits, old[2] + 1, s + window, min(size, length))
                        best[text, item] = row if similarity > old[0] else (*old[:2], old[2] + 1, *old[3:])


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of two shingle multisets."""
    keys, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(place[:len(a)], minlength=len(keys))
    y = np.bincount(place[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_items: int):
    """The items (with a text) in blocks of bounded size, through an iterator of partitions."""
    block, chars = [], 0
    rows = benchmark.select(F.col(item_id), F.col(text).cast("string")).where(F.col(text).isNotNull())
    for row in rows.toLocalIterator():
        if block and (len(block) >= block_items or chars + len(row[1]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append(tuple(row))
        chars += len(row[1])
    if block:
        yield block


_built: dict[str, ItemIndex] = {}


def _index(name: str, items) -> ItemIndex:
    """The index of a broadcast block, built once in a Python worker."""
    if name not in _built:
        _built.clear()
        _built[name] = ItemIndex(items.value)
    return _built[name]


def _broadcasts(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, block_items: int):
    for items in _blocks(benchmark, item_id, item_text, block_items):
        yield uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", threshold: float = SIMILARITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document row and benchmark item found in it; clean documents have none.

    Columns: doc_id, item_id, similarity, hamming_bits, n_windows (that reach
    the threshold), first_word (of the best window, counted in normalised
    words) and window_words. A document shorter than an item is one window.
    Null or wordless texts and items match nothing; items of fewer than five
    words are matched whole; equal items and repeated rows are all reported.
    """
    types = dict(benchmark.dtypes)[item_id]
    schema = (f"doc_id {dict(docs.dtypes)[doc_id]}, item_id {types}, similarity double, hamming_bits int, n_windows long, "
              "first_word long, window_words long")
    src = docs.select(F.col(doc_id), F.col(text).cast("string"))
    out = docs.sparkSession.createDataFrame([], schema)
    fields, kinds = out.columns, [to_arrow_type(f.dataType) for f in out.schema.fields]
    for name, items in _broadcasts(docs, benchmark, item_id, item_text, block_items):
        def scan(batches, name=name, items=items):
            import pyarrow as pa

            for b in batches:
                for lo, hi in text_slices(b.column(1)):
                    rows = _index(name, items).search(b.column(1).slice(lo, hi - lo).to_pylist(), threshold)
                    if rows:
                        ids = b.column(0).take(pa.array([lo + r[0] for r in rows]))
                        yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], kinds[k]) for k in range(1, 7))], fields)

        out = out.unionByName(src.mapInArrow(scan, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               threshold: float = SIMILARITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all others are returned as they are."""
    at = docs.columns.index(text)
    for name, items in _broadcasts(docs, benchmark, item_id, item_text, block_items):
        def clean(batches, name=name, items=items):
            import pyarrow as pa

            for b in batches:
                for lo, hi in text_slices(b.column(at)):
                    part = b.slice(lo, hi - lo)
                    leaked = {r[0] for r in _index(name, items).search(part.column(at).to_pylist(), threshold)}
                    yield part.filter(pa.array([i not in leaked for i in range(hi - lo)])) if leaked else part

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
