"""N-gram Jaccard join with Bayesian candidate pruning (operator 10).

Which different texts share at least ``threshold`` of their distinct word
shingles? Method: MinHash bands make the candidates; the MinHash values of a
candidate pair are compared a few at a time, and the pair is dropped as soon
as the posterior probability that it reaches the threshold falls below
``tolerance``; what is left is verified on the whole shingle sets.

How it runs on Spark:

1. one pass over all texts: digest and signature; equal texts collapse to
   one row by digest (a group of copies is one row per map task);
2. every signature is cut into bands; texts with an equal band form a
   bucket. Buckets with one text go, and of buckets with the same members
   (close copies meet in most bands) only that of the lowest band stays;
3. a bucket of n texts is cut into ceil(n / block) blocks, and each pair of
   blocks is one cell, so no task holds a large bucket. Only texts in
   some bucket get their shingle sets computed (second pass);
4. in a cell, numpy compares signatures, drops, and verifies. A pair is
   handled only in the first band it shares. No pairs leave the cell: it
   returns link counts per text and the links of a spanning forest;
5. connected components of those links are the groups.

``keep_one`` needs the groups alone, not the number of links, and so doesn't
compare all pairs of a bucket (``text_classes``): every text of a bucket is
verified against the bucket's smallest text, its representative; what these
links connect is a class. Only in buckets with several classes are the texts
outside the largest one compared with the texts of other classes. A group of
n near copies costs n verifications per representative, and a cell is bounded
by the bytes of its shingle sets.

A pair of similarity s is missed only if it shares no band: (1 - s^r)^b, with
r = 5 and b = 32 that is 3e-6 at s = 0.8 and less above.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.graph import connected_components
from curata.llm.hashing import SHINGLE_WORDS, SIMILARITY, Words, signatures, text_slices
from curata.operators.joins import join_on_keys, small_side
from curata.session import checkpoint_dir

BANDS = 32
ROWS = 5              # MinHash values of a band
BLOCK = 512           # texts of a block; a cell holds two at most
STEP = 16             # MinHash values compared at a time
TOLERANCE = 1e-6
CELL_BYTES = 4 << 20  # shingle sets and signatures that ``text_classes`` verifies in one group


def digest(text: Column) -> Column:
    """128 bits of a whole text's SHA-256; a null text counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def least_matches(threshold: float, tolerance: float, n_hashes: int, step: int = STEP) -> dict[int, int]:
    """After n compared MinHash values: the fewest matches that keep a pair.

    With a uniform prior on the similarity S, P(S >= t | m of n match) is the
    probability of at most m successes in n + 1 draws of chance t.
    """
    out = {}
    for n in range(step, n_hashes + 1, step):
        p, m = 0.0, 0
        while m <= n:
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def _signed(docs: DataFrame, doc_id: str, text: str, words: int, n_hashes: int) -> tuple[DataFrame, DataFrame]:
    """All rows as ``(doc_id, digest, text)``, and one row per different text: ``(digest, first_id, n_copies, size, sig)``; checkpointed."""
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    src = docs.select(F.col(doc_id).alias("doc_id"), digest(full).alias("digest"), full.alias("text"))

    def sign(batches):
        import pyarrow as pa

        for b in batches:
            for lo, hi in text_slices(b.column(2)):
                sh, first = Words(b.column(2).slice(lo, hi - lo).to_pylist()).shingles(words)
                sig, n = signatures(sh, first, n_hashes), np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array([s.tobytes() if k else None for s, k in zip(sig, n)], pa.binary())],
                    ["doc_id", "digest", "size", "sig"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    texts = (src.mapInArrow(sign, f"doc_id {id_type}, digest binary, size long, sig binary")
             .groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size"), F.first("sig").alias("sig"))
             .checkpoint())
    return src, texts


def _payload(src: DataFrame, texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(digest, shingles, sig)`` of the texts in ``wanted (digest)``: the second pass over texts; checkpointed."""
    def sets(batches):
        import pyarrow as pa

        for b in batches:
            for lo, hi in text_slices(b.column(1)):
                sh, first = Words(b.column(1).slice(lo, hi - lo).to_pylist()).shingles(words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([np.unique(sh[s:e]).tobytes() for s, e in zip(first[:-1], first[1:])], pa.binary())],
                    ["digest", "shingles"])

    return (src.select("digest", "text").join(small_side(wanted), "digest", "left_semi").mapInArrow(sets, "digest binary, shingles binary")
            .groupBy("digest").agg(F.first("shingles").alias("shingles"))
            .join(texts.select("digest", "sig"), "digest").checkpoint())


def text_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY,
                words: int = SHINGLE_WORDS, tolerance: float = TOLERANCE, bands: int = BANDS, rows: int = ROWS,
                block: int = BLOCK) -> DataFrame:
    """One row per different text: ``digest`` (binary), ``first_id`` (its smallest id), ``n_copies``, ``n_links``, ``group_digest``, ``class_id``.

    ``n_links``: different texts with a similarity of ``threshold`` or more.
    ``group_digest`` is equal for all texts of a connected group (the digest
    of one of them); ``class_id`` the smallest id in the group (null if all
    are null). Texts with fewer than ``words`` words have one shingle of all
    their words; texts without words (and nulls, taken as empty) link to none.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    n_hashes = bands * rows
    src, texts = _signed(docs, doc_id, text, words, n_hashes)
    cells = _cells(texts, bands, rows, block)
    links = _links(src, texts, cells, threshold, words, tolerance, bands, rows).checkpoint()
    groups = connected_components(links.where("root is not null"), "digest", "root")
    n_links = links.groupBy("digest").agg(F.sum("n_links").alias("n_links"))
    out = (texts.drop("sig", "size").join(n_links, "digest", "left")
           .join(groups.withColumnRenamed("node", "digest"), "digest", "left")
           .select("digest", "first_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component", "digest").alias("group_digest")).checkpoint())
    named = out.groupBy("group_digest").agg(F.min("first_id").alias("class_id"))
    return out.join(named, "group_digest").select("digest", "first_id", "n_copies", "n_links", "group_digest", "class_id")


def _buckets(texts: DataFrame, bands: int, rows: int, least: bool = False) -> tuple[DataFrame, DataFrame]:
    """Texts by bucket ``(digest, band, bucket)``, and the buckets to look at ``(band, bucket, n)``, checkpointed.

    With ``least``, also the texts' sizes and every bucket's smallest digest;
    what isn't needed isn't shuffled.
    """
    width = 4 * rows
    keys = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", 1 + width * b, width)).alias("bucket"))
                     for b in range(bands)])
    member = texts.where("sig is not null").select("digest", *(["size"] if least else []), F.inline(keys))
    h1, h2 = F.xxhash64("digest").cast("decimal(20,0)"), F.xxhash64(F.lit(1), "digest")
    buckets = member.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("s"), F.bit_xor(h2).alias("x"),
                                                     *([F.min("digest").alias("least")] if least else []))
    same = buckets.where("n > 1").groupBy("n", "s", "x").agg(F.min(F.struct("band", "bucket")).alias("b"), *([F.min("least").alias("least")] if least else []))
    return member, same.select("b.band", "b.bucket", "n", *(["least"] if least else [])).checkpoint()


def _cells(texts: DataFrame, bands: int, rows: int, block: int) -> DataFrame:
    """Rows ``(bucket, i, j, band, side, digest)``: text ``digest`` takes part, as block ``side``, in the cell of blocks i <= j."""
    member, live = _buckets(texts, bands, rows)
    blocks = F.ceil(F.col("n") / block).cast("int")
    m = member.join(live, ["band", "bucket"]).select(
        "band", "bucket", "digest", blocks.alias("blocks"), F.pmod(F.xxhash64(F.lit(2), "digest"), blocks).cast("int").alias("side"))
    m = m.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return m.select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "band", "side", "digest")


def _links(src: DataFrame, texts: DataFrame, cells: DataFrame, threshold: float, words: int, tolerance: float,
           bands: int, rows: int) -> DataFrame:
    """Rows ``(digest, n_links, root)``: links found in a cell, and the text it hangs on in the cell's spanning forest (null: none)."""
    cells = cells.checkpoint()
    payload = _payload(src, texts, cells.select("digest").distinct(), words)
    keep = least_matches(threshold, tolerance, bands * rows)

    def cell(key, table):
        return _cell(key, table, keep, threshold, bands, rows)

    return cells.join(payload, "digest").groupBy("bucket", "i", "j", "band").applyInArrow(cell, "digest binary, n_links long, root binary")


def _cell(key, table, keep: dict[int, int], threshold: float, bands: int, rows: int):
    """All links between the two blocks of a cell (or within its one block)."""
    import pyarrow as pa

    i, j, band = key[1].as_py(), key[2].as_py(), key[3].as_py()
    ids = table.column("digest").to_pylist()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint32).reshape(len(ids), bands * rows)
    side = table.column("side").to_numpy()
    size = np.array([len(s) // 8 for s in table.column("shingles").to_pylist()], dtype=np.int64)
    vocabulary, word = np.unique(np.frombuffer(b"".join(table.column("shingles").to_pylist()), dtype=np.uint64), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(size)))
    present = np.zeros(len(vocabulary), dtype=bool)
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    n_links = np.zeros(len(ids), dtype=np.int64)
    root = np.arange(len(ids))

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, a in enumerate(left):
        others = right[k + 1:] if i == j else right
        matches = np.zeros(len(others), dtype=np.int64)
        for n, least in keep.items():
            matches += (sig[others, n - STEP:n] == sig[a, n - STEP:n]).sum(axis=1)
            others, matches = others[matches >= least], matches[matches >= least]
            if not len(others):
                break
        if not len(others):
            continue
        shared = (sig[others] == sig[a]).reshape(len(others), bands, rows).all(axis=2)
        others = others[shared.argmax(axis=1) == band]          # a pair counts in its first common band only
        if not len(others):
            continue
        mine = word[at[a]:at[a + 1]]
        present[mine] = True
        both = np.add.reduceat(present[np.concatenate([word[at[o]:at[o + 1]] for o in others])], np.concatenate(([0], np.cumsum(size[others])))[:-1], dtype=np.int64)
        present[mine] = False
        linked = others[both >= threshold * (size[a] + size[others] - both) - 1e-9]
        n_links[a] += len(linked)
        n_links[linked] += 1
        for o in linked:
            x, y = top(a), top(o)
            if x != y:
                root[max(x, y)] = min(x, y)
    some = np.flatnonzero(n_links)
    return pa.table({"digest": pa.array([ids[x] for x in some], pa.binary()), "n_links": pa.array(n_links[some], pa.int64()),
                     "root": pa.array([None if top(x) == x else ids[top(x)] for x in some], pa.binary())})


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id, ``class_id``, ``n_copies`` and ``n_links``.

    ``class_id`` is the smallest id of the document's group: equal texts, and
    texts connected by links. ``n_copies`` counts the rows with this very
    text (itself included), ``n_links`` the other texts linked to it. Repeated
    rows give repeated rows; an empty table gives none; other columns are
    ignored. Options as in ``text_groups``.
    """
    groups = text_groups(docs, doc_id, text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text).cast("string")).alias("digest"))
    return rows.join(groups, "digest").select("doc_id", "class_id", "n_copies", "n_links")


def text_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY, words: int = SHINGLE_WORDS,
                 tolerance: float = TOLERANCE, bands: int = BANDS, rows: int = ROWS, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """One row per different text: ``digest``, ``first_id`` (its smallest id), ``n_copies`` and ``class_digest``, equal for all texts of a connected group.

    The groups are those of ``text_groups``, without the numbers of links.
    """
    checkpoint_dir(docs.sparkSession)
    src, texts = _signed(docs, doc_id, text, words, bands * rows)
    member, live = _buckets(texts, bands, rows, least=True)
    inside = member.join(live, ["band", "bucket"]).select("band", "bucket", "digest", "size", "least").checkpoint()      # read four times
    payload = _payload(src, texts, inside.select("digest").distinct(), words)
    keep = least_matches(threshold, tolerance, bands * rows)
    weight = 8 * F.col("size") + 4 * bands * rows

    # 1. every text against the representatives of its buckets
    pairs = inside.where("digest <> least").groupBy("least", "digest").agg(F.first("size").alias("size"))
    spread = pairs.groupBy(F.col("least").alias("l")).agg(F.ceil(F.sum(weight) / cell_bytes).cast("int").alias("parts"))
    dealt = join_on_keys(pairs, spread, [("least", "l")], "inner").select(
        F.col("least").alias("cell"), F.pmod(F.xxhash64(F.lit(2), "digest"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"), "digest").checkpoint()
    tops = dealt.select("cell", "part").distinct().select("cell", "part", F.lit(0).alias("side"), F.col("cell").alias("digest"))
    known = _verified(dealt.unionByName(tops).withColumn("class", F.col("digest")), payload, keep, threshold)
    classes = connected_components(known, "a", "b").withColumnRenamed("node", "digest").checkpoint()

    # 2. in buckets with several classes, the texts outside the largest against those of other classes
    tagged = inside.join(classes, "digest", "left").select("band", "bucket", "digest", "size", F.coalesce("component", "digest").alias("class"))
    mixed = tagged.groupBy("band", "bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y").select("band", "bucket").checkpoint()
    tagged = tagged.join(small_side(mixed), ["band", "bucket"]).checkpoint()
    share = tagged.groupBy("band", "bucket", "class").agg(F.count(F.lit(1)).alias("k"), F.sum(weight).alias("w"))
    open_ = share.groupBy("band", "bucket").agg(F.max_by("class", F.struct("k", "class")).alias("largest"), F.sum("w").alias("w"),
                                                F.max_by("w", F.struct("k", "class")).alias("most"))
    open_ = open_.select("band", "bucket", "largest", F.ceil(F.col("w") / cell_bytes).cast("int").alias("all_parts"),
                         F.ceil((F.col("w") - F.col("most")) / cell_bytes).cast("int").alias("few_parts"))
    part = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "digest"), F.col(n)).cast("int")
    t = tagged.join(open_, ["band", "bucket"]).withColumn("few", F.col("class") != F.col("largest")).checkpoint()
    right = t.select("band", "bucket", "digest", "class", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("few_parts") - 1)).alias("i"), part(3, "all_parts").alias("j"))
    left = t.where("few").select("band", "bucket", "digest", "class", F.lit(0).alias("side"), part(4, "few_parts").alias("i"),
                                 F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)).alias("j"))
    cells = left.unionByName(right).select(F.struct("band", "bucket", "i", "j").alias("cell"), F.lit(0).alias("part"), "side", "digest", "class")
    more = _verified(cells, payload, keep, threshold)
    if not more.isEmpty():
        classes = connected_components(known.unionByName(more), "a", "b").withColumnRenamed("node", "digest")
    return texts.join(classes, "digest", "left").select("digest", "first_id", "n_copies", F.coalesce("component", "digest").alias("class_digest")).checkpoint()


def _verified(cells: DataFrame, payload: DataFrame, keep: dict[int, int], threshold: float) -> DataFrame:
    """Links ``(a, b)`` between the two sides of every cell ``(cell, part, side, digest, class)``; enough of them to connect what the cell's links connect."""
    def cell(table):
        import pyarrow as pa

        ids, kind = table.column("digest").to_pylist(), table.column("class").to_pylist()
        side = table.column("side").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint32).reshape(len(ids), -1)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        number = {k: n for n, k in enumerate(dict.fromkeys(kind))}
        of = np.array([number[k] for k in kind])                  # the class of each text, as links join classes
        right = np.flatnonzero(side == 1)
        out = []
        for a in np.flatnonzero(side == 0):
            others = right[of[right] != of[a]]
            matches = np.zeros(len(others), dtype=np.int64)
            for n, least in keep.items():
                matches += (sig[others, n - STEP:n] == sig[a, n - STEP:n]).sum(axis=1)
                others, matches = others[matches >= least], matches[matches >= least]
                if not len(others):
                    break
            mine = sets[a]
            for o in others:
                if of[o] == of[a] or not len(mine):
                    continue
                at = np.minimum(np.searchsorted(mine, sets[o]), len(mine) - 1)
                both = int((mine[at] == sets[o]).sum())
                if both >= threshold * (len(mine) + len(sets[o]) - both) - 1e-9:
                    out.append((ids[a], ids[o]))
                    of[of == of[o]] = of[a]
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([x for _, x in out], pa.binary())})

    return cells.join(payload, "digest").groupBy("cell", "part").applyInArrow(cell, "a binary, b binary").checkpoint()


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one row left of each group: that of the smallest id (nulls last).

    Of rows with that id and that text, the one whose JSON text comes first
    stays. Columns of any name pass through as they are. Options as in
    ``text_classes``.
    """
    classes = text_classes(docs, doc_id, text, **options)
    best = classes.groupBy("class_digest").agg(F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "digest", "n_copies")).alias("best"))
    keep = best.select("best.*").select(F.col("digest").alias("best_digest"), "first_id", "n_copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("own_id"), digest(F.col(text).cast("string")).alias("digest"))
    chosen = join_on_keys(rows, keep, [("digest", "best_digest")], "inner").where(F.col("own_id").eqNullSafe(F.col("first_id")))
    # a text that occurs once needs no further work; copies with the smallest id are counted before their rows are compared
    several = chosen.where("n_copies > 1").groupBy("digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return chosen.where("n_copies = 1").select("row.*").unionByName(several.select("row.*"))
