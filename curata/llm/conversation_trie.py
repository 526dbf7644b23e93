"""Prefix trie of conversations, balanced parentheses per shard (operator 11).

Conversations with the same first turns share a path. Sorted by their turns'
digests, conversations below one node are neighbours, so a range of the
sorted table is a shard of the trie. A shard is kept as balanced parentheses
(a node opens where the sorted list first has it, and closes after its last
descendant): ``Parens`` finds the matching close of all nodes with blocks of
the smallest and largest excess, ranks count the leaf pairs ``()`` inside a
node, and cumulative arrays over nodes and members give counts and savings.

Nodes on a shard's first path that the shard before also has, or on its last
path that the next one has, are its shared spines. Every figure is a sum (or
minimum) over the members and over the nodes that a shard opens itself, so
the parts of a spine node from its shards add up; all other nodes are final.

A very long conversation isn't one row: it is cut into segments of
``SEGMENT`` turns, each in the sub-trie below the node where it begins (known
by a 128-bit sum over the segments before). What a conversation opens in its
later segments is added to its earlier ones, then shards are built once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.joins import join_on_keys, small_side
from curata.operators.ordering import positions
from curata.session import checkpoint_dir

SEGMENT = 64             # turns of a conversation in one row
SHARD_TURNS = 400_000    # turns of the rows that are held at a time
NO_ENDS = hashlib.sha256(b"").hexdigest()


class FirstBelow:
    """For a sequence that changes by steps of one: the first later place with a value of ``target`` or less.

    Blocks of 64 keep their smallest and largest value, and a binary tree
    over the blocks does too. A search looks at the rest of its block, climbs
    to the first subtree whose range holds the target, descends to that
    subtree's first such block and looks there.
    """

    BLOCK = 64

    def __init__(self, values: np.ndarray):
        n = max(1, -(-len(values) // self.BLOCK))
        size = 1 << (n - 1).bit_length()
        self.rows = np.full((n, self.BLOCK), np.iinfo(np.int32).max, dtype=np.int32)
        self.rows.ravel()[:len(values)] = values
        # a heap: node 1 is the root, block k sits at size + k
        self.low = np.full(2 * size, np.iinfo(np.int32).max, dtype=np.int32)
        self.high = np.full(2 * size, np.iinfo(np.int32).min, dtype=np.int32)
        self.size = size
        self.low[size:size + n] = self.rows.min(axis=1)
        self.high[size:size + n] = np.where(self.rows == np.iinfo(np.int32).max, np.iinfo(np.int32).min, self.rows).max(axis=1)
        while size > 1:
            size //= 2
            self.low[size:2 * size] = self.low[2 * size:4 * size].reshape(-1, 2).min(axis=1)
            self.high[size:2 * size] = self.high[2 * size:4 * size].reshape(-1, 2).max(axis=1)

    def after(self, place: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Every search must have a result."""
        out = np.empty(len(place), dtype=np.int64)
        step = np.arange(self.BLOCK)
        for i in range(0, len(place), 1 << 16):
            p, t = place[i:i + (1 << 16)], target[i:i + (1 << 16)]
            block = p // self.BLOCK
            hit = (self.rows[block] <= t[:, None]) & (step > (p % self.BLOCK)[:, None])
            found = block * self.BLOCK + hit.argmax(axis=1)
            far = np.flatnonzero(~hit.any(axis=1))
            if len(far):
                node, goal = block[far] + self.size, t[far]
                on = np.arange(len(far))
                while len(on):                                   # up: the next subtree to the right, as large as it may be
                    up = node[on] + 1
                    up //= up & -up                              # a left child's parent begins at the same block
                    node[on] = up
                    on = on[~((self.low[up] <= goal[on]) & (goal[on] <= self.high[up]))]
                on = np.flatnonzero(node < self.size)
                while len(on):                                   # down: its first block that holds the goal
                    left = 2 * node[on]
                    node[on] = np.where(self.low[left] <= goal[on], left, left + 1)
                    on = on[node[on] < self.size]
                block = node - self.size
                found[far] = block * self.BLOCK + (self.rows[block] <= goal[:, None]).argmax(axis=1)
            out[i:i + (1 << 16)] = found
        return out


class Parens:
    """Balanced parentheses of a forest (1 opens a node, 0 closes it), nodes numbered in the order they open."""

    def __init__(self, bits: np.ndarray):
        self.open = np.flatnonzero(bits)
        self.excess = np.cumsum(np.where(bits == 1, 1, -1), dtype=np.int32)
        self.leaf = bits[np.minimum(self.open + 1, len(bits) - 1)] == 0          # the pairs ()

    def sizes(self) -> np.ndarray:
        """Nodes of every subtree, its top included: half the distance to the matching close."""
        close = FirstBelow(self.excess).after(self.open, self.excess[self.open] - 1)
        return (close - self.open + 1) // 2

    def parents(self) -> np.ndarray:
        """The node around every node, -1 for a root: the same search from right to left."""
        before = np.concatenate(([0], self.excess[:-1]))        # excess in front of each place
        depth = before[self.open]
        out = np.full(len(self.open), -1, dtype=np.int64)
        inner = np.flatnonzero(depth > 0)
        if len(inner):
            last = len(before) - 1
            place = last - FirstBelow(before[::-1]).after(last - self.open[inner], depth[inner] - 1)
            out[inner] = np.searchsorted(self.open, place)
        return out


def common(path: list[bytes]) -> np.ndarray:
    """Digests that each path shares with the one before it (0 for the first)."""
    n = np.array([len(p) // 16 for p in path], dtype=np.int64)
    turn = np.frombuffer(b"".join(path), dtype="<u8").reshape(-1, 2)
    at = np.cumsum(n) - n
    both = np.concatenate(([0], np.minimum(n[1:], n[:-1]))).astype(np.int64)
    row = np.repeat(np.arange(len(path)), both)
    j = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    differs = np.flatnonzero((turn[at[row] + j] != turn[at[np.maximum(row - 1, 0)] + j]).any(axis=1))
    rows, first = np.unique(row[differs], return_index=True)
    out = both
    out[rows] = j[differs[first]]
    return out


def shared(a: tuple | None, b: tuple | None) -> int:
    """Turns that two neighbouring rows ``(root, path, ...)`` share, -1 if they hang below different nodes."""
    if a is None or b is None or a[0] != b[0]:
        return -1
    return int(common([a[1], b[1]])[1])


class Shard:
    """Consecutive rows of the sorted table as a trie.

    A row is (root, path, more, conv_id, sizes, next_root, below_bytes,
    below_opened, below_leaves); ``before`` and ``after`` are the turns that
    the first and last row share with their outer neighbours.
    """

    def __init__(self, rows: list[tuple], before: int, after: int):
        self.rows, self.before, self.after = rows, before, after
        n = np.array([len(r[1]) // 16 for r in rows], dtype=np.int64)
        same = np.array([False] + [a[0] == b[0] for a, b in zip(rows, rows[1:])])
        keep = np.where(same, common([r[1] for r in rows]) + 1, 0)      # nodes kept of the path before, its root included
        new = n + 1 - keep
        close = np.concatenate(([0], n[:-1] + 1 - keep[1:]))
        self.n, self.new = n, new
        bits = np.repeat(np.tile(np.array([0, 1], dtype=np.int8), len(rows) + 1),
                         np.concatenate((np.column_stack((close, new)).ravel(), [n[-1] + 1, 0])))
        self.tree = Parens(bits)
        first = np.cumsum(new) - new
        self.row = np.repeat(np.arange(len(rows)), new)                 # the row that opens each node
        self.depth = keep[self.row] + np.arange(len(self.row)) - first[self.row]
        sizes = np.concatenate([np.asarray(r[4], dtype=np.int64) for r in rows] + [np.zeros(1, dtype=np.int64)])
        at = np.cumsum(n) - n
        self.bytes = np.where(self.depth > 0, sizes[np.where(self.depth > 0, at[self.row] + self.depth - 1, 0)], 0)
        # the node where each row ends: its last new one, or, of a repeated path, the row before's
        self.end = np.maximum.accumulate(np.where(new > 0, first + new - 1, 0))
        self.own = np.ones(len(self.row), dtype=bool)
        self.own[:before + 1] = False                                   # nodes of the first path that an earlier shard opened

    def ends_open(self) -> np.ndarray:
        """Whether each row is a whole conversation's end at a leaf of the trie."""
        last = np.concatenate((self.end[1:] != self.end[:-1], [True]))
        more = np.array([r[2] for r in self.rows])
        out = self.tree.leaf[self.end] & last & ~more
        out[-1] &= self.after < self.n[-1]
        return out

    def opened(self) -> np.ndarray:
        """Bytes of the nodes that each row opens."""
        return np.bincount(self.row, np.where(self.own, self.bytes, 0), len(self.rows)).astype(np.int64)

    def key(self, node: int) -> str:
        """A name of a node that every shard gives it."""
        root, path, _, _, _, next_root, *_ = self.rows[self.row[node]]
        depth = int(self.depth[node])
        if depth == 0:
            return root
        return next_root if 16 * depth == len(path) and next_root else hashlib.md5(root.encode() + path[:16 * depth]).hexdigest()

    def nodes(self, segment: int) -> Iterator[dict]:
        """Final nodes, and the parts of spine nodes (those have a key)."""
        size, parent = self.tree.sizes(), self.tree.parents()
        v = np.arange(len(size))
        total = lambda x: np.concatenate(([0], np.cumsum(x)))
        member = total(np.bincount(self.end, minlength=len(v)))
        lo, hi = member[v], member[v + size]                            # the rows below each node
        conv = np.array([r[3] for r in self.rows] + [0], dtype=np.int64)
        least = np.minimum.reduceat(conv, np.column_stack((lo, hi)).ravel())[::2]
        saved = total((hi - lo - self.own) * self.bytes)
        later = total([r[6] - r[7] for r in self.rows])
        saved = saved[v + size] - saved[v] + later[hi] - later[lo]
        leaf = np.zeros(len(v), dtype=np.int64)
        leaf[self.end[self.ends_open()]] = 1
        leaves, below = total(leaf), total([r[8] for r in self.rows])
        leaves = leaves[v + size] - leaves[v] + below[hi] - below[lo]
        children = np.bincount(parent[self.own & (parent >= 0)], minlength=len(v))
        above = np.array([int(r[0].split("|")[0]) for r in self.rows], dtype=np.int64)[self.row] * segment
        sub_root = (self.depth == 0) & (above > 0)
        spine = sub_root.copy()
        spine[:self.before + 1] = True
        node, depth = int(self.end[-1]), int(self.n[-1])
        while depth >= 0:
            if depth <= self.after:
                spine[node] = True
            node, depth = int(parent[node]), depth - 1
        more = np.array([r[2] for r in self.rows])
        spine[self.end[more]] = True
        ids: dict[int, list[str]] = {}
        for e, r in zip(self.end.tolist(), self.rows):
            if not r[2]:
                ids.setdefault(e, []).append(str(r[3]))
        keys = {int(k): self.key(int(k)) for k in np.flatnonzero(spine)}
        for k in range(len(v)):
            up, top = int(parent[k]), bool(sub_root[k])
            text = ",".join(ids[k]) if k in ids else None
            yield {"key": keys.get(k), "parent_key": keys.get(up), "conv_id": None if top else int(least[k]), "depth": int(self.depth[k] + above[k]),
                   "parent_conv_id": None if up < 0 or up in keys else int(least[up]), "n_convs": 0 if top else int(hi[k] - lo[k]),
                   "n_children": int(children[k]), "n_leaves": 0 if top else int(leaves[k]), "saved_tokens": 0 if top else int(saved[k]),
                   "ends_sha256": hashlib.sha256(text.encode()).hexdigest() if text is not None and k not in keys else None,
                   "ids": text if k in keys else None}


FIELDS = ("root", "path", "more", "conv_id", "sizes", "next_root", "below_bytes", "below_opened", "below_leaves")


def _shards(batches, edges: dict[int, tuple[int, int]], held_turns: int) -> Iterator[tuple[int, Shard]]:
    """A partition's rows as numbered shards of about ``held_turns`` turns."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    before, after = edges.get(part, (-1, -1))
    rows: list[tuple] = []
    turns = n = 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if turns >= held_turns:
                between = shared(rows[-1], row)
                yield (part << 24) + n, Shard(rows, before, between)
                rows, turns, n, before = [], 0, n + 1, between
            rows.append(row)
            turns += 1 + len(row[1]) // 16
    if rows:
        yield (part << 24) + n, Shard(rows, before, after)


def _sorted(segments: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """The rows in trie order, range-partitioned and checkpointed, and the turns that partitions share with their neighbours."""
    order = ["root", "path", "more", "conv_id"]
    rows = segments.select(*FIELDS, "segment").repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()

    def ends(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first = last = None
        for b in batches:
            if len(b):
                first, last = first or b.slice(0, 1), b.slice(len(b) - 1)
        if first is not None:
            a, z = first.to_pylist()[0], last.to_pylist()[0]
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "r1": a["root"], "p1": a["path"], "r2": z["root"], "p2": z["path"]}])

    at = Window.orderBy("part")                          # one row per partition
    near = rows.select("root", "path").mapInArrow(ends, "part long, r1 string, p1 binary, r2 string, p2 binary").select(
        "part", F.lag("r2").over(at).alias("r0"), F.lag("p2").over(at).alias("p0"), "r1", "p1", "r2", "p2", F.lead("r1").over(at).alias("r3"), F.lead("p1").over(at).alias("p3"))
    both = near.select("part", _shared("r0", "p0", "r1", "p1").alias("before"), _shared("r2", "p2", "r3", "p3").alias("after"))
    return rows, {r.part: (r.before, r.after) for r in both.toLocalIterator()}


def _shared(root_a: str, a: str, root_b: str, b: str) -> Column:
    n = F.floor(F.least(F.octet_length(a), F.octet_length(b)) / 16).cast("int")
    same = F.filter(F.sequence(F.lit(1), n), lambda k: F.substring(F.col(a), F.lit(1), 16 * k) == F.substring(F.col(b), F.lit(1), 16 * k))
    return F.when(F.col(root_a) == F.col(root_b), F.when(n > 0, F.size(same)).otherwise(0)).otherwise(-1)


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, d, digest, size)``: every turn's place in its conversation (from 1), a digest of role and text, and the text's bytes.

    Null turns come first; turns of equal number follow each other by digest.
    A null role or text is empty. Rows without a conversation are left out.
    No task gathers a whole conversation, however long.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rows = rows.where("conv_id is not null")
    return positions(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], name="d").select("conv_id", "d", "digest", "size")


def spliced(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt as branches of the first of their group, from the rows of ``numbered``.

    Conversation c gets the first ``h`` turns of conversation c - c % group
    (all if fewer, none if absent), then its own after its first h;
    h is the CRC-32 of c's decimal digits modulo ``most``. The result has one
    more row per conversation, at place 0 and without a digest.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    turns = turns.withColumn("h", h)
    convs = turns.where("d = 1").select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = turns.where((F.col("d") < most) & (F.col("conv_id") % group == 0)).select(F.col("conv_id").alias("base"), "d", "digest", "size")
    taken = convs.join(heads, "base").where("d <= h").select("conv_id", "d", "digest", "size").checkpoint()
    n_taken = taken.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n_taken"))
    rest = join_on_keys(turns.where("d > h"), n_taken, [("conv_id", "c")], "left").select(
        "conv_id", (F.col("d") - F.col("h") + F.coalesce("n_taken", F.lit(0))).alias("d"), "digest", "size")
    marks = convs.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("size"))
    return marks.unionByName(taken).unionByName(rest)


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, held_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct sequence of first turns: the trie's nodes, the textless root among them.

    ``turns`` has ``(conv_id, d, digest, size)`` with d from 1 without gaps,
    and a row at d = 0 for every conversation (see ``spliced``); turnless
    conversations end at the root. Result: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (the parent's conv_id; null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the
    subtree: members but one times the bytes of the node's last text) and
    ``ends_sha256`` of the ids, ascending and joined by commas, of members
    that end there. An empty table gives none.
    """
    spark = turns.sparkSession
    checkpoint_dir(spark)
    seg = F.when(F.col("d") > 0, F.floor((F.col("d") - 1) / segment)).otherwise(0).cast("int")
    rows = turns.groupBy("conv_id", seg.alias("segment")).agg(F.sort_array(F.collect_list(F.when(F.col("d") > 0, F.struct("d", "digest", "size")))).alias("t"))
    rows = rows.select("conv_id", "segment", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.size").alias("sizes"),
                       F.aggregate("t.size", F.lit(0).cast("long"), lambda a, x: a + x).alias("all_bytes"))
    walk = Window.partitionBy("conv_id").orderBy("segment")
    upto, behind = walk.rowsBetween(Window.unboundedPreceding, 0), walk.rowsBetween(1, Window.unboundedFollowing)
    sums = [F.sum(F.xxhash64(F.lit(k), "segment", "path").cast("decimal(20,0)")).over(upto) for k in (1, 2)]
    own = F.when(F.octet_length("path") == 16 * segment, F.concat_ws("|", F.col("segment") + 1, *sums))
    rows = rows.withColumns({"next_root": own, "more": F.lead("segment").over(walk).isNotNull(), "below_bytes": F.coalesce(F.sum("all_bytes").over(behind), F.lit(0))})
    rows = rows.withColumns({"root": F.coalesce(F.lag("next_root").over(walk), F.lit("0|0|0")), "below_opened": F.lit(0).cast("long"), "below_leaves": F.lit(0).cast("long")})
    table, edges = _sorted(rows)
    if not table.where("more").isEmpty():                # some conversation has more than one segment
        def opened(batches):
            import pyarrow as pa

            for _, shard in _shards((b.select(FIELDS) for b in batches), edges, held_turns):
                found = zip(shard.rows, shard.opened().tolist(), shard.ends_open().tolist())
                found = [{"c": r[3], "s": int(r[0].split("|")[0]), "opened": x, "leaves": int(y)} for r, x, y in found if r[2] or not r[0].startswith("0|")]
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema([("c", pa.int64()), ("s", pa.int32()), ("opened", pa.int64()), ("leaves", pa.int64())]))

        later = Window.partitionBy("c").orderBy("s").rowsBetween(1, Window.unboundedFollowing)
        below = table.mapInArrow(opened, "c long, s int, opened long, leaves long").select("c", "s", *(F.sum(x).over(later).alias(x) for x in ("opened", "leaves")))
        rows = table.join(below, (F.col("conv_id") == F.col("c")) & (F.col("segment") == F.col("s")), "left").withColumns(
            {"below_opened": F.coalesce("opened", F.lit(0)), "below_leaves": F.coalesce("leaves", F.lit(0))})
        table, edges = _sorted(rows)

    def build(batches):
        import pyarrow as pa

        for number, shard in _shards((b.select(FIELDS) for b in batches), edges, held_turns):
            held = []
            for node in shard.nodes(segment):
                held.append({"shard": number, **node})
                if len(held) == 10_000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    import pyarrow as pa

    words = {"key", "parent_key", "ends_sha256", "ids"}
    names = ("shard", "key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "ids")
    schema = pa.schema([(c, pa.string() if c in words else pa.int64()) for c in names])
    nodes = table.mapInArrow(build, ", ".join(f"{c} {'string' if c in words else 'long'}" for c in names)).checkpoint()
    parts = nodes.where("key is not null")
    spine = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.max("parent_conv_id").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    spine = spine.join(_joined(parts), "key", "left")
    tops = small_side(spine.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv")))
    every = nodes.where("key is null").drop("shard", "ids").unionByName(spine)
    known = every.where("parent_key is null")
    asked = join_on_keys(every.where("parent_key is not null"), tops, [("parent_key", "above")], "left").withColumn("parent_conv_id", F.col("above_conv")).drop("above", "above_conv")
    return known.unionByName(asked).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                           F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def _joined(parts: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: the hash over a spine node's ids, which its shards hold in ascending order; ids are streamed, never held together."""
    chunks = parts.where("ids is not null").select("key", "shard", "ids").repartition("key").sortWithinPartitions("key", "shard")

    def run(batches):
        import pyarrow as pa

        now = state = None
        for b in batches:
            done = []
            for key, _, ids in zip(*(c.to_pylist() for c in b.columns)):
                if key == now:
                    state.update(b",")
                else:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (now, state.hexdigest())], ["key", "ends_sha256"])

    return chunks.mapInArrow(run, "key string, ends_sha256 string")
