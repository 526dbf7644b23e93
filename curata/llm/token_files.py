"""Token files: frequency-ranked ids in a byte-aligned variable-length code (operator 12).

Documents are encoded once, range-partitioned and sorted by id, and every task
writes its range as files of its own. Files, taken in manifest order, hold the
documents in ascending id order (null first). One file holds, little-endian:

    magic 4 bytes | n_docs, n_tokens, n_ranks, n_control, n_data as uint64
    doc ids int64[n_docs] | id is null uint8[n_docs] | tokens int64[n_docs]
    ranks uint32[n_ranks]: the file's token ids, most frequent first (ties: smaller id first)
    control uint8[n_control]: four 2-bit codes a byte, lowest bits first: value bytes - 1
    data uint8[n_data]: the ranks of all tokens in one to four bytes each

The rank table belongs to its file, so no pass over all tokens comes before
the writing, and a file can be read alone. A control byte and a numpy table
give the lengths of four values; their prefix sum gives every value's place.

Executors write straight to the shared folder (any store that
``pyarrow.fs.FileSystem.from_uri`` opens). Each attempt writes under a new
name and only the manifest, a Parquet table that Spark commits at the end,
says which files count: a repeated task or a lost executor leaves files that
no reader looks at.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.llm.hashing import mix, text_slices
from curata.operators.joins import small_side

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 0                      # appended to every document
FILE_TOKENS = 16_000_000        # a file is closed when it holds so many (a longer document has a file to itself)
CHUNK = 1 << 20                 # tokens coded or decoded at a time; a multiple of 4
TABLE_BITS = 22                 # 2**22 places in a worker's table of known pieces; it starts anew when half full
MAGIC = b"RVB1"

LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)

#: Blocks of characters whose classes every Unicode version agrees on (first, last); a text with any other goes through the library whole.
SETTLED = ((0x00, 0x1B), (0x20, 0x84), (0x86, 0x52F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF), (0x3001, 0x3029), (0x3041, 0x3096),
           (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
LETTER, NUMBER, OTHER, SPACE, END, UNSETTLED = range(6)

_loaded: dict[str, "Encoder"] = {}


def _classes() -> np.ndarray:
    out = np.full(0x10000, UNSETTLED, dtype=np.uint8)
    for first, last in SETTLED:
        for c in range(first, last + 1):
            kind = unicodedata.category(chr(c))[0]
            out[c] = SPACE if chr(c).isspace() else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    return out


CLASS = _classes()


def piece_starts(chars: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """For every character whether a piece begins there, by the byte-level vocabularies' split before merges.

    A piece is a run of letters, of digits or of other marks, with the one
    blank before it; or white space, of which the last character before a
    run is a piece of its own unless it is such a blank; or one of the
    endings 's 't 'm 'd 're 've 'll where an apostrophe would begin a run.
    ``kind`` is ``END`` where a text ends, and END is a piece.
    """
    before = np.concatenate(([END], kind[:-1])).astype(np.uint8)
    after = np.concatenate((kind[1:], [END])).astype(np.uint8)
    start = (kind != before) | (kind == END)
    last_space = (kind == SPACE) & (after < SPACE)
    start |= last_space                                                        # the space right before a run
    blank = last_space & (chars == 32)
    start[1:] &= ~blank[:-1]                                                   # which a blank joins
    mark = np.flatnonzero((chars == 39) & start & (after == LETTER))           # an apostrophe at the begin of a run of one mark
    if len(mark):
        one, two = chars[mark + 1], chars[np.minimum(mark + 2, len(chars) - 1)]
        short = (one == 115) | (one == 116) | (one == 109) | (one == 100)                                     # s t m d
        long = ((two == 101) & ((one == 114) | (one == 118)) | (one == 108) & (two == 108))                   # re ve ll
        for hit, size in ((short, 2), (long, 3)):
            m = mark[hit]
            start[m + 1] = False
            m = m[m + size < len(chars)]
            start[m + size] = True
    return start


class Encoder:
    """Ids of whole texts from a byte-level ``tokenizers`` file, as the library gives them without special tokens.

    No merge crosses a piece of the split, so a text's ids are those of its
    pieces one after another. The library spends most of its time on the
    split and on alignments that nobody asks for here; so pieces are found
    with numpy over a batch of texts, and a distinct piece goes through the
    library once per worker. Pieces up to 16 bytes are looked up, as they
    are, in an open-addressing table of numpy arrays, longer ones in a dict.
    Texts with a character outside ``SETTLED`` or a special token's string
    go through the library whole.
    """

    def __init__(self, path: str, table_bits: int = TABLE_BITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = 1 << table_bits
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros((2, self.size), dtype=np.uint64)
        self.bytes = np.zeros(self.size, dtype=np.uint8)         # 0: an empty place
        self.entry = np.zeros(self.size, dtype=np.int64)
        self.first = np.zeros(1, dtype=np.int64)                 # of each entry's ids, and the end
        self.ids = np.zeros(0, dtype=np.uint32)
        self.long: dict[bytes, int] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """New entries for ``pieces``; their numbers."""
        found = [e.ids for e in self.library.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)]
        n = len(self.first) - 1
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)))
        self.ids = np.concatenate((self.ids, np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32)))
        return np.arange(n, n + len(pieces))

    def _find(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where the table has none."""
        out = np.full(len(a), -1, dtype=np.int64)
        left, place = np.arange(len(a)), place.copy()
        while len(left):
            there = self.bytes[place]
            same = (there == size[left]) & (self.key[0, place] == a[left]) & (self.key[1, place] == b[left])
            out[left[same]] = self.entry[place[same]]
            on = ~same & (there != 0)
            left, place = left[on], (place[on] + 1) & (self.size - 1)
        return out

    def _put(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, place: np.ndarray, entry: np.ndarray) -> None:
        left, place = np.arange(len(a)), place.copy()
        while len(left):
            free = np.flatnonzero(self.bytes[place] == 0)
            at, one = np.unique(place[free], return_index=True)
            k = left[free[one]]
            self.key[0, at], self.key[1, at], self.bytes[at], self.entry[at] = a[k], b[k], size[k], entry[k]
            on = np.ones(len(left), dtype=bool)
            on[free[one]] = False
            left, place = left[on], (place[on] + 1) & (self.size - 1)

    def _entries(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of every piece of ``data`` (16 spare bytes at its end); unknown ones are added."""
        out = np.zeros(len(start), dtype=np.int64)
        word = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))         # the 8 bytes from each place on
        short = np.flatnonzero(size <= 16)
        s, n = start[short], size[short].astype(np.uint64)
        keep = lambda x, k: np.where(k >= 8, x, x & ((np.uint64(1) << (np.uint64(8) * np.minimum(k, np.uint64(7)))) - np.uint64(1)))
        a = keep(word[s], n)
        b = keep(word[s + 8], np.where(n > 8, n - np.minimum(n, np.uint64(8)), np.uint64(0)))
        h = mix(a + mix(b + n))
        place = (h & np.uint64(self.size - 1)).astype(np.int64)
        n = n.astype(np.uint8)
        found = self._find(a, b, n, place)
        new = np.flatnonzero(found < 0)
        if len(new):
            if len(self.first) + len(new) > self.size // 2:
                self.clear()
                new = np.arange(len(found))
            _, one, back = np.unique(np.rec.fromarrays((h[new], a[new], b[new], n[new])), return_index=True, return_inverse=True)
            k = new[one]
            raw = data.tobytes()
            if len(k) > self.size // 2:                          # more distinct pieces in one slice than the table may hold
                raise ValueError("the table of pieces is too small for the slices")
            entry = self._add([raw[i:i + j] for i, j in zip(s[k].tolist(), n[k].tolist())])
            self._put(a[k], b[k], n[k], place[k], entry)
            found[new] = entry[back]
        out[short] = found
        rest = np.flatnonzero(size > 16)
        if len(rest):
            pieces = [data[i:i + j].tobytes() for i, j in zip(start[rest].tolist(), size[rest].tolist())]
            unknown = [p for p in dict.fromkeys(pieces) if p not in self.long]
            self.long.update(zip(unknown, self._add(unknown).tolist()))
            out[rest] = [self.long[p] for p in pieces]
        return out

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text as uint32."""
        joined = "\n".join([*texts, ""])
        try:
            chars = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        except UnicodeEncodeError:                               # lone surrogates: not text for the library either
            return self([t.encode("utf-8", "replace").decode("utf-8") for t in texts])
        kind = CLASS[np.minimum(chars, 0xFFFF)]
        kind[chars > 0xFFFF] = UNSETTLED
        stop = np.cumsum([len(t) + 1 for t in texts]) - 1        # where the texts end
        kind[stop] = END
        whole = np.zeros(len(texts), dtype=bool)
        whole[np.searchsorted(stop, np.flatnonzero(kind == UNSETTLED))] = True
        for special in self.specials:
            if special in joined:
                whole |= np.array([special in t for t in texts])
        begin = np.flatnonzero(piece_starts(chars, kind))
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        at = np.cumsum(width) - width
        of = np.searchsorted(stop, begin)                        # the text of each piece
        use = (kind[begin] != END) & ~whole[of]
        lo = at[begin]
        size = np.diff(np.concatenate((lo, [at[-1] + 1])))
        data = np.frombuffer(joined.encode("utf-8") + bytes(16), dtype=np.uint8)
        entry = self._entries(data, lo[use], size[use])
        n = np.diff(self.first)[entry]
        end = np.cumsum(n)
        ids = self.ids[np.repeat(self.first[entry] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        cut = np.concatenate(([0], end))[np.searchsorted(of[use], np.arange(len(texts) + 1))]
        out = [ids[cut[k]:cut[k + 1]] for k in range(len(texts))]
        for k in np.flatnonzero(whole):
            out[k] = self._whole(texts[k])
        if len(self.long) > self.size // 16:
            self.clear()
        return out


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """``(control, data)`` of unsigned 32-bit values; their number should be a multiple of 4 unless they end the stream."""
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    code = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    code[:len(values)] = size - 1
    four = code.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    octets = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """The first ``n`` values, and the bytes of ``data`` they took."""
    size = LENGTHS[control[:-(-n // 4)]].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    used = int(end[-1]) if n else 0
    out = data[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out, used


def file_bytes(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A whole file's content."""
    count = np.array([len(x) for x in ids], dtype="<i8")
    every = np.concatenate([np.zeros(0, dtype=np.uint32), *ids])
    n = np.bincount(every) if len(every) else np.zeros(0, dtype=np.int64)
    ranked = np.flatnonzero(n)
    ranked = ranked[np.lexsort((ranked, -n[ranked]))].astype("<u4")
    rank = np.zeros(len(n), dtype=np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    parts = [pack(rank[every[i:i + CHUNK]]) for i in range(0, len(every), CHUNK)]
    control, data = b"".join(p[0] for p in parts), b"".join(p[1] for p in parts)
    head = np.array([len(doc_ids), len(every), len(ranked), len(control), len(data)], dtype="<u8")
    own = np.array([d or 0 for d in doc_ids], dtype="<i8")
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    return b"".join([MAGIC, head.tobytes(), own.tobytes(), null.tobytes(), count.tobytes(), ranked.tobytes(), control, data])


def read_file(content: bytes):
    """``(doc_id, ids)`` of every document of a file, in order; decodes ``CHUNK`` tokens at a time."""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_tokens, n_ranks, n_control, n_data = (int(x) for x in np.frombuffer(content, "<u8", 5, 4))
    at = 44

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(content, kind, n, at)
        at += out.nbytes
        return out

    own, null, count, ranked = take("<i8", n_docs), take("u1", n_docs), take("<i8", n_docs), take("<u4", n_ranks)
    control, data = take("u1", n_control), take("u1", n_data)
    if at != len(content) or int(count.sum()) != n_tokens:
        raise ValueError("a token file is damaged")
    have, done = np.zeros(0, dtype=np.uint32), 0
    for k in range(n_docs):
        parts, need = [], int(count[k])
        while need > len(have):
            parts.append(have)
            need -= len(have)
            n = min(CHUNK, n_tokens - done)
            value, used = unpack(control[done // 4:], data, n)
            have, data, done = ranked[value], data[used:], done + n
        parts.append(have[:need])
        have = have[need:]
        yield (None if null[k] else int(own[k])), (parts[0] if len(parts) == 1 else np.concatenate(parts))


def write(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, end_id: int | None = END_ID,
          file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``docs`` as token files below ``folder`` and return the manifest ``(task, file, path, n_docs, n_tokens)``, one row per file.

    Every row becomes one document: its text's ids and ``end_id`` (if not
    None). A null text is empty. The ids in column ``doc_id`` must be
    integers; null comes first, and rows of one id follow each other in the
    order of a hash of their texts (equal rows are interchangeable), so many
    rows of one id spread over tasks. Other columns are ignored. An empty
    table writes an empty manifest.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    src = src.withColumns({"h": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("spread").asc()]
    ranged = src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def save(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task, encode = TaskContext.get().partitionId(), encoder(path)
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        own: list[int | None] = []
        ids: list[np.ndarray] = []
        held = n_files = 0

        def close():
            nonlocal held, n_files
            name = f"{base}/{task:07d}-{n_files:05d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(name) as out:
                out.write(file_bytes(own, ids))
            row = pa.RecordBatch.from_pylist([{"task": task, "file": n_files, "path": name.rsplit("/", 1)[1], "n_docs": len(own), "n_tokens": held}])
            own.clear()
            ids.clear()
            held, n_files = 0, n_files + 1
            return row

        for b in batches:
            for lo, hi in text_slices(b.column(1)):
                texts = [t or "" for t in b.column(1)[lo:hi].to_pylist()]
                for d, found in zip(b.column(0)[lo:hi].to_pylist(), encode(texts)):
                    found = np.concatenate([found, end])
                    if own and held + len(found) > file_tokens:
                        yield close()
                    own.append(d)
                    ids.append(found)
                    held += len(found)
        if own:
            yield close()

    manifest = ranged.mapInArrow(save, "task long, file long, path string, n_docs long, n_tokens long")
    manifest.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of token files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian uint32 bytes).

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the
    CRC-32 of the ids as little-endian uint32. Files are dealt out to tasks by
    the manifest; the offsets of files are prefix sums over the manifest,
    which has one row for some ``FILE_TOKENS`` tokens.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"))
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def load(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)]
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{base}/{name}") as file:
                    content = file.read()
                rows, held = [], 0
                for d, ids in read_file(content):
                    raw = ids.astype("<u4").tobytes()
                    rows.append((d, start, len(ids), zlib.crc32(raw), raw)[:len(kinds)])
                    start, held = start + len(ids), held + with_ids * len(raw)
                    if len(rows) >= 10_000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    n = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return small_side(starts).repartition(n).mapInArrow(load, fields)
