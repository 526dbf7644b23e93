"""Token files: exact round trip, equality with the library's own encoding of whole texts, and the written format."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curata.llm import token_files as T
from curata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n", "it's  we'll\n\n  q ", "''s 's 'store x'll' 'S", "a<|endoftext|>b", "\u1234 \U0001F600 y", "\x1c a\x85b", "\u65e5\u672c 123\uff14",
       "a" * 300 + " " + "b" * 40, "   a \xa0\u3000b", "\u00e9\u0301 \u00b2\u00bc", "'", "x'", "x're", "x'r"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.TOKENIZER)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_librarys_ids(library):
    rng = random.Random(5)
    chars = [chr(c) for c in range(0x530)] + list("\u2010\u2030\u20ac\u3001\u4e00\uac00\u1234\U0001F600")
    texts = ODD + ["".join(rng.choice(chars) if rng.random() < 0.2 else rng.choice(" \n\'sa1.\u00e9lredmtv") for _ in range(rng.choice([1, 2, 12, 30])))
                   for _ in range(3000)]
    small = T.Encoder(T.TOKENIZER, table_bits=13)          # fills up and starts anew
    for i in range(0, len(texts), 100):
        for text, found in zip(texts[i:i + 100], small(texts[i:i + 100])):
            assert found.tolist() == ids_of(library, text), text


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_code_round_trip(n):
    values = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32) >> np.random.default_rng(n + 1).integers(0, 32, n, dtype=np.uint32)
    control, data = T.pack(values)
    assert len(control) == -(-n // 4)
    back, used = T.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
    assert (back == values).all() and used == len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in values)


def test_file_format():
    ids = [np.array([7, 300, 7], dtype=np.uint32), np.array([], dtype=np.uint32), np.array([7, 70000], dtype=np.uint32)]
    raw = T.file_bytes([5, None, 6], ids)
    assert struct.unpack("<4s5Q", raw[:44]) == (b"RVB1", 3, 5, 3, 2, 5)
    assert struct.unpack("<3I", raw[44 + 24 + 3 + 24:][:12]) == (7, 300, 70000)       # most frequent first, ties by id
    assert [(d, x.tolist()) for d, x in T.read_file(raw)] == [(5, [7, 300, 7]), (None, []), (6, [7, 70000])]
    with pytest.raises(ValueError):
        list(T.read_file(raw[:-1]))


def test_documents_longer_than_a_chunk(monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 8)
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (3, 0, 50, 1, 8, 8, 7)]
    back = list(T.read_file(T.file_bytes(list(range(7)), ids)))
    assert all((a == b[1]).all() for a, b in zip(ids, back))


def expected(library, rows):
    out, start = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(library, text) + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(library, rows)


def test_small_files_nulls_repeats_and_clashing_columns(spark, library, scratch):
    rows = [(k % 9 if k % 7 else None, t, 1, 2) for k, t in enumerate([*ODD, None, "same", "same"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, start int, h int").repartition(3)
    manifest = T.write(docs, f"file://{scratch}/out", file_tokens=20)
    assert manifest.count() > 9 and manifest.agg(F.sum("n_docs")).first()[0] == len(rows)
    got = T.read(spark, f"file://{scratch}/out", with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    want = sorted((str(r[0]), tuple(ids_of(library, r[1]) + [0])) for r in rows)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)


def test_files_outside_the_manifest_do_not_count(spark, scratch):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    name = T.write(docs, f"{scratch}/out").first().path
    with open(f"{scratch}/out/{name}", "rb") as f:
        content = f.read()
    with open(f"{scratch}/out/0000000-00000-lost.tok", "wb") as f:
        f.write(content)
    assert T.read(spark, f"{scratch}/out").count() == 1


def test_empty_table(spark, scratch):
    T.write(spark.createDataFrame([], "doc_id long, text string"), f"{scratch}/out")
    assert T.read(spark, f"{scratch}/out").collect() == []
