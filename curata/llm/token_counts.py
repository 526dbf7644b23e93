"""Token counts by section from one encoding of the whole document (operator 7).

A document is encoded once, as a whole. The tokens of a byte-level vocabulary
are byte strings that concatenate to the text, so the prefix sums of their
lengths are every token's exact byte span. The sections' spans are found in
the same bytes, and an interval join (both sides are sorted, so a binary
search) maps tokens to sections.

Sections are the lines of the text: section k runs from the start of line k
up to the start of the next, its line break included, so sections tile the
text. A token that crosses a boundary is allocated by ``rule``:

* ``"most"``: to the section with most of its bytes, the earliest at a tie;
* ``"start"``: to the section of its first byte;
* ``"split"``: to each section by its share of the token's bytes.

Under every rule a document's sections sum to its number of tokens.
"""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern of this vocabulary that splits text before merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("most", "start", "split")

_loaded: dict[tuple[str, str], tuple] = {}


def tokenizer(path: str, pattern: str = PATTERN):
    """``(encoding, byte length by token id)`` of a rank file, loaded once in a Python worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _loaded[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size
    return _loaded[path, pattern]


def allocate(tokens: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, as doubles; both arrays hold boundaries from 0 to the text's length (tokens have bytes; sections may be empty)."""
    n = len(sections) - 1
    start, end = tokens[:-1], tokens[1:]
    first = np.searchsorted(sections, start, side="right") - 1
    if rule == "start" or not len(start):
        return np.bincount(first, minlength=n).astype(float)
    last = np.searchsorted(sections, end, side="left") - 1
    cross = np.flatnonzero(last > first)
    if rule == "most":
        for t in cross:
            inside = np.diff(np.clip(sections[first[t]:last[t] + 2], start[t], end[t]))
            first[t] += int(np.argmax(inside))
        return np.bincount(first, minlength=n).astype(float)
    out = np.bincount(np.delete(first, cross), minlength=n).astype(float)
    for t in cross:
        inside = np.diff(np.clip(sections[first[t]:last[t] + 2], start[t], end[t]))
        out[first[t]:last[t] + 1] += inside / (end[t] - start[t])
    return out


def section_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, pattern: str = PATTERN,
                   rule: str = "most") -> DataFrame:
    """One row per section of every document row: doc_id, section (from 0), start and end (code points), n_tokens, doc_tokens.

    ``n_tokens`` is a long, or a double under ``"split"``; ``doc_tokens`` is
    the whole document's count. A null or empty text has one empty section
    with no tokens. Repeated rows give repeated sections; other columns are
    ignored; an empty table gives none.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = "double" if rule == "split" else "long"
    schema = src.select("doc_id", *(F.lit(0).cast("long").alias(c) for c in ("section", "start", "end")), F.lit(0).cast(kind).alias("n_tokens"),
                        F.lit(0).cast("long").alias("doc_tokens")).schema
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def count(batches):
        import pyarrow as pa

        encoding, size = tokenizer(path, pattern)
        for b in batches:
            at, rows = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                data = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
                ids = encoding.encode_ordinary(t or "")
                tokens = np.concatenate(([0], np.cumsum(size[np.array(ids, dtype=np.int64)])))
                lines = np.concatenate(([0], np.flatnonzero(data == 10) + 1, [len(data)]))
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[lines]
                found = allocate(tokens, lines, rule)
                at.append(np.full(len(found), k))
                rows.append(np.column_stack((np.arange(len(found)), chars[:-1], chars[1:], found, np.full(len(found), len(ids)))))
                if sum(map(len, rows)) > 100_000 or k == len(b) - 1:
                    columns = np.concatenate(rows).T
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(np.concatenate(at))),
                         *(pa.array(c.astype(float if kinds[j] == pa.float64() else np.int64), kinds[j]) for j, c in enumerate(columns, 1))], schema.names)
                    at, rows = [], []

    return src.mapInArrow(count, schema)
