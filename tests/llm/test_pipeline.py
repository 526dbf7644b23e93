"""Every stage against brute force on its own input."""

import random
import re
import unicodedata

import corpus_pipeline
import pytest
from test_decontaminate import brute as leaks
from test_mixture import process
from test_ngram_join import brute as groups
from test_quality_cascade import UNCASED
from test_quality_cascade import brute as metrics

from curata.llm.words import WORD


def accepted(text):
    n, chars, symbols, dup, repeat = metrics(text)
    text = text or ""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    upper, letters = sum(unicodedata.category(c) == "Lu" for c in text), sum(c.isalpha() for c in text)
    letterless = sum(not any(c.isalpha() for c in w) for w in re.findall(WORD, text))
    bullets = sum(bool(re.match("[ \t]*[-*•◦‣]", x)) for x in text.split("\n"))
    cut = sum(bool(re.search(r"(\.\.\.|…)[ \t\r]*$", x)) for x in text.split("\n"))
    share = lambda k, tenths: k >= 3 and 10 * k > tenths * len(lines)
    return not (n < 50 or 2 * repeat > n or 10 * symbols > n or share(dup, 3) or chars < 2 * n or chars > 15 * n
                or 2 * upper > letters or 5 * letterless > n or share(bullets, 9) or share(cut, 3))


def made(spark, path):
    r = random.Random(8)
    word = ["".join(r.choices("abcdefghilmnoprstu", k=r.randint(2, 9))) for _ in range(500)]
    prose = lambda n: ". ".join(" ".join(r.choices(word, k=10)) for _ in range(n // 10))
    items = [(i, prose(30)) for i in range(5)]
    rows = []
    for i in range(40):
        rows.append((len(rows), prose(r.choice([20, 70, 150, 300])), "en", r.choice(["a", "b", "c", None]), 0))
    for i in range(15):
        base = rows[r.randrange(40)][1].split(" ")
        base[r.randrange(len(base))] = "changed"
        rows.append((len(rows), " ".join(base), "en", "a", 0))
    rows += [(len(rows) + i, rows[i][1], "en", "b", 0) for i in range(6)]
    rows += [(len(rows) + i, prose(100) + "\n" + items[i][1] + "\n" + prose(50), "en", "c", 0) for i in range(5)]
    rows += [(len(rows) + i, prose(100) + f" write to {word[i]}@mail.example.com or +1 (651) 555-850{i}", "en", "a", 0) for i in range(6)]
    rows += [(len(rows), None, "en", "a", None), (len(rows) + 1, "", None, "a", 0), (len(rows) + 2, prose(80).upper(), "en", "a", 0),
             (len(rows) + 4, "\n".join("- " + prose(30) for _ in range(4)), "en", "a", 0), (len(rows) + 5, "\n".join(prose(30) + "..." for _ in range(4)), "en", "a", 0),
             (len(rows) + 3, prose(80).replace(" ", "%%% "), "en", "a", 0), (3, rows[3][1], "en", "a", 0), (None, prose(90), "en", "b", 0)]
    rows.append(rows[60])
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return items


def test_stages(spark, scratch):
    items = made(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r)[:5] for r in docs.collect()]
        stage(spark, docs, scratch).write.parquet(f"{scratch}/out-{name}")
        docs = spark.read.parquet(f"{scratch}/out-{name}")
        assert docs.columns == columns or name == "source_mix"
        after = found[name] = docs.collect()
        kept = sorted((tuple(r)[:5] for r in after), key=str)
        if name == "quality_rules":
            assert kept == sorted((r for r in before if accepted(r[1])), key=str) and 0 < len(kept) < len(before)
        elif name == "near_duplicates":
            classes = groups([r[:2] for r in before])
            assert sorted((r[0] for r in kept), key=str) == sorted({c[1] for c in classes}, key=str) and len(kept) < len(before)
        elif name == "benchmark_leaks":
            bad = {d for d, _ in leaks([r[:2] for r in before], items)}
            assert len(bad) == 5 and kept == sorted((r for r in before if r[0] not in bad), key=str)
        elif name == "personal_data":
            old = {r[0]: r[1] for r in before}
            assert len(after) == len(before)
            for r in after:
                if "@" in old[r.doc_id]:
                    assert re.sub(r"write to .*", "", r.text) == re.sub(r"write to .*", "", old[r.doc_id]) and r.n_chars == len(r.text)
                    assert not re.search(r"write to (\S+)@mail", r.text) and r.text[-17:] != old[r.doc_id][-17:]
                else:
                    assert r.text == old[r.doc_id]
        else:
            sizes, taken = {}, {}
            for r in before:
                sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall(WORD, r[1]))
            for r in after:
                taken[r.source] = taken.get(r.source, 0) + r.taken
            assert taken == {s: int(t + 1e-9) for s, t in process(sizes).items()}
    again = sorted((tuple(r) for r in corpus_pipeline.run(spark, scratch).collect()), key=str)
    assert again == sorted((tuple(r) for r in found["source_mix"]), key=str)


def test_the_callers_key_decides(spark, scratch):
    docs = spark.createDataFrame([(1, "write to ann.lee@mail.example.com", "en", "a", 33)], "doc_id long, text string, lang string, source string, n_chars long")
    made = {}
    for key in (None, "one", "two", "one"):
        try:
            if key:
                spark.conf.set(corpus_pipeline.SURROGATE_KEY, key)
                text = corpus_pipeline.personal_data(spark, docs, scratch).first().text
            else:
                with pytest.warns(UserWarning, match="surrogateKey"):
                    text = corpus_pipeline.personal_data(spark, docs, scratch).first().text
        finally:
            spark.conf.unset(corpus_pipeline.SURROGATE_KEY)
        assert made.setdefault(key, text) == text
    assert len(set(made.values())) == 3


def test_clashing_columns_pass_every_stage(spark, scratch):
    from pyspark.sql import functions as F
    made(spark, scratch)
    clash = ["_mentions", "_key", "_first", "_digest", "row", "mentions", "key", "digest", "news"]
    docs = spark.read.parquet(f"{scratch}/documents.parquet").select("*", *[F.lit(c).alias(c) for c in clash])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, scratch).write.parquet(f"{scratch}/clash-{name}")
        docs = spark.read.parquet(f"{scratch}/clash-{name}")
        assert all(r[c] == c for r in docs.collect() for c in clash) and docs.count() > 0


def test_empty(spark, scratch):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, "an item of some words here")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_quality_stage_keeps_uncased_scripts(spark, scratch):
    docs = spark.createDataFrame([(i, t, "xx", "a", len(t)) for i, t in enumerate(UNCASED)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, scratch).collect()) == list(range(len(UNCASED)))
