"""Quality rules as a short-circuit cascade (operator 9), in DataFrame expressions only.

A rule is a boolean column that is true for a document to reject. On a
bounded sample every rule is timed and its rejections counted; the rules
then run in the order of rejections per second, inside one ``CASE WHEN``, so
that Spark evaluates a rule only for the documents that all earlier rules
let pass. The order changes the cost, never the verdict: a document is kept
exactly if no rule rejects it. Only the sample is bounded; every rule is
defined on, and may run over, the whole of every text.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.words import BLANK, words
from curata.session import checkpoint_dir

SAMPLE_ROWS = 1000     # expected size of the sample that rules are timed on
SEED = 7

#: Scripts without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Fixed by the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def base_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five base metrics (long), ``n_lines`` (lines with a word) and ``base_failed``; same-named columns are replaced.

    A null text has no words, lines or symbols. ``n_repeat_words`` counts the
    words inside 3-word windows that occur twice or more in the text; equal
    windows are found by sorting their 64-bit hashes within the row.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words(t), lambda w: let(lines, lambda line: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, BLANK, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size(line).cast("long").alias("n_lines"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).cast("long").alias("n_repeat_words"))))
    keep = [c for c in docs.columns if c.lower() not in {*BASE_COLUMNS, "n_lines", "base_failed"}]
    # inline() is a node of its own: the counts are made once a row, however often later rules refer to them
    d = docs.select(*keep, F.inline(F.array(counts)))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, as a lambda's variable (a plain projection may be inlined into lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(w: Column) -> Column:
    window = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    # windows equal to a neighbour in hash order, back in text order
    twice = lambda s: F.sort_array(F.transform(F.filter(
        s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"]))
    covered = lambda at: F.aggregate(F.transform(
        at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0), lambda n, x: n + x)
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(F.sort_array(window), lambda s: let(twice(s), covered)))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on ``base_metrics`` and the whole text; each leaves ordinary prose of any language alone."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.col("n_words")
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    # a few such lines say nothing of a short document; (?d): only \n ends a line, as in n_lines
    share = lambda hits, tenths: let(hits, lambda n_hits: (n_hits >= 3) & (10 * n_hits > tenths * F.col("n_lines")))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 3) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))),
        # scripts that write no spaces between words: each of their letters counts as a word
        Rule("word_length", (F.col("word_chars") < 2 * n) | ((F.col("word_chars") > 15 * n) & (F.col("word_chars") > 15 * (n + count(UNSPACED))))),
        Rule("capitals", 2 * count(r"\p{Lu}") > count(r"\p{L}")),      # of all letters: many scripts have no lower case
        Rule("words_without_letters", 5 * count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])") > n),
        Rule("bullet_lines", share(count(r"(?md)^[\x20\x09]*[-*•◦‣]"), 9)),
        Rule("open_lines", share(count(r"(?md)(?:\.\.\.|…)[\x20\x09\r]*$"), 3)),
    ]


def rule_order(sample: DataFrame, rules: list[Rule], times: int = 20) -> list[tuple[Rule, float, float]]:
    """``(rule, seconds, rejected share)`` on a materialised sample, most rejections per second first.

    A rule's cost is the time of a job over ``times`` copies of every sample
    row less the time of the same job without the rule, so that what a job
    costs in itself doesn't count.
    """
    rows = sample.count()
    if not rows:
        return [(r, 0.0, 0.0) for r in rules]
    many = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))

    def timed(rejects: Column) -> tuple[float, int]:
        # the copy's number in the condition keeps Spark from evaluating it once per row
        probe = many.agg(F.count_if(rejects & (F.col("copy") > 0)), F.max("copy"))
        seconds = []
        for _ in range(2):                       # the first run also compiles the plan
            began = time.perf_counter()
            rejected = probe.first()[0]
            seconds.append(time.perf_counter() - began)
        return min(seconds), rejected

    empty, _ = timed(F.lit(False))
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects)
        found.append((rule, max((seconds - empty) / times, 1e-6), rejected / times / rows))
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(docs: DataFrame, rules: list[Rule], verdict: str = "kept", rejected_by: str | None = None) -> DataFrame:
    """``docs`` with ``verdict``: true if no rule rejects the row (a rule that gives null doesn't).

    The rules run in the given order, each only on rows that the earlier ones
    let pass. ``rejected_by`` names a column for the first rule that rejects.
    """
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(rule.rejects, F.lit(rule.name)).otherwise(first)
    if rejected_by:
        docs = docs.withColumn(rejected_by, first)
        first = F.col(rejected_by)
    return docs.withColumn(verdict, first.isNull())


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the base metrics, ``n_lines``, ``base_failed`` and ``kept``.

    A row is kept unless ``base_failed`` or one of ``rules`` rejects it. Null
    and empty texts fail the base rule; repeated rows are judged alike;
    same-named input columns are replaced; an empty table gives none.
    """
    rules = default_rules(text) if rules is None else rules
    checkpoint_dir(docs.sparkSession)
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = base_metrics(docs.sample(share, SEED), text).where(~F.col("base_failed")).checkpoint()
    order = [r for r, _, _ in rule_order(sample, rules)]
    return cascade(base_metrics(docs, text), [Rule("base", F.col("base_failed")), *order])
