"""Base metrics against a plain loop; the cascade keeps its verdict in any order."""

import re

from pyspark.sql import functions as F

from curata.llm.quality_cascade import BASE_COLUMNS, Rule, base_metrics, cascade, default_rules, judge, rule_order


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
TEXTS = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "l1\nl1\n\nl2\r\nl1\n \n \n", PROSE, PROSE.upper(),
         PROSE.replace(" ", "%%% "), "\n".join([PROSE] * 3), "- a\n" * 60, "1 2 3 4 5 6 " + PROSE, "𝒳 y z é́ " * 3, "%" * 50000 + " " + PROSE,
         "very long " * 40000, PROSE + "\n" + PROSE]


def test_base_metrics(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(9, TEXTS[9]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash")).withColumn("_t", F.lit(0)).drop("_t")
    got = {r.doc_id: tuple(r[c] for c in BASE_COLUMNS) for r in base_metrics(docs).collect()}
    for i, t in rows:
        assert got[i] == brute(t), (i, t and t[:50])


def test_verdicts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in judge(docs).collect()}
    assert [i for i, k in kept.items() if k] == [9, 14] and len(kept) == len(TEXTS)
    base = base_metrics(docs)
    again = {r.doc_id: r.kept for r in cascade(base, [Rule("b", F.col("base_failed")), *reversed(default_rules())], rejected_by="why").collect()}
    assert again == kept


#: Prose of scripts without case, each with acronyms.
UNCASED = [" ".join(w + chr(ord(first) + i) for i in range(26) for w in ws.split()) + end for ws, first, end in (
    ("회사는 올해 새로운", "가", " LG AI NATO"), ("الشركة تعلن اليوم", "ا", " NATO AI"), ("החברה הודיעה היום", "א", " IBM"), ("कंपनी आज नई", "क", " AI NATO"))]


def test_uncased_scripts_with_acronyms_are_kept(spark):
    texts = [*UNCASED, PROSE.upper(), PROSE.upper() + " " + "회사는 " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    why = {r.doc_id: r.why for r in cascade(base_metrics(docs), default_rules(), rejected_by="why").collect()}
    assert [why[i] for i in range(len(texts))] == [None] * 4 + ["capitals"] * 2


#: Short documents with line marks: long lines that end in an ellipsis, dialogue after a dash, marks before other line breaks than \n.
FEW_LINES = [PROSE + "...", PROSE + " …\n", PROSE + "...\n" + PROSE[::-1], "- " + PROSE, "• " + PROSE + "\r\n- " + PROSE[::-1],
             PROSE + "...\u2028a...\u2028b...\u2028c...\u0085d...\re", PROSE + "\n" + PROSE[::-1] + "\r- a\r- b\u0085- c\u2028- d"]
MANY_LINES = ["\n".join(f"- {PROSE[i:]}" for i in (0, 1, 2)), "\n".join(f"{PROSE[i:]}...\r" for i in (0, 2, 4)) + "\n" + "\n".join(PROSE[i:] for i in (1, 3, 5))]


def test_line_rules_need_three_lines(spark):
    texts = [*FEW_LINES, *MANY_LINES]
    rules = [r for r in default_rules() if r.name in ("bullet_lines", "open_lines")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    why = {r.doc_id: r.why for r in cascade(base_metrics(docs), rules, rejected_by="why").collect()}
    assert [why[i] for i in range(len(texts))] == [None] * len(FEW_LINES) + ["bullet_lines", "open_lines"]
    assert judge(docs.where(F.col("doc_id") < 2)).where("kept").count() == 2


#: Prose without spaces between words, in runs as long as a line, and as one text.
UNSPACED = ["\n".join("".join(chr(first + (7 * i + i * i * k) % span) for i in range(40 + k)) for k in range(70)) + end
            for first, span, end in ((0x4E00, 900, ""), (0x3042, 70, " AI"), (0x0E01, 40, ""))]


def test_sql_states_the_same_rules(spark):
    """The registered SQL on planted documents: scripts without case or spaces, acronyms, dashes, ellipses, lists."""
    import duckdb

    from curata.llm.queries import ORACLE

    texts = [*TEXTS, *UNCASED, *FEW_LINES, *MANY_LINES, *UNSPACED, "x" * 900 + " " + PROSE]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in judge(docs).select("doc_id", *BASE_COLUMNS, "base_failed", "kept").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = sorted(con.sql(ORACLE["op9_quality_cascade"]).fetchall())
    assert got == want
    kept = {r[0] for r in got if r[-1]}
    first = len(TEXTS)
    assert set(range(first, first + len(UNCASED) + len(FEW_LINES))) <= kept and not kept & set(range(first + 11, first + 13))
    assert set(range(first + 13, first + 16)) <= kept and first + 16 not in kept


def test_order_prefers_rejections_per_cost(spark):
    docs = spark.createDataFrame([(i, PROSE) for i in range(50)], "doc_id long, text string")
    order = rule_order(docs.checkpoint(), [Rule("never", F.lit(False)), Rule("always", F.col("doc_id") >= 0)])
    assert [r.name for r, _, _ in order] == ["always", "never"] and order[0][2] == 1.0


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0
