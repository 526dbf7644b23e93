"""Registered queries of the pipeline operators: ``opN_<name>`` over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import conversation_trie, decontaminate, html_density, license_scan, mixture, ngram_join, pii, quality_cascade, spelling_variants, token_counts, token_files, url_rules, warc_revisit
from curata.session import scratch_path


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(_t(spark, sf_dir, "documents").select("doc_id", "text"), counts="n_mentions")


def op3_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(_t(spark, sf_dir, "pages"))


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve(warc_revisit.crawl_records(_t(spark, sf_dir, "pages")))
    header = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(header, "\n")).withColumn("at_second", F.unix_seconds("at")).drop("at")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(_t(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_t(spark, sf_dir, "pages")).drop("matched_by")


def op7_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(_t(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_t(spark, sf_dir, "documents"))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_cascade.judge(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_cascade.BASE_COLUMNS, "base_failed", "kept")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_t(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(conversation_trie.spliced(conversation_trie.numbered(_t(spark, sf_dir, "conversations"))))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write(_t(spark, sf_dir, "documents"), folder)
    return token_files.read(spark, folder)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(_t(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_surrogates": op2_surrogates,
    "op3_html_density": op3_html_density,
    "op4_revisits": op4_revisits,
    "op5_source_mix": op5_source_mix,
    "op6_url_rules": op6_url_rules,
    "op7_section_tokens": op7_section_tokens,
    "op8_license_scan": op8_license_scan,
    "op9_quality_cascade": op9_quality_cascade,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op4_revisits": r"""
        WITH p AS (SELECT page_id AS n, url, coalesce(html, '') AS html FROM pages),
        x AS (SELECT *, '"' || md5(html)[1:12] || '"' AS tag, 'day ' || CAST(n % 365 AS VARCHAR) AS modified, 1700000000 + (n % 500) * 3600 AS base,
                     regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '(?s)^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM p),
        k AS (SELECT *, CASE WHEN contains(url, '://') THEN
                 regexp_replace(regexp_replace(lower(regexp_extract(rest, '(?s)^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
                 || regexp_replace(regexp_extract(rest, '(?s)^[^/?]*([^?]*)', 1), '/+$', '')
                 || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END ELSE url END AS canonical
              FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&'),
                        lambda v: v <> '' AND NOT regexp_matches(lower(v), '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q FROM x)),
        rev AS (SELECT n * 8 + 1 AS record_id, canonical, base + 30 * 3600 AS at_second, 'W/' || tag AS etag, modified AS lm, 'cache-control' AS name, 'max-age=3600' AS value, '0' AS cl FROM k
                UNION ALL SELECT n * 8 + 2, canonical, base + 31 * 3600, '"old"', modified, 'date', 'later', NULL FROM k WHERE n % 5 = 0
                UNION ALL SELECT n * 8 + 3, canonical, base - 900 * 3600, tag, NULL, 'date', 'before', NULL FROM k WHERE n % 7 = 0
                UNION ALL SELECT n * 8 + 4, canonical, base + 200 * 3600, NULL, modified, 'expires', 'soon', NULL FROM k WHERE n % 3 = 0
                UNION ALL SELECT n * 8 + 5, canonical, base + 3600, NULL, NULL, 'date', 'bare', NULL FROM k WHERE n % 11 = 0),
        j AS (SELECT r.*, f.record_id AS response_id, f.tag AS ftag, f.lm AS flm, f.html FROM rev r LEFT JOIN LATERAL (
                SELECT n * 8 AS record_id, tag, modified AS lm, html FROM k WHERE k.canonical = r.canonical AND k.base <= r.at_second ORDER BY k.base DESC, n DESC LIMIT 1) f ON true),
        v AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no response' WHEN etag IS NULL AND lm IS NULL THEN 'unvalidated'
                             WHEN CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = ftag ELSE lm = flm END THEN 'resolved' ELSE 'mismatch' END AS verdict FROM j)
        SELECT record_id, canonical, at_second, verdict, response_id,
               array_to_string(list_sort(list_filter(CASE WHEN verdict = 'resolved' THEN
                   ['cache-control: ' || CASE WHEN name = 'cache-control' THEN value ELSE 'max-age=60' END, 'content-length: ' || CAST(length(html) AS VARCHAR),
                    'content-type: text/html', 'etag: ' || coalesce(etag, ftag), 'last-modified: ' || coalesce(lm, flm), CASE WHEN name <> 'cache-control' THEN name || ': ' || value END]
                   ELSE ['content-length: ' || cl, 'etag: ' || etag, 'last-modified: ' || lm, name || ': ' || value] END, lambda h: h IS NOT NULL)), chr(10)) AS headers,
               CASE WHEN verdict = 'resolved' THEN sha256(html) END AS payload_digest, CASE WHEN verdict = 'resolved' THEN length(html) END AS payload_length
        FROM v""",
    "op5_source_mix": r"""
        WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                          md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                     CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS w FROM d GROUP BY source),
        k AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS n FROM s),
        c AS (SELECT *, 1.5 * sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS money,
                     sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM k),
        f AS (SELECT n, money, open FROM c WHERE money * w <= cap * open ORDER BY n LIMIT 1),
        t AS (SELECT c.source, c.source_size, CASE WHEN c.n >= f.n THEN f.money * c.w / f.open ELSE c.cap END AS target FROM c LEFT JOIN f ON true),
        p AS (SELECT d.*, t.source_size, t.target,
                     coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM p)
        SELECT doc_id, size, source_size, target,
               CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)) AS BIGINT) AS taken FROM e""",
    "op6_url_rules": r"""
        WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS h,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        v AS (SELECT row_number() OVER () AS r, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
        s AS (SELECT * FROM (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
              ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'),
              ('net/fr/', 'block', 'net', '/fr/')) AS x(rule, verdict, h, p)),
        b AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
              FROM v JOIN s ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
        SELECT page_id, host, path, b.rule,
               coalesce(b.verdict, CASE WHEN regexp_matches(host || path, '""" + "|".join(r.pattern for r in url_rules.PATTERN_RULES) + r"""')
                                        THEN 'block' ELSE 'allow' END) AS verdict
        FROM v LEFT JOIN b ON v.r = b.r""",
    "op9_quality_cascade": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        p AS (SELECT r, unnest(range(1, len(w) - 1)) AS i,
                     unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS three FROM w WHERE len(w) >= 3),
        g AS (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS c FROM p),
        rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c > 1) GROUP BY r),
        m AS (SELECT w.r, doc_id, t, len(lines) AS n_lines, CAST(len(w) AS BIGINT) AS n_words,
                     CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                     CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                     CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                     CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
                     len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) AS letterless
              FROM w LEFT JOIN rep ON w.r = rep.r),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                     len(regexp_extract_all(t, '(?m)^[\x20\x09]*[-*•◦‣]')) AS n_bullets,
                     len(regexp_extract_all(t, '(?m)(?:\.\.\.|…)[\x20\x09\r]*$')) AS n_open FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
                    OR word_chars < 2 * n_words
                    OR (word_chars > 15 * n_words AND word_chars > 15 * (n_words + len(regexp_extract_all(t, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]'))))
                    OR 2 * len(regexp_extract_all(t, '\p{Lu}')) > len(regexp_extract_all(t, '\p{L}'))
                    OR 5 * letterless > n_words
                    OR (n_bullets >= 3 AND 10 * n_bullets > 9 * n_lines) OR (n_open >= 3 AND 10 * n_open > 3 * n_lines)) AS kept
        FROM b""",
    "op11_conversation_trie": r"""
        WITH tab AS (SELECT list(v ORDER BY n) AS tab FROM (SELECT n, list_reduce(list_concat([CAST(n AS BIGINT)], range(8)),
                            lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(n))),
        o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                     md5(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d
              FROM conversations WHERE conv_id IS NOT NULL),
        h AS (SELECT c, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda a, x: xor(a >> 8, tab[CAST(xor(a & 255, x) AS INT) + 1])), 4294967295) % 9 AS h
              FROM (SELECT DISTINCT c FROM o), tab),
        u AS (SELECT h.c, o.d, o.role, o.text FROM h JOIN o ON o.c = h.c - h.c % 5 AND o.d <= h.h
              UNION ALL SELECT h.c, o.d + 100000000, o.role, o.text FROM h JOIN o ON o.c = h.c AND o.d > h.h),
        t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY d) AS d, octet_length(encode(text)) AS size,
                     string_agg(md5(CAST(octet_length(encode(role)) AS VARCHAR) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS path FROM u
              UNION ALL SELECT c, 0, 0, '' FROM h),
        l AS (SELECT c, max(d) AS last FROM t GROUP BY c),
        n AS (SELECT path, any_value(d) AS depth, min(t.c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                     coalesce(string_agg(CAST(t.c AS VARCHAR), ',' ORDER BY t.c) FILTER (last = d), '') AS ends FROM t JOIN l ON t.c = l.c GROUP BY path),
        k AS (SELECT path, depth, conv_id, n_convs, ends, (n_convs - 1) * size AS saved, left(path, length(path) - 32) AS up,
                     (SELECT count(*) FROM n AS m WHERE m.depth = n.depth + 1 AND starts_with(m.path, n.path)) AS n_children FROM n)
        SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
               CAST(count(*) FILTER (s.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(s.saved) AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
        FROM k JOIN k AS s ON starts_with(s.path, k.path) LEFT JOIN k AS p ON k.depth > 0 AND p.path = k.up
        GROUP BY ALL""",
    "op13_spelling_variants": r"""
        WITH RECURSIVE tab AS (SELECT list(v ORDER BY n) AS tab FROM (SELECT n, list_reduce(list_concat([CAST(n AS BIGINT)], range(8)),
                            lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(n))),
        t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                                          '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
        r AS (SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS x FROM t GROUP BY d, run),
        h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(x) + 1, 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT))),
                                             lambda a, y: xor(a >> 8, tab[CAST(xor(a & 255, y) AS INT) + 1])), 4294967295) AS h FROM r, tab),
        c AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM h),
        v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
        g AS (SELECT word, i, left(word, CAST(i AS INT)) || substring(word, CAST(i AS INT) + 2) AS x FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
        p AS (SELECT a.word AS a, b.word AS b FROM g AS a JOIN g AS b ON a.i = b.i AND a.x = b.x AND a.word <> b.word
              UNION SELECT g.word, v.word FROM g JOIN v ON g.x = v.word
              UNION SELECT v.word, g.word FROM g JOIN v ON g.x = v.word),
        b AS (SELECT p.a, count(*) AS n_near, max(v.n) AS best_n, arg_max(p.b, (v.n, -o)) AS best
              FROM p JOIN (SELECT word, n, row_number() OVER (ORDER BY word) AS o FROM v) AS v ON p.b = v.word GROUP BY p.a),
        w AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
              FROM v LEFT JOIN b ON v.word = b.a),
        f AS (SELECT word, form AS at FROM w WHERE form IS NOT NULL UNION ALL SELECT f.word, w.form FROM f JOIN w ON f.at = w.word WHERE w.form IS NOT NULL),
        z AS (SELECT f.word, f.at AS root FROM f JOIN w ON f.at = w.word WHERE w.form IS NULL)
        SELECT w.word, w.form, coalesce(z.root, w.word) AS root, w.n, CAST(w.n_near AS BIGINT) AS n_near, w.form_n FROM w LEFT JOIN z ON w.word = z.word""",
}
