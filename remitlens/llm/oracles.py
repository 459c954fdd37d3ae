"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from remitlens.llm import automata, manifest, periodic, quality, repeats, urlfilter

WORD = r"[^\x20\x09-\x0D]"

REPEATS = f"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, s, md5(substr(hx, 2 * s + 1, {2 * repeats.LENGTH})) AS k FROM (SELECT doc_id, hx, unnest(range(0, n - {repeats.LENGTH - 1})) AS s FROM t WHERE n >= {repeats.LENGTH})),
hit AS (SELECT doc_id, s FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run
    FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {repeats.LENGTH} THEN 0 ELSE 1 END AS fresh FROM hit)),
runs AS (SELECT doc_id, min(s) AS a, max(s) + {repeats.LENGTH} AS b FROM marked GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
cut AS (SELECT e.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
    FROM edges e JOIN t ON e.doc_id = t.doc_id GROUP BY e.doc_id)
SELECT t.doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN n_removed IS NULL THEN hx ELSE front || substr(hx, 2 * last + 1) END)) AS kept_sha256,
    t.n - coalesce(n_removed, 0) AS n_kept, coalesce(n_removed, 0) > 0 AS changed
FROM t LEFT JOIN cut ON t.doc_id = cut.doc_id
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words FROM documents),
l AS (SELECT doc_id, source, text, words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i FROM d WHERE len(words) >= {quality.WINDOW})),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, CAST(sum(least({quality.WINDOW}, coalesce(step, {quality.WINDOW}))) AS BIGINT) AS n FROM (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i AS step FROM again) GROUP BY doc_id),
each AS (SELECT doc_id, source, text, translate(lower(trim(x)), '0123456789', '0000000000') AS h, len(regexp_extract_all(x, '{WORD}+')) AS w FROM (SELECT doc_id, source, text, unnest(lines) AS x FROM l)),
held AS (SELECT DISTINCT source, text, h, w FROM each),
total AS (SELECT source, text, sum(w) AS total FROM held GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
often AS (SELECT c.source, c.h FROM (SELECT source, h, count(*) AS docs FROM held GROUP BY ALL) c JOIN hosts s ON c.source IS NOT DISTINCT FROM s.source
    WHERE docs > {quality.LINE_DOCS} AND docs > s.n * {quality.LINE_SHARE}),
hit AS (SELECT e.* FROM held e JOIN often o ON e.source IS NOT DISTINCT FROM o.source AND e.h = o.h),
rest AS (SELECT g.source, g.text, 1 - g.w / t.total AS share FROM (SELECT source, text, sum(w) AS w FROM hit GROUP BY ALL) g JOIN total t ON g.source IS NOT DISTINCT FROM t.source AND g.text = t.text),
hot AS (SELECT i.source, i.h FROM hit i JOIN rest r ON i.source IS NOT DISTINCT FROM r.source AND i.text = r.text GROUP BY i.source, i.h HAVING avg(share) >= {quality.KEEP_SHARE}),
gone AS (SELECT e.doc_id, CAST(sum(w) AS BIGINT) AS n FROM each e JOIN hot o ON e.source IS NOT DISTINCT FROM o.source AND e.h = o.h GROUP BY e.doc_id),
base AS (SELECT l.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
    FROM l LEFT JOIN rep ON l.doc_id = rep.doc_id LEFT JOIN gone ON l.doc_id = gone.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND n_words - removed_words >= n_words * {quality.KEEP_SHARE} AS kept, removed_words
FROM (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PCT} * n_words AS base_failed FROM base)
"""

ARCHIVE = """
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(sha1(h), CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""

ORACLES: dict[str, str] = {
    "op2_deep_shallow_repeats": REPEATS,
    "op4_line_frequency": QUALITY,
    "op5_temporal_url_lists": urlfilter.SQL,
    "op10_warc_archive": ARCHIVE,
    "op11_level_manifest": manifest.SQL,
    "op12_pattern_runs": periodic.SQL,
    "op13_shard_automata": automata.SQL,
}
