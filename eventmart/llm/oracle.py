"""The queries that SQL can express, as SQL for DuckDB."""

from __future__ import annotations

_WORDS = r"""
regexp_extract_all(
    translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
"""

_DECONTAMINATION = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format(text='text')}, []) AS w FROM documents
), items AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item, coalesce({_WORDS.format(text='text')}, []) AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item, w[i:i + 12] AS ww FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT len(ww) AS n FROM item_windows
), doc_windows AS (
    SELECT r, i, n, w[i:i + n - 1] AS ww FROM docs, sizes, unnest(range(1, len(w) - n + 2)) t(i)
), found AS (
    SELECT r, i, n, item FROM doc_windows JOIN item_windows USING (ww)
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r
), which AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN which USING (r)
"""

_LINE_DEDUP_OF = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, text, coalesce('=' || source, 'null') AS site,
           string_split(text, chr(10)) AS lines FROM documents
), pages AS (
    SELECT site, {pages} AS pages FROM docs GROUP BY site
), counted AS (
    SELECT site, line, {pages} AS n FROM (SELECT site, text, unnest(list_distinct(lines)) AS line FROM docs)
    WHERE trim(line, ' ') <> '' GROUP BY ALL
), bad AS (
    SELECT site, list(line) AS bad FROM counted JOIN pages USING (site)
    WHERE n >= 3 AND n > 0.05::DOUBLE * pages GROUP BY site
), cleaned AS (
    SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
    FROM docs LEFT JOIN bad USING (site)
)
SELECT doc_id, array_to_string(kept, chr(10)) AS text, coalesce(len(lines), 0)::BIGINT AS n_lines,
       (coalesce(len(lines), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped
FROM cleaned
"""

_LINE_DEDUP = _LINE_DEDUP_OF.format(pages="count(*)")
_LINE_DEDUP_TEXTS = _LINE_DEDUP_OF.format(pages="count(DISTINCT coalesce('=' || text, 'null'))")


_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
), escaped AS (
    SELECT *, regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'),
                             '\[(\\*/?(INST|ROLE)\])', '[\\\1', 'g') AS safe_text,
              regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'),
                             '\[(\\*/?(INST|ROLE)\])', '[\\\1', 'g') AS safe_role
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(safe_text) + CASE role WHEN 'user' THEN length('<s>[INST]  [/INST]') WHEN 'assistant' THEN length('  </s>')
           ELSE length('<s>[ROLE]  [/ROLE]  </s>') + length(safe_role) END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# DuckDB has no crc32: its table from the polynomial, then byte by byte.
_SPELLING = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) ORDER BY n)
        AS crc FROM range(256) t(n)
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, 'null') AS id, translate(run, {_A_TO_Z}) AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_transform(range(1, len(hex(id || ':' || run)) // 2 + 1),
                       lambda i: ('0x' || substr(hex(id || ':' || run), 2 * i - 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295)) AS h
    FROM runs, crc_table
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) t(i)
), near AS (
    SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT less.word, words.word FROM less JOIN words ON words.word = rest
    UNION SELECT words.word, less.word FROM less JOIN words ON words.word = rest
), best AS (
    SELECT near.word, count(*) AS n_near, max(o.n) AS best_n, first(near.other ORDER BY o.n DESC, near.other) AS best
    FROM near JOIN words o ON o.word = near.other GROUP BY near.word
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN best_n >= 5 * words.n THEN best END AS form, CASE WHEN best_n >= 5 * words.n THEN best_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), followed AS (
    SELECT word, word AS reached, 0 AS steps FROM formed
    UNION ALL SELECT followed.word, form, steps + 1 FROM followed JOIN formed ON formed.word = reached WHERE form IS NOT NULL
)
SELECT formed.word, form, arg_max(reached, steps) AS root, any_value(n) AS n, any_value(n_near)::BIGINT AS n_near,
       any_value(form_n)::BIGINT AS form_n
FROM formed JOIN followed ON followed.word = formed.word GROUP BY formed.word, form
"""


def _url_levels(order: int) -> str:
    """Shares of all n-grams of the wanted windows, level by level from the shortest."""
    parts = []
    for size in range(1, order + 2):
        shorter = "1.0::DOUBLE / (SELECT count(*) + 1 FROM grams WHERE length(gram) = 1)"
        joined = f"LEFT JOIN level{size - 1} s ON s.gram = substr(w.gram, 2)" if size > 1 else ""
        shares = ", ".join(
            f"""CASE WHEN coalesce(c.{k}_n, 0) = 0 THEN {f's.{k}' if joined else shorter}
                ELSE (coalesce(g.{k}, 0) + c.{k}_kinds * {f's.{k}' if joined else shorter}) / (c.{k}_n + c.{k}_kinds) END AS {k}"""
            for k in ("accepted", "rejected")
        )
        parts.append(f"""level{size} AS (
    SELECT w.gram, {shares} FROM (SELECT DISTINCT right(win, {size}) AS gram FROM wanted) w
    LEFT JOIN grams g ON g.gram = w.gram LEFT JOIN contexts c ON c.context = left(w.gram, {size - 1}) {joined}
)""")
    return ",\n".join(parts)


_URLS = rf"""
WITH split AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), {_A_TO_Z}) AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM split
), addresses AS (
    SELECT DISTINCT host, path, rule, host || path AS text, rule IN ('com/', 'www.example.com/en/') AS accepted,
           substr(md5(host || path), 1, 1) < '4' AS held_out FROM ruled
), windows AS (
    SELECT host, path, accepted, held_out,
           unnest(list_transform(range(1, length(text) + 2), lambda i: substr(repeat(chr(2), 4) || text || chr(3), i, 5))) AS win
    FROM addresses
), grams AS (
    SELECT right(win, k) AS gram, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected
    FROM windows, range(1, 6) t(k) WHERE accepted IS NOT NULL AND NOT held_out GROUP BY ALL
), contexts AS (
    SELECT left(gram, length(gram) - 1) AS context, sum(accepted) AS accepted_n, count(*) FILTER (accepted > 0) AS accepted_kinds,
           sum(rejected) AS rejected_n, count(*) FILTER (rejected > 0) AS rejected_kinds FROM grams GROUP BY ALL
), wanted AS (
    SELECT DISTINCT win FROM windows WHERE accepted IS NULL OR held_out
), {_url_levels(4)}, scored AS (
    SELECT host, path, accepted, sum(round((ln(share_a) - ln(share_r)) * 1000000)::BIGINT)::DOUBLE / count(*) AS score
    FROM windows JOIN (SELECT gram, accepted AS share_a, rejected AS share_r FROM level5) ON gram = win
    WHERE accepted IS NULL OR held_out GROUP BY ALL
), bins AS (
    SELECT floor(score / 1000) AS bin, count(*) FILTER (accepted) AS a, count(*) FILTER (NOT accepted) AS b
    FROM scored WHERE accepted IS NOT NULL GROUP BY ALL
), errors AS (
    SELECT bin, coalesce((lag(bin) OVER w + bin + 1) / 2, bin) AS least,
           (sum(a) OVER w - a) / nullif(sum(a) OVER (), 0)::DOUBLE
           + (sum(b) OVER () - sum(b) OVER w + b) / nullif(sum(b) OVER (), 0)::DOUBLE AS error
    FROM bins WINDOW w AS (ORDER BY bin)
), chosen AS (
    SELECT coalesce((SELECT least * 1000 FROM errors WHERE error IS NOT NULL ORDER BY error, bin LIMIT 1), 0) AS least
)
SELECT page_id, ruled.host, ruled.path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN score >= (SELECT least FROM chosen) THEN 'allow' ELSE 'block' END AS verdict
FROM ruled LEFT JOIN scored ON scored.host = ruled.host AND scored.path = ruled.path AND scored.accepted IS NULL
"""

_COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, list_filter(string_split(translate(p, chr(9), ' '), ' '), lambda w: w <> '') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), {_A_TO_Z}), '[.,;:!?
-
]')) AS p FROM documents)
), phrases AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*)::HUGEINT AS n
    FROM pieces, range(1, 4) t(k), unnest(range(1, len(w) - k + 2)) u(i) GROUP BY ALL
), totals AS (
    SELECT lang, sum(n)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND n >= 10
), cuts AS (
    SELECT c.lang, c.phrase, c.k, a, f.n AS l, g.n AS r, (1000000 * a * a) // (f.n * g.n) AS score, cut
    FROM candidates c, range(1, 3) t(cut)
    JOIN phrases f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN phrases g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[cut + 1:], ' ')
    WHERE cut < c.k
), low AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), held AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM candidates, range(1, 3) t(i)
    WHERE k = 3 GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
       r::BIGINT AS r, totals.n AS n, score::BIGINT AS score
FROM low LEFT JOIN held USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "op11_spelling_variants": _SPELLING,
        "op12_url_filter": _URLS,
        "op13_collocations": _COLLOCATIONS,
        "op1_decontamination": _DECONTAMINATION,
        "op3_chat": _CHAT,
        "op5_line_dedup": _LINE_DEDUP,
        "op5_line_dedup_texts": _LINE_DEDUP_TEXTS,
    }
