"""The registered queries in DuckDB SQL."""

from __future__ import annotations

from foliowright.functions import fixed
from foliowright.sources.pages import DERIVED, VARIED

_C = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


#: headings that need no similarity
_EXACT = "'^(?:HOUSE OF LORDS|HOUSE OF COMMONS)'"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{_C}+|{_C}+\z', '', 'g')"


def _lstrip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{_C}+', '')"


def _words(table: str, key: str) -> str:
    return rf"SELECT {key}, unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '[^\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[A-Za-z]+'))) AS word FROM {table}"


PARTS: dict[str, str] = {
    "w": _words("documents", "doc_id"),
    "c": "SELECT word, count(*) AS n FROM w GROUP BY word",
    "hw": r"""SELECT unnest(list_filter(list_transform(flatten(list_transform(
        regexp_split_to_array(coalesce(text, ''), '[^\p{L}\p{N}_''-]+'),
        lambda x: string_split(regexp_replace(x, '[A-Za-z]*[^A-Za-z''-][^''-]*', ' ', 'g'), ' '))), lambda x: trim(x, '''-')), lambda x: x <> '')) AS word FROM documents""",
    "hc": "SELECT word, count(*) AS n FROM hw GROUP BY word",
    "r": "SELECT word, n FROM c WHERE n <= 3 AND length(word) >= 4 AND word <> upper(word)",
    "d": "SELECT DISTINCT lower(word) AS word FROM c WHERE n >= 10",
    "dn": "SELECT d.word AS near, coalesce(c.n, 0) AS n FROM d LEFT JOIN c USING (word)",
    "pairs": "SELECT word, rare_n, near, n, distance FROM (SELECT r.word, r.n AS rare_n, k.near, k.n, levenshtein(lower(r.word), k.near) AS distance FROM r JOIN "
    "(SELECT near, n, ascii(near) + i AS letter, length(near) + j AS size FROM dn, range(-2, 3) t(i), range(-2, 3) u(j)) k ON ascii(lower(r.word)) = letter AND length(r.word) = size) WHERE distance BETWEEN 1 AND 2",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, n DESC, near) AS rank FROM pairs",
    "cand": "SELECT x.word AS rare_word, near AS suggested_correction, rare_n AS rare_count, x.n AS correct_count, distance AS edit_distance FROM ranked x "
    "LEFT JOIN c ON c.word = upper(near[1]) || near[2:] WHERE rank = 1 AND x.n + coalesce(c.n, 0) >= 10 * rare_n",
    "chars": "SELECT lower(rare_word)[i] AS wrong, suggested_correction[i] AS meant FROM (SELECT *, unnest(range(1, length(rare_word) + 1)) AS i FROM cand WHERE length(rare_word) = length(suggested_correction)) WHERE wrong <> meant",
    "grams": "SELECT wrong, meant FROM (SELECT a, b, a[i : i + 1] AS wrong, b[j : j + 1] AS meant FROM (SELECT *, unnest(range(1, length(b))) AS j FROM (SELECT lower(rare_word) AS a, suggested_correction AS b, unnest(range(1, length(rare_word))) AS i FROM cand))) "
    "WHERE wrong <> meant AND (length(a) - length(replace(a, wrong, ''))) / 2 = (length(b) - length(replace(b, meant, ''))) / 2",
    "look": """SELECT rare_word, suggested_correction AS correct_word, confidence FROM (SELECT *,
        (CASE WHEN ratio >= 50 THEN 0.95::DOUBLE WHEN ratio >= 20 THEN 0.90::DOUBLE WHEN ratio >= 10 THEN 0.85::DOUBLE ELSE 0.70::DOUBLE END)
        + (CASE edit_distance WHEN 1 THEN 0.03::DOUBLE WHEN 2 THEN 0.01::DOUBLE ELSE 0::DOUBLE END) - (CASE WHEN correct_count < 30 THEN 0.10::DOUBLE ELSE 0::DOUBLE END) AS confidence
        FROM (SELECT *, correct_count::DOUBLE / rare_count AS ratio FROM cand WHERE correct_count > 0 AND NOT regexp_full_match(rare_word, '[A-Z][a-z]+') AND rare_word <> upper(rare_word))) WHERE confidence >= 0.85::DOUBLE""",
    "flook": "SELECT c.word, CASE WHEN regexp_matches(c.word, '^[A-Z]') THEN upper(correct_word[1]) || lower(correct_word[2:]) ELSE correct_word END AS replacement, confidence, c.n FROM c JOIN look ON lower(c.word) = rare_word "
    "WHERE NOT regexp_full_match(c.word, '[A-Z][a-z]+') AND NOT (length(c.word) > 1 AND c.word = upper(c.word))",
    "pieces": r"SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS p FROM documents)",
    "offs": "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS tok_pos, piece AS word, (upto - length(piece))::BIGINT AS position FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM pieces) WHERE regexp_full_match(piece, '[A-Za-z]+')",
    "conf": "SELECT * FROM (VALUES " + ", ".join(f"({i}, {_q(a)}, {_q(b)})" for i, (a, b) in enumerate(fixed.CONFUSIONS)) + ") t(ord, wrong, fixed)",
    "exact": "SELECT word, n, coalesce(min(fixed) FILTER (word = wrong), arg_min(upper(fixed), ord) FILTER (word = upper(wrong))) AS replacement FROM c JOIN conf ON word = wrong OR word = upper(wrong) GROUP BY word, n",
    "swap": "SELECT * FROM (SELECT word, n, replacement FROM exact UNION ALL SELECT word, min(n) AS n, arg_min(replace(word, wrong, fixed), ord) AS replacement FROM c JOIN conf ON contains(word, wrong) AND length(wrong) >= 3 WHERE word NOT IN (SELECT word FROM exact) GROUP BY word) WHERE word <> replacement",
    # pieces between which no hyphenated word can reach: runs of letters, digits, hyphens, apostrophes; then words, and what lies between, of each
    "hruns": r"SELECT doc_id, unnest(p) AS run, unnest(range(1, len(p) + 1)) AS j FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_''-]+|[^\p{L}\p{N}_''-]+') AS p FROM documents)",
    "hsplit": r"SELECT doc_id, j, unnest(q) AS part, unnest(range(1, len(q) + 1)) AS k FROM (SELECT doc_id, j, regexp_extract_all(run, '[A-Za-z]*[^A-Za-z''-][^''-]*|[A-Za-z''-]+') AS q FROM hruns)",
    "hpieces": r"""SELECT doc_id, unnest(r) AS piece, (j * 1000000 + k) * 10 + unnest(range(1, len(r) + 1)) AS i FROM (
        SELECT doc_id, j, k, CASE WHEN regexp_full_match(part, '[A-Za-z''-]+') THEN list_filter([regexp_extract(part, '^[''-]+'), regexp_extract(part, '^[''-]*([A-Za-z](?:[A-Za-z''-]*[A-Za-z])?)', 1), regexp_extract(part, '[A-Za-z]([''-]+)$', 1)], lambda x: x <> '') ELSE [part] END AS r FROM hsplit)""",
    "hwd": "SELECT doc_id, piece AS word FROM hpieces",
    "bw": _words("benchmark", "item_id"),
    "dict": "SELECT lower(word) AS word FROM bw UNION SELECT word FROM d",
    "vocab": "SELECT v.word, v.n FROM (SELECT lower(word) AS word, count(*) AS n FROM w WHERE doc_id % 3400 % 10 = 0 GROUP BY 1 ORDER BY n DESC, word LIMIT 10000) v WHERE n >= 3 AND " + (
        valid := lambda x: f"(length({x}) < 2 OR lower({x}) IN {_list(fixed.PRESERVED_SPELLINGS)} OR upper({x}) IN {_list(fixed.PARLIAMENTARY_TERMS)} OR regexp_full_match({x}, '[0-9]+|[IVXLCDM]+') OR lower({x}) IN (SELECT word FROM dict))"
    )("v.word"),
    "unknown": "SELECT word, n FROM c WHERE NOT " + valid("c.word"),
    "pair": "SELECT * FROM (VALUES " + ", ".join(f"({i}, {_q(a)}, {_q(b)})" for i, (a, b) in enumerate(fixed.CONFUSION_PAIRS)) + ") t(ord, a, b)",
    "csug": "SELECT word, replace(word, a, b) AS suggestion, CASE WHEN (a = upper(a)) = (b = upper(b)) THEN 0.85::DOUBLE ELSE 0.75::DOUBLE END AS confidence, ord FROM unknown JOIN pair ON contains(word, a) WHERE replace(word, a, b) <> word AND " + valid("replace(word, a, b)"),
    "epairs": "SELECT word, near, n, distance, row_number() OVER (PARTITION BY word ORDER BY distance, n DESC, near) AS rank FROM (SELECT u.word, k.near, k.n, levenshtein(lower(u.word), k.near) AS distance FROM unknown u JOIN "
    "(SELECT word AS near, n, ascii(word) + i AS letter, length(word) + j AS size FROM vocab, range(-2, 3) t(i), range(-2, 3) s(j)) k ON ascii(lower(u.word)) = letter AND length(u.word) = size WHERE length(u.word) BETWEEN 4 AND 12) WHERE distance BETWEEN 1 AND 2",
    "esug": "SELECT word, near AS suggestion, least(0.5::DOUBLE * (1::DOUBLE - distance / 2::DOUBLE) + 0.3::DOUBLE, 1::DOUBLE) AS confidence, (rank + 99)::INT AS ord, rank FROM epairs WHERE rank <= 3",
    "sug": "SELECT word, string_agg(suggestion || ':' || printf('%.2f', confidence), '|' ORDER BY ord) AS suggestions, CASE WHEN min(ord) < 100 THEN 'unknown_word|confusion_pattern' ELSE 'unknown_word' END AS error_types, arg_min(suggestion, ord) AS first_suggestion, arg_min(confidence, ord) AS first_confidence "
    "FROM (SELECT word, suggestion, confidence, ord FROM csug UNION ALL SELECT word, suggestion, confidence, ord FROM esug) GROUP BY word",
    "stems": "SELECT DISTINCT lower(word) AS stem FROM bw WHERE length(word) >= 4",
    "sfxed": "SELECT stem, stem AS word FROM stems UNION ALL "
    "SELECT stem, left(stem, length(stem) - length(strip)) || added FROM stems JOIN (VALUES ('S', 'y', 'ies', '[^aeiou]y'), ('S', '', 's', '[^sxy]'), ('S', '', 'es', '[sx]'), ('D', '', 'd', 'e'), ('D', '', 'ed', '[^ey]')) "
    "t(flag, strip, added, cond) ON (flag = 'S' OR length(stem) % 2 = 0) AND ends_with(stem, strip) AND regexp_matches(stem, cond || '$')",
    "forms": "SELECT DISTINCT word, stem FROM (SELECT word, stem FROM sfxed UNION ALL SELECT 'un' || word, stem FROM sfxed WHERE length(stem) % 3 = 0)",
    "awrong": "SELECT word FROM c WHERE n <= 3 AND regexp_full_match(word, '[a-z]{5,}') AND word NOT IN (SELECT word FROM forms)",
    "apairs": "SELECT w.word, f.word AS near, levenshtein(w.word, f.word) AS distance FROM awrong w JOIN (SELECT word, ascii(word) + i AS letter, length(word) + j AS size "
    "FROM (SELECT DISTINCT word FROM forms), range(-2, 3) t(i), range(-2, 3) s(j)) f ON ascii(w.word) = letter AND length(w.word) = size",
    "agrams": "SELECT word, list_distinct(flatten(list_transform(range(1, 4), lambda n: list_transform(range(1, length(word) - n + 2), lambda i: substring(word, i, n))))) AS g "
    "FROM (SELECT word FROM awrong UNION SELECT word FROM forms)",
    "hopen": "SELECT word, n FROM hc WHERE length(word) > 2 AND NOT (length(word) > 4 AND word = upper(word))",
    "hbad": f"SELECT word, n FROM hopen WHERE lower(word) NOT IN (SELECT word FROM dict) AND word NOT IN {_list(fixed.WHITELIST)}",
    "hpairs": "SELECT word, wn, near, n, distance, row_number() OVER (PARTITION BY word ORDER BY distance, n DESC, near) AS rank FROM (SELECT u.word, u.n AS wn, k.near, k.n, levenshtein(lower(u.word), k.near) AS distance FROM hbad u JOIN "
    "(SELECT near, n, ascii(near) + i AS letter, length(near) + j AS size FROM (SELECT dict.word AS near, coalesce(hc.n, 0) AS n FROM dict LEFT JOIN hc USING (word)), range(-2, 3) t(i), range(-2, 3) s(j)) k ON ascii(lower(u.word)) = letter AND length(u.word) = size) WHERE distance BETWEEN 1 AND 2",
    "hyb": """SELECT word, wn AS n, near AS suggestion, 2 * n AS suggestion_count, distance AS edit_distance, CASE WHEN n = 0 THEN 0::DOUBLE ELSE
        (CASE WHEN 2 * n >= 100 THEN 0.4::DOUBLE WHEN 2 * n >= 10 THEN 0.3::DOUBLE WHEN 2 * n >= 3 THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END)
        + (CASE WHEN wn = 0 THEN 0.3::DOUBLE WHEN wn <= 2 THEN 0.2::DOUBLE WHEN wn <= 5 THEN 0.1::DOUBLE ELSE 0::DOUBLE END)
        + (CASE distance WHEN 1 THEN 0.3::DOUBLE WHEN 2 THEN 0.2::DOUBLE ELSE 0::DOUBLE END) END AS confidence FROM hpairs WHERE rank = 1""",
    "dv": f"SELECT doc_id, (doc_id - doc_id % 3400) // 3400 AS volume, {DERIVED} AS md FROM documents",
    "head": rf"SELECT *, {_strip('regexp_extract(md, ' + _q('(?s)' + fixed.HEADER_AND_REST) + ', 1)')} AS line, regexp_extract(md, {_q('(?s)' + fixed.HEADER_AND_REST)}, 2) AS rest FROM dv",
    "headed": "SELECT *, line <> '' AND (" + (house := lambda x: f"regexp_matches({_strip('upper(' + x + ')')}, {_EXACT})")("line") + f" OR regexp_matches({_strip('line')}, {_q(fixed.DATE_HEADER)})) AS is_header FROM head",
    "foot": rf"SELECT doc_id, volume, CASE WHEN is_header THEN line END AS header, regexp_replace(regexp_replace(CASE WHEN is_header THEN rest ELSE md END, {_q('(?i)' + fixed.FOOTER)}, ''), '{_C}+\z', '') AS md FROM headed",
    "h1": rf"SELECT *, {_lstrip('md')} AS bare, regexp_extract(regexp_extract({_lstrip('md')}, '^[a-z]+'), '^[a-z]{{1,15}}$') AS frag FROM foot",
    "h2": rf"SELECT *, frag <> '' AND NOT ({house('string_split(bare, chr(10))[1]')} OR regexp_matches({_strip('string_split(bare, chr(10))[1]')}, {_q(fixed.DATE_HEADER)})) AS ok, bare[length(frag) + 1 :] AS rest FROM h1",
    "h3": rf"SELECT *, CASE WHEN NOT ok THEN md WHEN rest <> '' AND NOT regexp_matches(rest, '^{_C}') THEN md[1 : length(md) - length(bare)] || rest ELSE {_lstrip('rest')} END AS without, regexp_matches(md, '\S-\s*\z') AS raw FROM h2",
    "h4": r"SELECT *, regexp_matches(without, '\S-\s*\z') AS still FROM h3",
    "h5": "SELECT *, ok AND lag(raw, 1, false) OVER o AS if_not, ok AND lag(still, 1, false) OVER o AS if_so, row_number() OVER o = 1 AS top FROM h4 WINDOW o AS (PARTITION BY volume ORDER BY doc_id)",
    "h6": "SELECT *, if_not = if_so OR top AS fixed, sum((if_not = if_so OR top)::INT) OVER (PARTITION BY volume ORDER BY doc_id) AS run FROM h5",
    "h7": "SELECT *, coalesce(max(CASE WHEN fixed THEN if_not END) OVER (PARTITION BY volume, run), false) <> (sum((NOT fixed)::INT) OVER (PARTITION BY volume, run ORDER BY doc_id) % 2 = 1) AS gives FROM h6",
    "h8": "SELECT *, lead(gives, 1, false) OVER o AS gets, lead(frag) OVER o AS nxt, CASE WHEN gives THEN without ELSE md END AS own FROM h7 WINDOW o AS (PARTITION BY volume ORDER BY doc_id)",
    "paras": rf"SELECT volume, doc_id AS page, unnest(ps) AS p, unnest(range(0, len(ps))) AS para FROM (SELECT volume, doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(md, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g'), '\n(?:[^\S\n]*\n)+'), lambda x: {_strip('x')}), lambda x: x <> '') AS ps FROM dv)",
    "k1": rf"SELECT *, CASE WHEN regexp_matches(p, {_q(fixed.BARE_HOUSE)}) THEN 'HOUSE OF ' || upper(regexp_extract(p, {_q(fixed.BARE_HOUSE)}, 1)) END AS house, regexp_extract(p, '(?i)^(HOUSE OF (?:LORDS|COMMONS)), [A-Z]+, (\d+)° DIE ([A-Z]+), (\d+)\.$', ['house', 'day', 'month', 'year']) AS g FROM paras",
    "k2": f"SELECT *, CASE WHEN g.house <> '' THEN upper(g.house) END AS dated_house, CASE WHEN g.house <> '' THEN printf('%04d-%02d-%02d', TRY_CAST(g.year AS BIGINT), list_position([{_list(fixed.LATIN_MONTHS)[1:-1]}], upper(g.month))::BIGINT, TRY_CAST(g.day AS BIGINT)) END AS date_iso, regexp_replace(p, '[^A-Za-z]+', '', 'g') AS letters FROM k1",
    "k3": "SELECT *, CASE WHEN dated_house IS NOT NULL THEN 'dated' WHEN house IS NOT NULL THEN 'house' WHEN letters <> '' AND letters = upper(letters) AND NOT contains(p, chr(10)) AND NOT starts_with(upper(p), 'HOUSE OF ') THEN 'title' END AS kind FROM k2",
    "k4": rf"SELECT *, list_filter(list_transform(string_split(regexp_replace(p, {_q('(?m)^(' + fixed.SPEAKER_START + r')\s*—')}, chr(1) || '\1' || chr(2), 'g'), chr(1))[2:], lambda x: {{'label': {_strip(chr(39).join(['regexp_replace(' + _strip('split_part(x, chr(2), 1)') + ', ', r'[,.;:]+\z', ', ', '', ')']))}, 'text': {_strip('split_part(x, chr(2), 2)')}}}), lambda x: x.text <> '') AS cs FROM k3",
    "k5": rf"SELECT *, {_strip('string_split(p, chr(10))[1]')} AS line FROM k4",
}


def _label(pattern: str) -> str:
    found = f"rtrim({_strip(f'regexp_extract(line, {_q(pattern)}, 1)')}, '.,;:—-')"
    return f"CASE WHEN regexp_matches(line, {_q(pattern)}) AND NOT regexp_matches(rtrim({_strip(f'upper({found})')}, '.:;—-'), '^(?:{'|'.join(fixed.NON_SPEAKERS)})') THEN {found} END"


PARTS |= {
    "k6": f"SELECT *, nullif(coalesce({_label(fixed.DASH_LABEL)}, {_label(fixed.VERB_LABEL)}, {_label(fixed.NAME_LABEL)}), '') AS spk FROM k5",
    "k7": "SELECT *, CASE WHEN kind IS NULL AND len(cs) = 0 AND length(spk) <= 80 THEN spk END AS own FROM k6",
    "ev": rf"""SELECT volume, page, para, chunk, kind, coalesce(dated_house, house) AS house, date_iso, CASE WHEN kind = 'title' THEN p END AS title,
        CASE WHEN said.label IS NULL THEN NULL WHEN chunky AND NOT suffix(said.label, '.') THEN said.label || '.' ELSE said.label END AS speaker, said.text AS text FROM (
        SELECT *, unnest(list) AS said, unnest(range(0, len(list))) AS chunk FROM (
        SELECT *, kind IS NULL AND len(cs) > 0 AS chunky, CASE WHEN kind IS NULL AND len(cs) > 0 THEN cs ELSE [{{'label': own, 'text': CASE WHEN own IS NOT NULL THEN {_strip(f"regexp_replace(p, {_q(fixed.HEADING_OF_BODY)}, '')")} WHEN kind IS NULL THEN p ELSE '' END}}] END AS list FROM k7))""",
    "ctx": """SELECT *, last_value(house IGNORE NULLS) OVER o AS cur_house, last_value(date_iso IGNORE NULLS) OVER o AS cur_date, last_value(title IGNORE NULLS) OVER o AS cur_title,
        sum((speaker IS NOT NULL OR coalesce(kind IN ('dated', 'house'), false))::INT) OVER o AS segment FROM ev WINDOW o AS (PARTITION BY volume ORDER BY page, para, chunk ROWS UNBOUNDED PRECEDING)""",
    "sp": """SELECT volume, segment, arg_min(coalesce(cur_house, ''), (page, para, chunk)) AS house, arg_min(coalesce(cur_date, ''), (page, para, chunk)) AS date_iso, arg_min(coalesce(cur_title, ''), (page, para, chunk)) AS debate_title,
        arg_min(coalesce(speaker, ''), (page, para, chunk)) AS speaker, list_sort(list(DISTINCT page) FILTER (text <> '' OR speaker IS NOT NULL)) AS pages,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY page, para, chunk) FILTER (text <> ''), '') AS text FROM ctx GROUP BY volume, segment""",
    "speech": "SELECT *, volume || '_speech_' || printf('%06d', row_number() OVER (PARTITION BY volume ORDER BY segment)) AS id FROM sp WHERE speaker <> '' AND text <> ''",
}


def _uses(sql: str, upto: list[str]) -> set[str]:
    import re

    out, todo = set(), [sql]
    while todo:
        for name in re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", todo.pop()):
            if name in upto and name not in out:
                out.add(name)
                todo.append(PARTS[name])
    return out


def query(sql: str) -> str:
    """The query behind the parts it uses, in order."""
    names = list(PARTS)
    used = _uses(sql, names)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in names if n in used) + "\n" + sql if used else sql


_REWRITTEN = "SELECT d.doc_id AS index, coalesce(m, '') AS markdown, coalesce(k, 0) AS n_corrections FROM documents d LEFT JOIN (SELECT doc_id, string_agg(coalesce(replacement, piece), '' ORDER BY i) AS m, count(replacement) AS k FROM pieces LEFT JOIN ({}) l ON piece = l.word GROUP BY doc_id) USING (doc_id)"

ORACLE = {name: query(sql) for name, sql in {
    "word_frequency": "SELECT word, n FROM c",
    "word_frequency_topk": "SELECT word, n FROM c ORDER BY n DESC, word LIMIT 100",
    "hyphen_word_frequency": "SELECT word, n FROM hc",
    "corpus_totals": "SELECT coalesce(sum(n), 0)::BIGINT AS total_words, count(*) AS unique_words FROM c",
    "high_frequency_dictionary": "SELECT word FROM d",
    "rare_words": "SELECT word, n FROM c WHERE n <= 3",
    "rare_word_gates": "SELECT word, n FROM r",
    "token_offsets": "SELECT doc_id AS index, tok_pos, word, position FROM offs",
    "token_context": "SELECT o.doc_id AS index, position, word, substring(text, greatest(position - 50, 0) + 1, position + 50 - greatest(position - 50, 0)) AS context FROM offs o JOIN documents d ON o.doc_id = d.doc_id",
    "similar_words_top5": "SELECT word, near, distance, n, rank FROM ranked WHERE rank <= 5",
    "error_candidates": "SELECT * FROM cand",
    "error_candidates_top50": "SELECT * FROM cand ORDER BY rare_count DESC, rare_word LIMIT 50",
    "report_gates": "SELECT count(*) FILTER (regexp_full_match(rare_word, '[A-Z][a-z]+')) AS skipped_proper_nouns, count(*) FILTER (length(rare_word) > 1 AND rare_word = upper(rare_word)) AS skipped_all_caps FROM cand",
    "discovery_report": "SELECT (SELECT coalesce(sum(n), 0) FROM c)::BIGINT AS total_words, (SELECT count(*) FROM c) AS unique_words, (SELECT count(DISTINCT CASE WHEN n >= 10 THEN lower(word) END) FROM c) AS high_frequency_words, (SELECT count(*) FILTER (n <= 3) FROM c) AS rare_words, "
    "(SELECT count(*) FROM cand) AS candidates, (SELECT rare_word FROM cand ORDER BY rare_count DESC, rare_word LIMIT 1) AS first_candidate, (SELECT max(k) FROM (SELECT count(*) AS k FROM (SELECT * FROM chars UNION ALL SELECT * FROM grams) GROUP BY wrong, meant)) AS commonest_pattern",
    "frequency_run_report": "SELECT (SELECT count(*) FROM documents) AS total_pages_processed, (SELECT coalesce(sum(n), 0) FROM flook WHERE word <> replacement)::BIGINT AS total_corrections, (SELECT count(*) FROM flook WHERE word <> replacement) AS unique_error_types, 0.85::DOUBLE AS confidence_threshold, (SELECT count(*) FROM look) AS available_corrections",
    "confusion_run_report": "SELECT (SELECT count(*) FROM documents) AS total_pages_processed, (SELECT coalesce(sum(n), 0) FROM swap)::BIGINT AS total_corrections, (SELECT count(*) FROM swap) AS unique_error_types, "
    "(SELECT word FROM swap ORDER BY n DESC, word LIMIT 1) AS first_original, (SELECT replacement FROM swap ORDER BY n DESC, word LIMIT 1) AS first_corrected",
    "error_statistics": "SELECT coalesce(sum(n), 0)::BIGINT AS total_errors_found, sum(n)::BIGINT AS unknown_words, least(count(*), 50)::BIGINT AS top_errors FROM sug JOIN c USING (word)",
    "hybrid_page_corrections": "SELECT doc_id AS index, word AS original, suggestion AS correction, round(confidence, 2) AS confidence, count(*) AS count FROM hwd JOIN hyb USING (word) WHERE confidence >= 0.7::DOUBLE AND word <> suggestion GROUP BY ALL",
    "hybrid_corrected_pages": r"""SELECT d.doc_id AS index, coalesce(m, '') AS markdown, coalesce(k, 0) AS n_corrections FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(coalesce(suggestion, piece), '' ORDER BY i) AS m, count(suggestion) AS k FROM hpieces LEFT JOIN (SELECT word, suggestion FROM hyb WHERE confidence >= 0.7::DOUBLE AND word <> suggestion) l ON piece = l.word GROUP BY doc_id) USING (doc_id)""",
    "substitution_char_patterns": "SELECT wrong, meant, count(*) AS count FROM chars GROUP BY ALL",
    "substitution_bigram_patterns": "SELECT wrong, meant, count(*) AS count FROM grams GROUP BY ALL",
    "substitution_top100": "SELECT wrong, meant, count(*) AS count FROM (SELECT * FROM chars UNION ALL SELECT * FROM grams) GROUP BY ALL ORDER BY count DESC, wrong, meant LIMIT 100",
    "discovery_summary": "SELECT coalesce(sum(n), 0)::BIGINT AS total_words, count(*) AS unique_words, count(DISTINCT CASE WHEN n >= 10 THEN lower(word) END) AS high_frequency_words, count(*) FILTER (n <= 3) AS rare_words FROM c",
    "frequency_lookup": "SELECT rare_word, correct_word, round(confidence, 2) AS confidence FROM look",
    "frequency_lookup_top20": "SELECT rare_word, correct_word, round(confidence, 2) AS confidence FROM look ORDER BY round(confidence, 2) DESC, rare_word LIMIT 20",
    "frequency_corrected_pages": _REWRITTEN.format("SELECT word, replacement FROM flook WHERE word <> replacement"),
    "frequency_report": "SELECT word AS original, replacement AS corrected, n AS count, round(confidence, 2) AS confidence FROM flook WHERE word <> replacement",
    "confusion_exact_corrected_pages": _REWRITTEN.format("SELECT word, replacement FROM exact WHERE word <> replacement"),
    "confusion_substring_candidates": "SELECT word, arg_min(replace(word, wrong, fixed), ord) AS corrected, 0.85::DOUBLE AS confidence FROM c JOIN conf ON contains(word, wrong) AND length(wrong) >= 3 WHERE word NOT IN (SELECT word FROM exact) GROUP BY word",
    "confusion_report": "SELECT word AS original, replacement AS corrected, n AS count FROM exact WHERE word <> replacement",
    "vocabulary_sampled": "SELECT word, n FROM vocab",
    "unknown_words_anti_join": "SELECT word, n FROM unknown",
    "edit_distance_suggestions_top3": "SELECT word, suggestion, round(confidence, 2) AS confidence, rank FROM esug",
    "error_candidate_records": "SELECT doc_id AS page_index, position, offs.word AS original_word, error_types, suggestions FROM offs JOIN sug ON offs.word = sug.word",
    "error_records": "SELECT doc_id AS page_index, offs.word AS original_word, position, error_types, suggestions, "
    "substring(text, greatest(position - 50, 0) + 1, position + 50 - greatest(position - 50, 0)) AS context "
    "FROM offs JOIN sug ON offs.word = sug.word JOIN documents USING (doc_id)",
    "position_edited_pages": "SELECT d.doc_id AS index, coalesce(m, '') AS markdown, coalesce(k, 0) AS n_corrections FROM documents d LEFT JOIN ("
    "SELECT doc_id, string_agg(CASE WHEN replacement IS NULL THEN piece WHEN nth = 1 THEN replacement ELSE upper(replacement) END, '' ORDER BY i) AS m, count(replacement) AS k "
    "FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, piece ORDER BY i) AS nth FROM pieces) p LEFT JOIN swap ON piece = word GROUP BY doc_id) USING (doc_id)",
    "pattern_contained_words": "SELECT word, min(pattern) AS pattern, replace(word, min(pattern), upper(min(pattern))) AS corrected FROM c "
    "JOIN (SELECT DISTINCT lower(word) AS pattern FROM bw WHERE length(word) >= 4) ON contains(word, pattern) GROUP BY word",
    "affix_forms": "SELECT word, stem FROM forms",
    "affix_suggestions_top3": "SELECT word, near AS suggestion, rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, score DESC, near) AS rank FROM ("
    "SELECT p.word, near, distance, len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS score "
    "FROM apairs p JOIN agrams a ON a.word = p.word JOIN agrams b ON b.word = near WHERE distance BETWEEN 1 AND 2)) WHERE rank <= 3",
    "auto_applied_pages": _REWRITTEN.format("SELECT word, CASE WHEN word = upper(word) THEN upper(first_suggestion) WHEN regexp_matches(word, '^[A-Z]') THEN upper(first_suggestion[1]) || lower(first_suggestion[2:]) ELSE first_suggestion END AS replacement FROM sug WHERE first_confidence >= 0.5::DOUBLE"),
    "errors_by_type": "SELECT error_type, sum(n)::BIGINT AS n FROM (SELECT unnest(string_split(error_types, '|')) AS error_type, n FROM sug JOIN c USING (word)) GROUP BY error_type",
    "top_errors": "SELECT word AS original, first_suggestion AS suggested, n AS count FROM sug JOIN c USING (word) ORDER BY n DESC, word LIMIT 50",
    "hybrid_confidence": "SELECT word, n, suggestion, suggestion_count, edit_distance, round(confidence, 2) AS confidence FROM hyb",
    "hybrid_summary": "SELECT (SELECT sum(n) FROM hopen)::BIGINT AS words_checked, (SELECT sum(n) FROM hbad)::BIGINT AS words_invalid, coalesce(sum(n), 0)::BIGINT AS total_corrections, count(*) AS unique_correction_types FROM hyb WHERE confidence >= 0.7::DOUBLE AND word <> suggestion",
    "hybrid_top_corrections": "SELECT word || ' → ' || suggestion AS correction, n AS count FROM hyb WHERE confidence >= 0.7::DOUBLE AND word <> suggestion ORDER BY n DESC, correction LIMIT 50",
    "entity_counts": f"SELECT rtrim(s, '.—') AS speaker, count(*) AS n FROM (SELECT regexp_extract(md, {_q(fixed.ENTITY)}) AS s FROM dv WHERE doc_id % 3400 < 500) WHERE s <> '' GROUP BY 1 HAVING count(*) >= 5",
    "date_header_flag": f"SELECT doc_id AS index, regexp_matches({_strip('string_split(md, chr(10))[1]')}, {_q(fixed.DATE_HEADER)}) AS is_date FROM dv",
    "house_header_fuzzy": f"SELECT doc_id AS index, {house('string_split(md, chr(10))[1]')} AS is_house FROM dv",
    "header_extracted_pages": "SELECT doc_id AS index, CASE WHEN is_header THEN line END AS header, CASE WHEN is_header THEN rest ELSE md END AS markdown FROM headed",
    "header_count": "SELECT count(*) AS pages, count(*) FILTER (is_header) AS headers FROM headed",
    "footer_removed_pages": rf"SELECT doc_id AS index, regexp_replace(regexp_replace(md, {_q('(?i)' + fixed.FOOTER)}, ''), '{_C}+\z', '') AS markdown FROM dv",
    "hyphen_joined_pages": r"SELECT doc_id AS index, header, CASE WHEN gets THEN regexp_replace(own, '-\s*\z', '') || nxt ELSE own END AS markdown FROM h8",
    "paragraphs": "SELECT page, para, p FROM paras",
    "house_headings": "SELECT page, para, house FROM k1 WHERE house IS NOT NULL",
    "latin_dates": "SELECT page, para, dated_house AS house, date_iso FROM k2 WHERE dated_house IS NOT NULL",
    "debate_titles": "SELECT page, para, p AS title FROM k3 WHERE kind = 'title'",
    "multi_speaker_chunks": "SELECT page, para, chunk, speaker, text FROM ev JOIN (SELECT page, para FROM k7 WHERE kind IS NULL AND len(cs) > 0) USING (page, para)",
    "detected_speakers": "SELECT page, para, spk AS speaker FROM k6 WHERE spk IS NOT NULL",
    "running_context": "SELECT page, para, chunk, cur_house AS house, cur_date AS date_iso, cur_title AS debate_title FROM ctx",
    "speeches": "SELECT id, nullif(house, '') AS house, nullif(date_iso, '') AS date_iso, nullif(debate_title, '') AS debate_title, speaker, array_to_string(pages, '|') AS pages, text FROM speech",
    "speech_pages": "SELECT id, unnest(pages) AS page FROM speech",
    "page_sample_first_n": "SELECT doc_id AS index, length(text) AS chars FROM documents WHERE doc_id % 3400 < 100",
    "page_sample_every_10th": "SELECT doc_id AS index, length(text) AS chars FROM documents WHERE doc_id % 3400 % 10 = 0",
}.items()}

# Misspelled headings and months of the varied pages, and what the similarity ratio makes of them; SQL has no such ratio.
_ALIKE = "'^(?:HOUSE OF LORDS|HOUSE OF COMMONS|HOUSE OF LOEDS|HOUSE OF C0MMONS|HOUSE OF CORRECTION)'"
_MONTHS = "CASE upper(g.month) WHEN 'JUII' THEN 'JUNII' WHEN 'MAIL' THEN 'MAII' ELSE upper(g.month) END)::BIGINT"

ORACLE |= {
    f"varied_{name}": ORACLE[name].replace(DERIVED, VARIED).replace(_EXACT, _ALIKE).replace("upper(g.month))::BIGINT", _MONTHS)
    for name in ("entity_counts", "house_header_fuzzy", "header_extracted_pages", "latin_dates", "detected_speakers", "multi_speaker_chunks", "running_context", "speeches")
}
