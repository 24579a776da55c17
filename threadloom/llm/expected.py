"""SQL that states the rows of those queries that SQL can express, over the base tables."""

from __future__ import annotations

from threadloom.llm import decontaminate, repetition

WORDS = r"'[^\x20\x09-\x0D]+'"


def _coverage(n: int) -> str:
    """Words inside windows of n words that occur twice or more in the text, per document."""
    return f"""g{n} AS (
        SELECT d, sum(w) AS chars, count(*) AS words FROM (
            SELECT d, w, max(again) OVER (PARTITION BY d ORDER BY i
                ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
            FROM (SELECT d, i, w, CASE WHEN gram IS NOT NULL
                    AND count(*) OVER (PARTITION BY d, gram) > 1 THEN 1 ELSE 0 END AS again
                FROM (SELECT d, i, length(ws[i]) AS w, CASE WHEN i + {n - 1} <= len(ws)
                    THEN array_to_string(ws[i:i + {n - 1}], ' ') END AS gram FROM places)))
        WHERE inside = 1 GROUP BY d)"""


def repetition_sql() -> str:
    lengths = [3, *repetition.COVERAGE]
    share = {n: f"coalesce(g{n}.chars, 0) / greatest(word_chars, 1)" for n in repetition.COVERAGE}
    shares = ", ".join(f"CAST({s} AS DOUBLE) AS dup_{n}_share" for n, s in share.items())
    judged = " AND ".join(f"dup_{n}_share <= CAST({most} AS DOUBLE)"
                          for n, most in repetition.COVERAGE.items())
    joins = " ".join(f"LEFT JOIN g{n} USING (d)" for n in lengths)
    failed = f"(n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM documents),
    places AS (SELECT d, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs),
    {", ".join(_coverage(n) for n in lengths)},
    lines AS (
        SELECT d, count(*) AS n, sum(chars) AS chars FROM (
            SELECT d, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars,
                   row_number() OVER (PARTITION BY d, line ORDER BY place) AS nth
            FROM (SELECT d, unnest(string_split(text, chr(10))) AS line,
                         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs))
        WHERE nth > 1 AND chars > 0 GROUP BY d),
    sizes AS (
        SELECT d, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum([length(w) for w in ws]), 0) AS BIGINT)
               AS word_chars,
               CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols FROM docs),
    measured AS (
        SELECT doc_id, n_words, word_chars, n_symbols,
               CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(g3.words, 0) AS BIGINT) AS n_repeat_words,
               CAST(coalesce(lines.chars, 0) / greatest(word_chars, 1) AS DOUBLE)
               AS dup_line_share, {shares}
        FROM sizes LEFT JOIN lines USING (d) {joins})
    SELECT *, {failed} AS base_failed, NOT {failed}
        AND dup_line_share <= CAST({repetition.LINE_COVERAGE} AS DOUBLE) AND {judged} AS kept
    FROM measured"""


def _seeds(source: str, key: str, at: str, masks: list[tuple[int, str, str]]) -> str:
    """Seeds as texts: number of the mask and the words that it selects."""
    return " UNION ALL ".join(
        f"""SELECT {key}, ws, {at}, concat_ws(' ', '{number}', {", ".join(
            f"ws[{at} + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")}) AS seed
            FROM {source} WHERE {at} + {len(mask)} <= len(ws) AND {condition}"""
        for number, mask, condition in masks)


def decontamination_sql() -> str:
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    long = f"len(ws) >= {decontaminate.LONG}"
    short = f"len(ws) BETWEEN {decontaminate.SHORTEST} AND {decontaminate.LONG - 1}"
    of_items = [(n, m, long if n < len(decontaminate.MASKS) else short)
                for n, m in decontaminate.NUMBERED]
    of_docs = [(n, m, "TRUE") for n, m in decontaminate.NUMBERED]
    near = decontaminate.LONGEST_MASK + 2 * decontaminate.AROUND
    return f"""
    WITH items AS (SELECT item_id, ws, unnest(range(0, len(ws))) AS q
                   FROM (SELECT item_id, {words} AS ws FROM benchmark)),
    docs AS (SELECT doc_id, ws, unnest(range(0, len(ws))) AS p
             FROM (SELECT doc_id, {words} AS ws FROM documents)),
    item_seeds AS ({_seeds("items", "item_id", "q", of_items)}),
    doc_seeds AS ({_seeds("docs", "doc_id", "p", of_docs)}),
    hits AS (
        SELECT doc_id, item_id, p, d.ws AS ws, p - q + greatest(0, q - {decontaminate.AROUND})
               AS shift, least({decontaminate.STRETCH}, len(i.ws)) AS span,
               i.ws[greatest(0, q - {decontaminate.AROUND}) + 1:
                    greatest(0, q - {decontaminate.AROUND}) + {near}] AS near
        FROM doc_seeds d JOIN item_seeds i USING (seed)),
    stretches AS (SELECT *, unnest(range(0, len(near) - span + 1)) AS s FROM hits),
    checked AS (
        SELECT doc_id, item_id, p, CAST(list_sum([
            CASE WHEN shift + s + k >= 0 AND near[s + k + 1] = ws[shift + s + k + 1]
            THEN 1 ELSE 0 END for k in range(0, span)]) AS DOUBLE) / span AS agreement FROM stretches)
    SELECT doc_id, item_id, max(agreement) AS agreement, CAST(min(p) AS INTEGER) AS first_word,
           CAST(max(p) AS INTEGER) AS last_word
    FROM checked WHERE agreement >= CAST({decontaminate.AGREE} AS DOUBLE)
    GROUP BY doc_id, item_id"""


UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def search_sql() -> str:
    terms = (f"regexp_extract_all(translate(text, {UPPER_LOWER}), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, doc_id, {terms} AS ts FROM documents),
    sized AS (SELECT d, doc_id, ts, len(ts) AS n FROM docs WHERE len(ts) > 0),
    totals AS (SELECT count(*) AS n_docs, sum(n) AS l FROM sized),
    normed AS (
        SELECT d, doc_id, 100 - 50 + CAST((50 * n * n_docs) // l AS BIGINT) AS m
        FROM sized, totals),
    asked AS (
        SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
    postings AS (
        SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(ts) AS term FROM sized)
        SEMI JOIN asked USING (term) GROUP BY d, term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2)
            / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY term),
    scored AS (
        SELECT item_id, d, doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 20 * m))) AS BIGINT)
            AS score
        FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN normed USING (d)
        GROUP BY item_id, d, doc_id),
    ranked AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
            ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 50"""


def collocations_sql() -> str:
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
            translate(coalesce(text, ''), {UPPER_LOWER}), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
        FROM documents),
    grams AS (
        SELECT lang, g, CAST(count(*) AS HUGEINT) AS a FROM (
            SELECT lang, unnest(list_concat(
                list_transform(ws, lambda x: [x]),
                list_transform(range(1, greatest(len(ws), 1)), lambda i: ws[i:i + 1]),
                list_transform(range(1, greatest(len(ws) - 1, 1)), lambda i: ws[i:i + 2]))) AS g
            FROM pieces)
        GROUP BY lang, g),
    totals AS (SELECT lang, sum(a) AS n FROM grams WHERE len(g) = 1 GROUP BY lang),
    candidates AS (SELECT * FROM grams WHERE len(g) > 1 AND a >= 10),
    inside AS (
        SELECT DISTINCT c.lang, c.g FROM candidates c JOIN (
            SELECT lang, g[1:2] AS g, a FROM candidates WHERE len(g) = 3
            UNION ALL SELECT lang, g[2:3], a FROM candidates WHERE len(g) = 3) longer
            ON c.lang = longer.lang AND c.g = longer.g AND 100 * longer.a >= 50 * c.a),
    cuts AS (
        SELECT c.lang, c.g, c.a, k, l.a AS l, r.a AS r, 1000000 * c.a * c.a // (l.a * r.a) AS score
        FROM (SELECT *, unnest(range(1, len(g))) AS k FROM candidates) c
        JOIN grams l ON l.lang = c.lang AND l.g = c.g[1:k]
        JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1:]
        ANTI JOIN inside ON inside.lang = c.lang AND inside.g = c.g),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS nth FROM cuts),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
            encode(array_to_string(g, ' '))) AS rank,
            array_to_string(g, ' ') AS phrase, a, l, r, score FROM best WHERE nth = 1)
    SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
        CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
