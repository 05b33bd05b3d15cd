"""SQL of the queries that SQL can express, in the dialect of DuckDB."""

from __future__ import annotations

from wordtide.llm import rules

_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PASSAGES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words
    FROM documents
), windows AS (
    SELECT row, doc_id, s, md5(array_to_string(list_slice(words, s, s + 49), ' ')) AS key
    FROM docs, unnest(range(1, len(words) - 48)) AS t(s)
    WHERE len(words) >= 50
), firsts AS (
    SELECT key, min(doc_id) AS low FROM windows GROUP BY key
), gone AS (
    SELECT DISTINCT row, p
    FROM windows JOIN firsts USING (key), unnest(range(s, s + 50)) AS u(p)
    WHERE low < doc_id
), kept AS (
    SELECT d.row, string_agg(words[p], ' ' ORDER BY p) AS text, count(*) AS n
    FROM docs d, unnest(range(1, len(words) + 1)) AS t(p)
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.row = d.row AND g.p = t.p)
    GROUP BY d.row
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
"""

DECONTAMINATION = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWERED}, '{_PLAIN}') AS words FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({_LOWERED}, '{_PLAIN}') AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(list_slice(words, s, s + 9), ' ') AS key
    FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(s)
    WHERE len(words) > 0
), places AS (
    SELECT row, s, n, array_to_string(list_slice(words, s, s + n - 1), ' ') AS key
    FROM docs, (SELECT DISTINCT n FROM windows) AS lengths, unnest(range(1, len(words) - n + 2)) AS t(s)
    WHERE len(words) >= n
), hits AS (
    SELECT row, s, n, item_id FROM places JOIN windows USING (n, key)
), covered AS (
    SELECT row, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + n)) AS t(p) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), owners AS (
    SELECT hex, max(page_id) AS owner FROM payloads GROUP BY hex
), digits AS (
    SELECT hex, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 10 * part, 10))::BIGINT >> shift) & 31)::INT, 1),
        '' ORDER BY part, shift DESC) AS digest
    FROM owners, unnest([0, 1, 2, 3]) AS p(part), unnest([0, 5, 10, 15, 20, 25, 30, 35]) AS q(shift)
    GROUP BY hex
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < owner THEN owner END AS refers_to, true AS intact
FROM payloads JOIN owners USING (hex) JOIN digits USING (hex)
"""


def quality_rules() -> str:
    share = rules.RISK / len(rules.LADDERS)
    ladder = ", ".join(f"('{s}', {c!r}::DOUBLE)" for s, cs in rules.LADDERS.items() for c in cs)
    rungs = sum(map(len, rules.LADDERS.values()))
    names = sorted(rules.LADDERS)
    chosen = ", ".join(f"min(cutoff) FILTER (signal = '{s}') AS {s}_cut" for s in names)
    above = ", ".join(
        f"CASE WHEN NOT base_failed AND {s} > {s}_cut THEN '{s}' END" for s in rules.LADDERS
    )
    return rf"""
WITH base AS (
    SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS lines
    FROM documents
), windows AS (
    SELECT row, s, array_to_string(list_slice(words, s, s + 7), ' ') AS key
    FROM base, unnest(range(1, len(words) - 6)) AS t(s) WHERE len(words) >= 8
), repeated AS (
    SELECT row, count(DISTINCT p) AS n_repeat_words
    FROM windows JOIN (SELECT row, key FROM windows GROUP BY row, key HAVING count(*) > 1) USING (row, key),
         unnest(range(s, s + 8)) AS t(p)
    GROUP BY row
), measures AS (
    SELECT row, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
           length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts
    FROM base LEFT JOIN repeated USING (row)
), signals AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_share,
           coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
           coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_share,
           coalesce(n_capitals / nullif(word_chars, 0), 0) AS capital_share,
           coalesce(n_shouts / nullif(n_words, 0), 0) AS shout_share
    FROM measures
), good AS (
    SELECT * FROM signals WHERE doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)
), long AS (
    UNPIVOT (SELECT lang, {", ".join(names)} FROM good) ON {", ".join(names)} INTO NAME signal VALUE value
), ladder(signal, cutoff) AS (VALUES {ladder}),
tested AS (
    SELECT lang, signal, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
    FROM long JOIN ladder USING (signal) GROUP BY ALL
), level AS (
    SELECT ln({rules.DELTA} / (count(DISTINCT coalesce('x' || lang, '')) * {rungs})) AS level FROM good
), passed AS (
    SELECT lang, signal, cutoff FROM tested, level
    WHERE k < n * {share!r} AND (
        SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r})))
        FROM unnest(range(0, k + 1)) AS t(i)
    ) <= exp(level)
), cuts AS (
    SELECT lang AS of, {chosen} FROM passed GROUP BY lang
), judged AS (
    SELECT *, array_to_string(list_filter([{above}], lambda x: x IS NOT NULL), ',') AS rejected_by
    FROM signals LEFT JOIN cuts ON lang IS NOT DISTINCT FROM of
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by = '' AS kept, rejected_by
FROM judged
"""

COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), counted AS (
  SELECT lang, phrase, n_words, count(*) AS a FROM (
    SELECT lang, m.k AS n_words, unnest(list_transform(range(1, len(w) - m.k + 2), lambda i: array_to_string(w[i : i + m.k - 1], ' '))) AS phrase
    FROM split, (VALUES (1), (2), (3), (4)) m(k) WHERE len(w) >= m.k
  ) GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE n_words = 1 GROUP BY lang
), known AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE a >= 30
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : n_words], ' ') AS rest
  FROM (SELECT *, unnest(range(1, n_words)) AS k FROM known WHERE n_words > 1)
), scores AS (
  SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, ((2000000::HUGEINT * c.a) // (h.a::HUGEINT + t.a))::BIGINT AS score
  FROM cuts c JOIN known h ON h.lang = c.lang AND h.phrase = c.head JOIN known t ON t.lang = c.lang AND t.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, max(a) AS most, phrase FROM (
    SELECT lang, a, unnest(list_transform(range(1, n_words - m.k + 2), lambda i: array_to_string(w[i : i + m.k - 1], ' '))) AS phrase
    FROM known, (VALUES (2), (3)) m(k) WHERE m.k < n_words
  ) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM scores s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_benchmark_decontamination": DECONTAMINATION,
        "op4_warc_round_trip": WARC,
        "op6_quality_rules": quality_rules(),
        "op8_suffix_array_dedup": PASSAGES,
        "op10_substring_dedup": PASSAGES,
        "op11_phrase_collocations": COLLOCATIONS,
    }
