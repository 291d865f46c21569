"""DuckDB SQL of the queries that SQL can express, written apart from the operators.

The trained operators, the estimation over votes, the entropy spans and the tokenizer are not
expressible; tests/llm compares them with brute force.
"""

from __future__ import annotations

CRC32 = """
crc_steps AS (
    SELECT range AS n, 0 AS step, range::BIGINT AS c FROM range(256)
    UNION ALL
    SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE step = 8)"""

SHARDING = f"""
WITH RECURSIVE {CRC32},
bytes AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
            lambda h: ('0x' || h)::BIGINT) AS b
    FROM documents),
rows_ AS (
    SELECT doc_id, source, len(b) + 16 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, b),
            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32,
        ('0x' || substr(md5('20240601:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS key
    FROM bytes, crc_table),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key) - 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY source) AS fraction
    FROM rows_),
placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, coalesce('=' || source, '~')) - 1 AS place,
        count(*) OVER () AS total
    FROM ranked),
dealt AS (SELECT *, place * 40 // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
    place - (shard * total + 39) // 40 AS slot, NULL::INTEGER AS grown_shard, source
FROM dealt
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w
    FROM documents),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w
    FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
patterns AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS pattern
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
windows AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS pattern
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM patterns))),
found AS (SELECT doc_id, i, size, item_id FROM windows JOIN patterns USING (size, pattern)),
hit AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

MIXING = r"""
WITH d AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('7041:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS number
    FROM documents),
drawn AS (SELECT *, (number + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d),
ordered AS (
    SELECT *, (u / (1 - u)) / ((size + 1::DOUBLE) / (size + 50::DOUBLE)) AS quotient FROM drawn),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighed AS (
    SELECT *, 2 * source_size AS most,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM totals),
levels AS (
    SELECT *, row_number() OVER f AS nth,
        (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - (sum(most) OVER f - most)::DOUBLE)
            / (sum(weight) OVER () - sum(weight) OVER f + weight)::DOUBLE AS level
    FROM weighed
    WINDOW f AS (ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST)),
first AS (SELECT arg_min(level, nth) AS level, min(nth) AS nth FROM levels
    WHERE level * weight <= most),
targets AS (
    SELECT source, source_size,
        CASE WHEN levels.nth < first.nth THEN most::DOUBLE ELSE first.level * weight END AS target
    FROM levels, first),
parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
    FROM targets),
running AS (
    SELECT o.*, source_size, target, whole, target - whole * source_size AS rest,
        sum(size) OVER (PARTITION BY o.source ORDER BY quotient, number, size
            ROWS UNBOUNDED PRECEDING) AS upto
    FROM ordered o JOIN parts p ON o.source IS NOT DISTINCT FROM p.source),
taken AS (
    SELECT *, whole + CASE WHEN rest > 0 AND (upto <= rest
        OR (upto - size < rest AND upto - rest <= rest - (upto - size))) THEN 1 ELSE 0 END AS copies
    FROM running)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source,
    copies::BIGINT AS copies
FROM taken
"""

PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
split_ AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split_ GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split_ WHERE len(w) > 0),
counts AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f
    FROM places, (SELECT unnest(range(1, 5)) AS size) AS sizes
    WHERE i + size - 1 <= len(w)
    GROUP BY ALL HAVING count(*) >= 30),
found AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (
    SELECT lang, phrase, size, a, w, k, array_to_string(w[1:k], ' ') AS p,
        array_to_string(w[k + 1:], ' ') AS q
    FROM (SELECT *, unnest(range(1, size)) AS k FROM found)),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
        (2000000 * c.a::HUGEINT // (x.f + y.f))::BIGINT AS score, c.k
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.p
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.q
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
spans AS (
    SELECT lang, a, w, size, i, unnest(range(i + 1, size + 1)) AS j
    FROM (SELECT *, unnest(range(1, size)) AS i FROM found WHERE size > 2)),
around AS (
    SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer
    FROM spans WHERE j - i + 1 < size GROUP BY ALL),
kept AS (
    SELECT s.* FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE o.longer IS NULL OR 100 * o.longer::HUGEINT < 80 * s.a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""

ORACLES = {
    "op1_sharding": SHARDING,
    "op2_decontamination": DECONTAMINATION,
    "op4_mixing": MIXING,
    "op13_phrase_mining": PHRASES,
}
