"""The results of the operators that SQL can express, written plainly for a reference database."""

from __future__ import annotations

_CONVERSATIONS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
    SELECT *, row_number() OVER w AS place, role IS NOT DISTINCT FROM lag(role) OVER w AS again
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
        + CASE WHEN again THEN length('<|im_again|>')
            ELSE length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

_REPEATED_WORDS = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM split WHERE len(w) >= 13)
), owners AS (
    SELECT passage, min(doc_id) AS owner FROM windows GROUP BY passage
), gone AS (
    SELECT DISTINCT doc_id, p + unnest(range(13)) AS p
    FROM windows JOIN owners USING (passage) WHERE owner < doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split
), judged AS (
    SELECT words.doc_id, word, words.p, gone.p IS NOT NULL AS removed
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
)
SELECT doc_id, count(word) AS n_words,
    count(*) FILTER (removed) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT removed), '')) AS kept_sha256
FROM documents LEFT JOIN judged USING (doc_id) GROUP BY doc_id
"""

_NEAR_VECTORS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.a LEFT JOIN counted ON e.vec_id = counted.a
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_TEXTS = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, w[p] || ' ' || w[p + 1] AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM split WHERE len(w) > 1)
    UNION ALL SELECT doc_id, w[1] FROM split WHERE len(w) = 1
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON d.doc_id = a LEFT JOIN sizes ON d.doc_id = sizes.doc_id
"""

_BENCHMARK_HITS = rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS passage
    FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM items WHERE len(w) > 0)
), windows AS (
    SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS passage
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM words JOIN (SELECT DISTINCT size FROM patterns) ON len(w) >= size)
), found AS (
    SELECT doc_id, p, size, item_id FROM windows JOIN patterns USING (size, passage)
), hit AS (
    SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
    coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id LEFT JOIN named ON words.doc_id = named.doc_id
"""

_REPEATED_BYTES = """
WITH bytes AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
    SELECT doc_id, p, md5(b[p:p + 49]) AS passage
    FROM (SELECT doc_id, b, unnest(range(1, n - 48)) AS p FROM bytes WHERE n >= 50)
), owners AS (
    SELECT passage, min(doc_id) AS owner FROM windows GROUP BY passage
), gone AS (
    SELECT DISTINCT doc_id, p + unnest(range(50)) AS p
    FROM windows JOIN owners USING (passage) WHERE owner < doc_id
), each AS (
    SELECT doc_id, unnest(range(1, n + 1)) AS p, unnest(regexp_extract_all(hex(b), '..')) AS byte FROM bytes
), judged AS (
    SELECT each.doc_id, each.p, byte, gone.p IS NOT NULL AS removed
    FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.p = gone.p
), edges AS (
    SELECT *, lag(removed, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM judged
)
SELECT doc_id, count(p) AS n_bytes, count(*) FILTER (removed) AS n_removed,
    count(*) FILTER (removed AND NOT before) AS n_spans,
    sha256(unhex(coalesce(string_agg(byte, '' ORDER BY p) FILTER (NOT removed), ''))) AS kept_sha256
FROM documents LEFT JOIN edges USING (doc_id) GROUP BY doc_id
"""

# Stretches of six and more words that match those q words on are found by windows of six
# words: a run has max(12, 2q) - q matching words at least. crc32 is worked out bit by bit.
_RUNS = r"""
WITH hashed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o,
        xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
    FROM documents
), placed AS (
    SELECT *, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM hashed
), split AS (
    SELECT doc_id, CASE WHEN a IS NULL THEN o
        ELSE [o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(o) - a) // (3 + (h // 10) % 8)) END] FOR i IN range(len(o))] END AS w
    FROM placed
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS passage
    FROM (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM split WHERE len(w) >= 12)
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM windows x JOIN windows y ON x.doc_id = y.doc_id AND x.passage = y.passage AND x.i < y.i
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
    SELECT doc_id, q, min(i) AS start, max(i) + 6 + q AS stop FROM islands GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, stop, stop - start AS length, min(q) AS period FROM stretches
    WHERE stop - start >= greatest(12, 2 * q) GROUP BY doc_id, start, stop
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, stop)) AS i FROM runs
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing,
        max_by({'start': start, 'length': length, 'period': period}, [length, -start, -period]) AS best
    FROM runs GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM split
), kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i WHERE gone.i IS NULL GROUP BY words.doc_id
)
SELECT split.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start, best.length, best.period,
    1000 * best.length // best.period AS exponent_milli,
    sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM split LEFT JOIN listed ON split.doc_id = listed.doc_id LEFT JOIN kept ON split.doc_id = kept.doc_id
"""

_MIX = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::HUGEINT AS size, row_number() OVER (ORDER BY source NULLS LAST) % 3 AS kind
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [1, 5, 2][kind + 1]::HUGEINT AS w, sum(size) OVER () AS words FROM sources
), rounds AS (
    SELECT 0 AS turn, source, size, kind, w, words, false AS topped, 150 * words AS rest, sum(w) OVER () AS open_w FROM weighed
    UNION ALL
    SELECT turn + 1, source, size, kind, w, words, now,
        150 * words - coalesce(sum(CASE WHEN now THEN 200 * size END) OVER (), 0),
        coalesce(sum(CASE WHEN NOT now THEN w END) OVER (), 0)
    FROM (SELECT *, topped OR rest * w > 200 * size * open_w AS now, bool_or(NOT topped AND rest * w > 200 * size * open_w) OVER () AS more FROM rounds)
    WHERE more
), targets AS (
    SELECT source, size::BIGINT AS source_size, kind,
        CASE WHEN topped THEN (2 * size)::DOUBLE ELSE (rest * w)::DOUBLE / (100 * open_w)::DOUBLE END AS target
    FROM rounds WHERE turn = (SELECT max(turn) FROM rounds)
), placed AS (
    SELECT doc_id, sized.size, source_size, kind, target, floor(target)::BIGINT AS demand,
        (sum(sized.size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, sized.size ROWS UNBOUNDED PRECEDING) - sized.size)::BIGINT AS behind
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), shares AS (
    SELECT *, greatest(least(demand - behind, size), 0) AS once, greatest(least(demand - behind - source_size, size), 0) AS twice,
        behind::DOUBLE / demand::DOUBLE AS u
    FROM placed
)
SELECT doc_id, size, source_size, target, (once + twice)::BIGINT AS taken,
    CASE WHEN once > 0 THEN floor(1e9::DOUBLE * CASE kind
        WHEN 1 THEN 2 * (u * 5) / greatest(8 + sqrt(64 - 12 * (u * 5)), 1e-300)
        WHEN 2 THEN 2 * (u * 2) / (2 + sqrt(4::DOUBLE))
        ELSE CASE WHEN u > 0 THEN 2 * u / sqrt(4 * u) ELSE 0 END END)::BIGINT END AS position_ppb
FROM shares
"""

_PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, array_to_string(w[p:p + size - 1], ' ') AS phrase, size, count(*) AS f
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM split, range(1, 5) AS t(size) WHERE len(w) >= size)
    GROUP BY ALL
), counts AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 30
), inside AS (
    SELECT lang, array_to_string(w[p:p + part - 1], ' ') AS phrase, max(f) AS longer
    FROM (SELECT lang, w, f, part, unnest(range(1, size - part + 2)) AS p FROM candidates, range(2, 4) AS t(part) WHERE part < size)
    GROUP BY ALL
), cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
    FROM cuts JOIN grams x ON x.lang = cuts.lang AND x.phrase = head JOIN grams y ON y.lang = cuts.lang AND y.phrase = tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), open AS (
    SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
    WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT open.lang, row_number() OVER (PARTITION BY open.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM open JOIN counts ON open.lang = counts.lang
QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_chat_format": _CONVERSATIONS,
    "op3_substring_dedup": _REPEATED_WORDS,
    "op5_embedding_dedup": _NEAR_VECTORS,
    "op6_minhash_dedup": _NEAR_TEXTS,
    "op7_decontamination": _BENCHMARK_HITS,
    "op9_suffix_dedup": _REPEATED_BYTES,
    "op11_periodic_runs": _RUNS,
    "op12_mixing": _MIX,
    "op13_phrases": _PHRASES,
}
