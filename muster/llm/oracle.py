"""DuckDB SQL for the queries that SQL can express, written apart from them."""

from __future__ import annotations

_PII_KINDS = (
    # kind, pattern, condition on the match, words that count before it, base score
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", None),
    (
        "ip",
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "list_bool_and([length(ltrim(p, '0')) < 4 AND coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) <= 255"
        " FOR p IN string_split(found, '.')])",
        None,
    ),
    (
        "card",
        r"[0-9](?:[\x20-]?[0-9])+",
        "length(digits) BETWEEN 14 AND 19 AND list_sum([CASE WHEN (length(digits) - i) % 2 = 0"
        " THEN digits[i]::INT WHEN digits[i]::INT > 4 THEN 2 * digits[i]::INT - 9 ELSE 2 * digits[i]::INT END"
        " FOR i IN range(1, length(digits) + 1)]) % 10 = 0",
        None,
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 10 AND 15", None),
    (
        "iban",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        "list_reduce([0] || [CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END"
        " FOR c IN string_split(replace(found, ' ', '')[5:] || found[1:4], '')],"
        " lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1",
        None,
    ),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "true", "ssn|social security"),
)


def _pii() -> str:
    parts = []
    for place, (kind, pattern, condition, context) in enumerate(_PII_KINDS):
        near = (
            f"AND regexp_matches(lower(text[greatest(first - 39, 1):first]), '{context}')" if context else ""
        )
        parts.append(f"""
            SELECT doc_id, row, {place} AS place, '{kind}' AS kind, first, last FROM (
                SELECT *, list_sum(sizes[:2 * n - 1])::BIGINT AS first, list_sum(sizes[:2 * n])::BIGINT AS last,
                       regexp_replace(found, '[^0-9]', '', 'g') AS digits
                FROM (
                    SELECT doc_id, row, text, unnest(matches) AS found, unnest(range(1, len(matches) + 1)) AS n,
                           flatten([[length(before[i]), length(matches[i])] FOR i IN range(1, len(matches) + 1)]) AS sizes
                    FROM (
                        SELECT doc_id, row, text,
                               regexp_extract_all(text, '(?s)(.*?)({pattern})', 1) AS before,
                               regexp_extract_all(text, '(?s)(.*?)({pattern})', 2) AS matches
                        FROM docs
                    )
                )
            ) WHERE {condition} {near}""")
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
    spans AS ({' UNION ALL '.join(parts)}),
    joined AS (
        SELECT row,
               count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
               count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
               string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, place) FILTER (place < 4) AS base,
               string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, place) AS spans
        FROM spans GROUP BY row
    )
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
           coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM docs LEFT JOIN joined USING (row)"""


_FINITE = "embedding IS NOT NULL AND list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding])"

_TOP_K = f"""
    WITH vectors AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings WHERE {_FINITE}
    ), scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id, score
    FROM scores QUALIFY rank <= 5"""

_WARC = """
    WITH hashed AS (
        SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
    ), first AS (
        SELECT *, strlen(html) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first_id FROM hashed
    )
    SELECT page_id, payload_bytes,
           array_to_string([
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                   ((('0x' || hex[10 * (i // 8) + 1:10 * (i // 8) + 10])::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1
               ] FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM first"""


_VECTOR_LINKS = f"""
    WITH RECURSIVE units AS (
        SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
        WHERE {_FINITE} AND list_bool_or([x <> 0 FOR x IN embedding])
    ), links AS (
        SELECT p.vec_id AS a, q.vec_id AS b FROM units p JOIN units q
        ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.v, q.v) >= 0.9
    ), reached AS (
        SELECT DISTINCT a AS id, a AS other FROM links
        UNION
        SELECT id, b FROM reached JOIN links ON a = other
    ), found AS (
        SELECT id, min(other) AS least FROM reached GROUP BY id
    ), counts AS (
        SELECT a AS id, count(*) AS n FROM links GROUP BY a
    )
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id,
           coalesce(least, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN found ON found.id = vec_id LEFT JOIN counts ON counts.id = vec_id"""


_TEXT_LINKS = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
        FROM words
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), sets AS (
        SELECT doc_id, n, md5(string_agg(s, chr(10) ORDER BY s)) AS print
        FROM shingles JOIN sizes USING (doc_id) GROUP BY doc_id, n
    ), classes AS (
        SELECT print, n, min(doc_id) AS id FROM sets GROUP BY print, n
    ), held AS (
        SELECT id, n, s FROM classes JOIN shingles ON doc_id = id
    ), common AS (
        SELECT p.id AS a, q.id AS b, any_value(p.n + q.n) AS total, count(*) AS n
        FROM held p JOIN held q ON p.s = q.s AND p.id < q.id GROUP BY p.id, q.id
    ), links AS (
        SELECT a, b FROM common WHERE 100 * n >= 75 * (total - n)
        UNION ALL SELECT b, a FROM common WHERE 100 * n >= 75 * (total - n)
    ), reached AS (
        SELECT DISTINCT a AS id, a AS other FROM links
        UNION
        SELECT id, b FROM reached JOIN links ON a = other
    ), found AS (
        SELECT id, min(other) AS least FROM reached GROUP BY id
    )
    SELECT doc_id, coalesce(sets.n, 0)::BIGINT AS n_shingles,
           coalesce(least, classes.id, doc_id) AS component_id,
           coalesce(least, classes.id, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN sets USING (doc_id) LEFT JOIN classes USING (print, n) LEFT JOIN found USING (id)"""


def _words(text: str) -> str:
    return (
        f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


_RESAMPLING = f"""
    WITH RECURSIVE step AS (
        SELECT [list_reduce([b] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                FOR b IN range(256)] AS t
    ), docs AS (
        SELECT row_number() OVER () AS row, doc_id, {_words("coalesce(text, '')")} AS w FROM documents
    ), words AS (
        SELECT true AS ours, row, unnest(w) AS a, unnest(range(len(w))) AS i FROM docs
        UNION ALL
        SELECT false, row, unnest(w), unnest(range(len(w)))
        FROM (SELECT row_number() OVER () AS row, {_words("coalesce(text, '')")} AS w FROM benchmark)
    ), runs AS (
        SELECT ours, row, a, lead(a) OVER following AS b, lead(a, 2) OVER following AS c FROM words
        WINDOW following AS (PARTITION BY ours, row ORDER BY i)
    ), features AS (
        SELECT ours, row, a AS f FROM runs
        UNION ALL SELECT ours, row, a || ' ' || b FROM runs WHERE b IS NOT NULL
        UNION ALL SELECT ours, row, a || ' ' || b || ' ' || c FROM runs WHERE c IS NOT NULL
    ), doc_features AS (
        SELECT row, f FROM features WHERE ours
    ), target_features AS (
        SELECT f FROM features WHERE NOT ours
    ), spelt AS MATERIALIZED (
        SELECT row_number() OVER () AS k, f, hex(encode(f)) AS h, length(h) // 2 AS n
        FROM (SELECT f FROM doc_features UNION SELECT f FROM target_features)
    ), bytes AS (
        SELECT k, n - i - 1 AS distance, h[2 * i + 1:2 * i + 2] AS byte
        FROM (SELECT k, n, h, unnest(range(n)) AS i FROM spelt)
    ), contributions AS (
        SELECT 0 AS distance, unnest(range(256)) AS b, unnest(t) AS c FROM step
        UNION ALL
        SELECT distance + 1, b, xor(c >> 8, t[(c & 255) + 1]) FROM contributions, step
        WHERE distance < (SELECT max(n) FROM spelt)
    ), starts AS (
        SELECT 0 AS n, 4294967295 AS r
        UNION ALL
        SELECT n + 1, xor(r >> 8, t[(r & 255) + 1]) FROM starts, step WHERE n < (SELECT max(n) FROM spelt)
    ), spans AS (
        SELECT k, bit_xor(c) AS x
        FROM bytes JOIN (SELECT distance, printf('%02X', b) AS byte, c FROM contributions) USING (distance, byte)
        GROUP BY k
    ), buckets AS (
        SELECT f, xor(4294967295, xor(r, x)) % 10000 AS bucket FROM spelt JOIN spans USING (k) JOIN starts USING (n)
    ), source_counts AS (
        SELECT bucket, count(*) AS s FROM doc_features JOIN buckets USING (f) GROUP BY bucket
    ), target_counts AS (
        SELECT bucket, count(*) AS t FROM target_features JOIN buckets USING (f) GROUP BY bucket
    ), totals AS (
        SELECT (SELECT count(*) FROM doc_features) AS every_s, (SELECT count(*) FROM target_features) AS every_t
    ), gains AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (every_s::DOUBLE + 10000)
                                       / ((coalesce(s, 0)::DOUBLE + 1) * (every_t::DOUBLE + 10000))))::BIGINT AS gain
        FROM source_counts FULL JOIN target_counts USING (bucket), totals
    ), summed AS (
        SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
        FROM doc_features JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY row
    ), scored AS (
        SELECT row, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               ('0x' || sha256('42:' || doc_id)[:8])::BIGINT::DOUBLE AS h
        FROM docs LEFT JOIN summed USING (row)
    ), noised AS (
        SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score,
               n_words >= 20 AND doc_id IS NOT NULL AS open
        FROM scored
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY open ORDER BY score DESC, doc_id) AS place,
               count(*) FILTER (open) OVER () AS n
        FROM noised
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN open AND place <= 5 * n // 100 THEN place END AS rank
    FROM ranked"""


_HARD_NEGATIVES = f"""
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
    ), scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
        FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_dedup": _VECTOR_LINKS,
        "op3_pii": _pii(),
        "op6_exact_top_k": _TOP_K,
        "op7_minhash_dedup": _TEXT_LINKS,
        "op10_warc": _WARC,
        "op12_importance": _RESAMPLING,
        "op13_hard_negatives": _HARD_NEGATIVES,
    }
