"""DuckDB SQL that the queries of this subpackage must agree with, where SQL can express them."""

# Base 32 of the 160 bits of a SHA-1: every 5 hexadecimal digits are 4 characters.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, {5 * i + 1}, 5))::BIGINT >> {shift}) & 31) + 1)::BIGINT, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)

ORACLES: dict[str, str] = {
    "op1_warc": f"""
        WITH page AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
        ), placed AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS largest FROM page
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
            CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM placed
    """,
    "op3_perspectives": """
        WITH said AS (
            SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content,
                row_number() OVER (
                    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')
                ) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), views AS (
            SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'
        ), seen AS (
            SELECT conv_id, perspective, pos // 64 AS part, pos, content, speaker = perspective AS own,
                CASE WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
                    WHEN speaker = 'system' THEN '<|system|>' || chr(10)
                    ELSE '<|user|>' || speaker || chr(10) END AS head
            FROM said JOIN views USING (conv_id)
        ), laid AS (
            SELECT *, head || content || '<|end|>' || chr(10) AS piece,
                sum(length(head) + length(content) + 8) OVER (
                    PARTITION BY conv_id, perspective, part ORDER BY pos
                ) - length(content) - 8 AS start
            FROM seen
        )
        SELECT conv_id, perspective, part::INTEGER AS part, count(*) AS n_messages,
            string_agg(piece, '' ORDER BY pos) AS text,
            coalesce(string_agg(start || '-' || (start + length(content)), ',' ORDER BY pos) FILTER (WHERE own), '') AS mask,
            coalesce(sum(length(content)) FILTER (WHERE own), 0)::BIGINT AS n_trained
        FROM laid GROUP BY conv_id, perspective, part
    """,
    # The classes and counts of shared shingles by plain joins; components by following links.
    "op6_jaccard": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
            ) AS words FROM documents
        ), listed AS (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
            FROM worded
        ), shingle AS (
            SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM listed
        ), links AS (
            SELECT a.doc_id AS u, b.doc_id AS v FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reached(doc_id, found) AS (
            SELECT doc_id, doc_id FROM listed UNION SELECT r.doc_id, l.v FROM reached r JOIN links l ON r.found = l.u
        )
        SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least.component_id
        FROM listed JOIN (SELECT doc_id, min(found) AS component_id FROM reached GROUP BY doc_id) least USING (doc_id)
    """,
    "op9_lattice": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
        ), reached(vec_id, found) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM reached r JOIN links l ON r.found = l.u
        ), least AS (SELECT vec_id, min(found) AS component_id FROM reached GROUP BY vec_id)
        SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept
        FROM least
    """,
    "op11_exact": """
        WITH named AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        ), placed AS (
            SELECT *, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size FROM named
            WINDOW same AS (PARTITION BY text_sha256)
        )
        SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256 FROM placed
    """,
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
            )) AS piece FROM documents
        ), worded AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), gram AS (
            SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
            FROM worded, (VALUES (1), (2), (3), (4), (5)) AS size(k) WHERE len(words) >= k
        ), f AS (
            SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100
        ), total AS (
            SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang
        ), cuts AS (
            SELECT lang, phrase, string_split(phrase, ' ') AS w, f AS a, unnest(range(1, f.k)) AS c FROM f WHERE k > 1
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, c, p.f AS l, q.f AS r, n,
                (1000::HUGEINT * a * n) // (p.f::HUGEINT * q.f) AS score
            FROM cuts JOIN total USING (lang)
            JOIN f p ON p.lang = cuts.lang AND p.phrase = array_to_string(w[1:c], ' ')
            JOIN f q ON q.lang = cuts.lang AND q.phrase = array_to_string(w[c + 1:], ' ')
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ), inside AS (
            SELECT lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' '))) AS phrase
            FROM f, (VALUES (2), (3), (4)) AS part(m) WHERE m < k
        ), left_over AS (
            SELECT * FROM lowest WHERE NOT EXISTS (
                SELECT 1 FROM inside WHERE inside.lang = lowest.lang AND inside.phrase = lowest.phrase AND 100 * inside.f >= 100 * a
            )
        )
        SELECT * FROM (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
                phrase, a, l, r, n, score::BIGINT AS score FROM left_over
        ) WHERE rank <= 2000
    """,
}
