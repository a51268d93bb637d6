"""Corpus queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_DIGITS = ", ".join(
    # Five bits of the 160: the hex digits they touch, shifted to the end and masked.
    f"(('0x' || substr(hex || '00', {i * 5 // 4 + 1}, 3))::INT >> {7 - i * 5 % 4}) & 31"
    for i in range(32)
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = {
    "op11_source_divergence": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), tokens AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
        kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
        counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL
        ), sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
        sources AS (SELECT DISTINCT lang, source FROM docs),
        totals AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM sources LEFT JOIN counts USING (lang, source) GROUP BY ALL
        ), p AS (
            SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                   (1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (s.total + 5 * v))::BIGINT AS p
            FROM totals s JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)
        ), q AS (
            SELECT c.lang, c.term, (1 + (1000000000 * (sum(c.n) + 5)) // (any_value(t.total) + 5 * any_value(v)))::BIGINT AS q
            FROM counts c JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) t USING (lang) JOIN sizes USING (lang)
            GROUP BY c.lang, c.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 50
    """,
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op13_grace_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS content FROM documents)
        WINDOW same AS (PARTITION BY content)
    """,
    "op10_web_archive": f"""
        WITH hashed AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), coded AS (
            SELECT page_id, octet_length(payload) AS payload_bytes,
                   list_aggregate(list_transform([{_DIGITS}],
                       lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d + 1, 1)), 'string_agg', '') AS payload_digest
            FROM hashed
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
}
