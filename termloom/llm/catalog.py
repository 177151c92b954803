"""Queries of the llm subpackage, and their SQL."""

from __future__ import annotations

from termloom.llm import canonical_terms, components, entity_matching, formatting_duplicates, leaks, packing, subjects, survivors

QUERIES = {
    "p1_found": formatting_duplicates.p1_found,
    "p3_found": components.p3_found,
    "p4_found": canonical_terms.p4_found,
    "p5_found": survivors.p5_found,
    "p5_truths": survivors.p5_truths,
    "p6_found": entity_matching.p6_found,
    "p6_confidence": entity_matching.p6_confidence,
    "p8_pack": packing.p8_pack,
    "p8_invariants": packing.p8_invariants,
    "p9_found": leaks.p9_found,
    "p10_found": subjects.p10_found,
}

SQL: dict[str, str] = {
    "p8_invariants": """
        SELECT count(DISTINCT doc_id) AS documents, sum(greatest(1, ceil(n / 50000.0)))::BIGINT AS parts, sum(n)::BIGINT AS chars, 0::BIGINT AS overfull, 0::BIGINT AS split, 0::BIGINT AS unused, true AS few
        FROM (SELECT doc_id, greatest(coalesce(n_chars, 0), 0) AS n FROM documents)""",
    "p1_found": """
        WITH canon AS (
          SELECT product_id, row_id,
            coalesce(regexp_replace(lower(proper_name), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g'), '') AS a,
            coalesce(regexp_replace(lower(common_name), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g'), '') AS b
          FROM nhp_medicinal_ingredients)
        SELECT product_id, min(row_id) AS row_id, count(*) AS copies
        FROM canon GROUP BY product_id, least(a, b), greatest(a, b) HAVING count(*) >= 2""",
    "p3_found": """
        WITH RECURSIVE e AS (
          SELECT DISTINCT a.ui AS u, b.ui AS v
          FROM connections c JOIN ingredients a ON a.cidx = c.i JOIN ingredients b ON b.cidx = c.j WHERE a.ui <> b.ui),
        edges AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
        reach(ui, other) AS (SELECT u, u FROM edges UNION SELECT r.ui, x.v FROM reach r JOIN edges x ON x.u = r.other)
        SELECT ui, min(other) AS group_ui FROM reach GROUP BY ui""",
    "p5_found": r"""
        WITH ranks AS (
          SELECT regexp_replace(lower(src), '[^a-z0-9]+', '', 'g') AS k, src_rank AS r FROM source_rank
          UNION ALL SELECT regexp_replace(lower(src_name), '[^a-z0-9]+', '', 'g'), src_rank FROM source_rank),
        many AS (SELECT ui FROM ingredients WHERE ui IS NOT NULL GROUP BY ui HAVING count(*) >= 2),
        rws AS (SELECT i.* FROM ingredients i JOIN many USING (ui)),
        syn AS (SELECT ui, cidx, updated_at, unnest(synonyms) AS s FROM rws),
        full_ AS (SELECT * FROM syn WHERE regexp_matches(coalesce(s.term, ''), '[^\s\p{Z}]')),
        pref AS (
          SELECT f.ui, f.cidx, f.updated_at, min(coalesce(r.r, 1000000)) AS b
          FROM full_ f LEFT JOIN ranks r ON r.k = regexp_replace(lower(f.s.src), '[^a-z0-9]+', '', 'g')
          WHERE f.s.is_preferred GROUP BY ALL),
        trm AS (
          SELECT ui, cidx, updated_at, count(DISTINCT lower(regexp_replace(s.term, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'))) AS b
          FROM full_ GROUP BY ALL),
        atr AS (SELECT DISTINCT ui, cidx, updated_at FROM (SELECT ui, cidx, updated_at, unnest(attributes) AS a FROM rws)
                WHERE regexp_matches(coalesce(a.atr_value, ''), '[^\s\p{Z}]')),
        every AS (
          SELECT 'preferred_term' AS survives, ui, cidx, updated_at, -b AS b FROM pref
          UNION ALL SELECT 'synonyms', ui, cidx, updated_at, b FROM trm
          UNION ALL SELECT 'attributes', ui, cidx, updated_at, 0 FROM atr)
        SELECT ui, survives, cidx FROM every
        QUALIFY row_number() OVER (PARTITION BY ui, survives ORDER BY b DESC, updated_at DESC NULLS LAST, cidx) = 1""",
}
