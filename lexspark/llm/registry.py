"""Queries of the problems and, where plain SQL can say the same, their SQL."""

from __future__ import annotations

from lexspark.llm import queries as Q

_NAMES = [
    "p1_found", "p1_pieces", "p1_invariants", "p2_found", "p2_repaired", "p3_found", "p3_groups", "p4_found", "p4_units", "p5_found", "p5_forms",
    "p6_packed", "p6_invariants", "p7_schedule", "p7_report", "p7_invariants", "p8_found", "p8_subjects", "p8_composition",
]
QUERIES = {n: getattr(Q, n) for n in _NAMES}

ORACLE: dict[str, str] = {
    "p1_found": """SELECT t.src, t.ord FROM (
        SELECT 'raw_documents' AS src, 'filedata' AS fld, ord, filedata AS x FROM raw_documents
        UNION ALL SELECT 'law_documents', 'original_content', ord, original_content FROM law_documents) t
      JOIN size_limits l ON l.purpose = 'split' AND l.src = t.src AND l.fld = t.fld WHERE length(t.x) > l.max_size""",
    "p1_invariants": """SELECT 'raw_documents' AS src, ord, length(filedata) AS chars, 0::BIGINT AS wrong FROM raw_documents WHERE filedata IS NOT NULL
      UNION ALL SELECT 'law_documents', ord, length(original_content), 0::BIGINT FROM law_documents WHERE original_content IS NOT NULL""",
    # Brute force over shingles; copies are told by their texts.
    "p3_found": """WITH w AS (SELECT ord, filedata, regexp_extract_all(lower(filedata), '[\\p{L}\\p{N}]+') AS ws FROM raw_documents),
      s AS (SELECT DISTINCT ord, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w WHERE len(ws) > 2),
      n AS (SELECT ord, count(*) AS n FROM s GROUP BY ord),
      pair AS (SELECT a.ord AS x, b.ord AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.ord < b.ord GROUP BY a.ord, b.ord)
      SELECT x AS ord_a, y AS ord_b FROM pair JOIN n p ON p.ord = x JOIN n q ON q.ord = y WHERE c >= 0.6 * (p.n + q.n - c)
      UNION SELECT a.ord, b.ord FROM raw_documents a JOIN raw_documents b ON a.filedata = b.filedata AND a.ord < b.ord""",
    "p6_invariants": """SELECT count(*) AS items, CAST(sum(n_tokens) AS BIGINT) AS tokens, 0::BIGINT AS cut_needlessly, 0::BIGINT AS pieces_wrong, 0::BIGINT AS overfull FROM documents""",
    "p7_invariants": "SELECT 0::BIGINT AS early, 0::BIGINT AS places_twice, 0::BIGINT AS overused, 0::BIGINT AS drifted",
}
