"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from quillon.llm import licenses

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
ip AS (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT item_id, w, least(len(w), 5) AS k FROM i WHERE len(w) > 0)),
s AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM ip),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM s)),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + k - 1], ' ') AS s FROM dp)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM k JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id
"""


def license_scan() -> str:
    """The lines that name a copyright go one by one, as DuckDB's expressions can't look ahead."""
    edge = r"^[^\p{L}\p{N}]*"
    owned = rf"(regexp_matches(l, '{edge}(copyright\b|©|\(c\))') AND NOT regexp_matches(l, '{edge}copyright\s+(holder|owner|notice|law)'))"

    def canonical(text: str) -> str:
        lines = f"array_to_string(list_transform(string_split(lower({text}), chr(10)), lambda l: CASE WHEN {owned} THEN ' ' ELSE l END), chr(10))"
        t = rf"' ' || regexp_replace(regexp_replace({lines}, 'all rights reserved\.?', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
        for other, usual in licenses.SPELLINGS.items():
            t = f"replace({t}, ' {other} ', ' {usual} ')"
        return f"trim({t})"

    known = ", ".join(f"('{digest}', '{name}')" for digest, name in licenses.known_rows())
    marked = f"regexp_matches(lower(t), '{licenses.MARKS}')"
    return f"""
WITH known(h, license) AS (VALUES {known}),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
whole AS (SELECT doc_id, CASE WHEN {marked} THEN sha256({canonical("t")}) END AS digest FROM d),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS t FROM d WHERE {marked}),
hits AS (SELECT doc_id, license FROM (SELECT doc_id, sha256({canonical("t")}) AS h FROM lines WHERE {marked}) JOIN known USING (h)),
names AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_license_lines FROM hits GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.license, coalesce(n.line_licenses, '') AS line_licenses, coalesce(n.n_license_lines, 0) AS n_license_lines
FROM whole w LEFT JOIN known k ON k.h = w.digest LEFT JOIN names n ON n.doc_id = w.doc_id
"""
