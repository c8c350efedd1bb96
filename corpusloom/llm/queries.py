"""Queries of the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .annular import OP12_SQL, op12_annular
from .bpe import op4_bpe
from .mainbody import op6_main_text
from .mixing import op2_mix
from .neardup import op7_near
from .onebit import OP11_SQL, op11_one_bit
from .relative_lz import op5_relative_lz
from .sharding import op9_kd_tree
from .suffix_dedup import op10_suffix
from .topk import OP1_SQL, op1_topk
from .toxicity import op8_toxicity
from .transport import op3_transport_stream
from .whitening import op13_whitening

# The words of the contracts, for DuckDB.
_WORDS = r"regexp_extract_all({}, '[^ \t\n\x0B\f\r]+')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM p),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM r WHERE k > 1),
x AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN js IS NULL THEN array_to_string(w, ' ')
    ELSE coalesce((SELECT string_agg(w[t.j], ' ' ORDER BY t.j) FROM (SELECT unnest(range(1, len(w) + 1)) AS j) t
                   WHERE NOT list_contains(js, t.j)), '') END) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""

OP7_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), c AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a
), m AS (SELECT a AS doc_id, min(b) AS component_id FROM c GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, m.component_id = d.doc_id AS kept
FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_topk, op2_mix, op3_transport_stream, op4_bpe, op5_relative_lz, op6_main_text, op7_near, op8_toxicity, op9_kd_tree, op10_suffix, op11_one_bit, op12_annular, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1_SQL, "op5_relative_lz": OP5_SQL, "op7_near": OP7_SQL, "op11_one_bit": OP11_SQL, "op12_annular": OP12_SQL}
