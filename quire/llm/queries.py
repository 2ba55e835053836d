"""The registered queries of this subpackage and their SQL twins (DuckDB)."""

from __future__ import annotations

import corpus_pipeline
from quire.llm.bpe import op6_byte_bpe
from quire.llm.fingerprints import op3_fingerprints
from quire.llm.language_id import op9_language_id
from quire.llm.line_dedup import op2_line_dedup
from quire.llm.mixing import op8_mixing
from quire.llm.near_dedup import op10_near_dedup
from quire.llm.spelling import op13_spelling_variants
from quire.llm.substring_dedup import op1_substring_dedup
from quire.llm.suffix_dedup import op5_suffix_dedup
from quire.llm.surrogates import op7_pii_surrogates
from quire.llm.topk_search import op4_topk_search
from quire.llm.toxicity import op11_toxicity
from quire.llm.whitening import op12_embedding_whitening

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_topk_search": op4_topk_search,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_near_dedup": op10_near_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 13], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 12, 0))) AS i FROM w)),
f AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
c AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM g JOIN f USING (s) WHERE m < doc_id),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM w),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
      FROM p ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id""",
    "op2_line_dedup": r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(0, len(string_split(text, chr(10))))) AS p FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS i FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, i, 3 AS c, 'w' || line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS s FROM n
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)
      UNION ALL SELECT doc_id, i, 1, 'l' || line FROM n WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50
      UNION ALL SELECT doc_id, 0, count(*), 't' || string_agg(line, chr(10) ORDER BY i) FROM n GROUP BY doc_id HAVING count(*) < 3),
r AS (SELECT doc_id, i, c, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w WHERE s IS NOT NULL),
c AS (SELECT DISTINCT doc_id, i + unnest(range(0, c)) AS i FROM r WHERE k > 1),
g AS (SELECT n.doc_id, n.p FROM n JOIN c USING (doc_id, i)),
m AS (SELECT n.doc_id, n.i, lag(n.i) OVER (PARTITION BY n.doc_id ORDER BY n.i) AS z FROM n JOIN c USING (doc_id, i)),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS t FROM l ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM n WHERE n.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM g WHERE g.doc_id = d.doc_id) AS n_removed,
       (SELECT count(*) FROM m WHERE m.doc_id = d.doc_id AND (z IS NULL OR m.i > z + 1)) AS n_runs,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents AS d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op4_topk_search": """
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbour_id,
             list_sum(list_transform(range(1, 65), lambda i:
                 CASE WHEN (coalesce(q.embedding[i], 0) > 0) <> (coalesce(v.embedding[i], 0) > 0) THEN 1 ELSE 0 END)) AS distance
      FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d)
SELECT query_id, rank, neighbour_id, distance::BIGINT AS distance FROM r WHERE rank <= 10""",
    "op5_suffix_dedup": r"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n
           FROM documents),
g AS (SELECT doc_id, i, substr(hx, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, hx, unnest(range(0, greatest(n - 49, 0))) AS i FROM h)),
f AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
r AS (SELECT doc_id, i FROM g JOIN f USING (s) WHERE m < doc_id),
o AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS new FROM r
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
u AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
a AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM u GROUP BY doc_id, run),
q AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS z FROM a),
k AS (SELECT doc_id, count(*) AS spans, sum(e - b) AS removed, max(e) AS last,
             string_agg(substr(hx, 2 * z + 1, 2 * (b - z)), '' ORDER BY b) AS t
      FROM q JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(t, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN k ON k.doc_id = h.doc_id""",
    "op13_spelling_variants": r"""
WITH t AS (SELECT list_reduce(list_prepend(k, range(0, 8)), lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS v, k
           FROM (SELECT unnest(range(0, 256)) AS k)),
x AS (SELECT list(v ORDER BY k) AS tab FROM t),
e AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c FROM e
      WHERE length(run) >= 7 GROUP BY ALL),
b AS (SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx FROM r),
h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(hx) // 2),
          lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT)),
          lambda s, y: xor(s >> 8, tab[(xor(s, y) & 255) + 1])), 4294967295::BIGINT) AS h FROM b, x),
w AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) ||
          substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM h) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS s FROM (SELECT *, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word, z.word AS near, z.n AS near_n FROM d AS a JOIN d AS z ON a.i = z.i AND a.s = z.s AND a.word <> z.word
      UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.s = w.word
      UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.s = w.word),
q AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM p GROUP BY word),
g AS (SELECT p.word, min(near) AS form, max(near_n) AS form_n FROM p JOIN q ON p.word = q.word AND near_n = top GROUP BY p.word),
f AS (SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
             CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM w LEFT JOIN q USING (word) LEFT JOIN g USING (word))
SELECT f.word, f.n, f.n_near, f.form, f.form_n, coalesce(f4.form, f3.form, f2.form, f1.form, f.form, f.word) AS root
FROM f LEFT JOIN f AS f1 ON f1.word = f.form LEFT JOIN f AS f2 ON f2.word = f1.form
LEFT JOIN f AS f3 ON f3.word = f2.form LEFT JOIN f AS f4 ON f4.word = f3.form""",
}
