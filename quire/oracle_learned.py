"""DuckDB twins of the queries in ``plans.learned_queries``."""

from __future__ import annotations

from quire.functions import lemma as L
from quire.operators import sentence_model as S
from quire.operators import suffix_rules as X
from quire.operators.forest import CELLS, MIN_GAIN, POISSON, VOTE
from quire.operators.vectors import MIN_COUNT, WINDOW_SIZE
from quire.oracle import ascii_text, bucket, clean_text, lemma_of, lemma_tokens, lemmas, r6, train_flag, ws_tokens
from quire.plans.learned_queries import BINS, DEPTH, DICTIONARY_COUNT, LANGUAGE_BUCKETS, TREES


def forest(rows: str, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, seed: int = 1234) -> str:
    """``rows`` gives (vec_id, label, embedding). Bins, bootstrap, ``depth`` levels of splits and votes, a level three CTEs. Scores are summed over
    all bins on either side of each split, not along the bins."""
    weight = " + ".join(f"(u >= {b})::INT" for b in POISSON)
    levels = []
    for d in range(depth):
        levels.append(f"""
s{d} AS (SELECT t, node, f FROM (SELECT t, node, f, row_number() OVER (PARTITION BY t, node ORDER BY md5('{seed}:' || t || ':' || node || ':' || f)) AS r
       FROM (SELECT DISTINCT t, node FROM n{d}), st) WHERE r <= (SELECT ceil(sqrt(count(*))) FROM st)),
g{d} AS (SELECT n.t, n.node, s.f, b.bin, n.k, sum(n.w) AS w FROM n{d} AS n JOIN s{d} AS s ON s.t = n.t AND s.node = n.node
       JOIN b ON b.vec_id = n.vec_id AND b.f = s.f GROUP BY ALL),
q{d} AS (SELECT a.t, a.node, a.f, a.bin, g.k, sum(CASE WHEN g.bin <= a.bin THEN g.w ELSE 0 END)::BIGINT AS l, sum(CASE WHEN g.bin > a.bin THEN g.w ELSE 0 END)::BIGINT AS r
       FROM (SELECT DISTINCT t, node, f, bin FROM g{d}) AS a JOIN g{d} AS g ON g.t = a.t AND g.node = a.node AND g.f = a.f GROUP BY ALL),
z{d} AS (SELECT t, node, f, bin, sum(l * l)::DOUBLE / sum(l)::DOUBLE + sum(r * r)::DOUBLE / sum(r)::DOUBLE AS score,
              sum((l + r) * (l + r))::DOUBLE / sum(l + r)::DOUBLE AS own FROM q{d} GROUP BY ALL HAVING sum(r) > 0),
d{d} AS (SELECT t, node, f, bin FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY score DESC, f, bin) AS i FROM z{d} WHERE score > own + {MIN_GAIN}) WHERE i = 1),
n{d + 1} AS (SELECT n.vec_id, n.t, n.k, n.w, 2 * n.node + (b.bin > d.bin)::INT AS node FROM n{d} AS n JOIN d{d} AS d ON d.t = n.t AND d.node = n.node
       JOIN b ON b.vec_id = n.vec_id AND b.f = d.f),
r{d + 1} AS (SELECT r.vec_id, r.t, CASE WHEN d.t IS NULL THEN r.node ELSE 2 * r.node + (b.bin > d.bin)::INT END AS node
       FROM r{d} AS r LEFT JOIN d{d} AS d ON d.t = r.t AND d.node = r.node LEFT JOIN b ON b.vec_id = r.vec_id AND b.f = d.f)""")
    return f"""
WITH v AS (SELECT vec_id, {train_flag('vec_id')} AS is_train, coalesce(label::VARCHAR, '') AS label, embedding FROM ({rows})),
cls AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS k FROM v WHERE is_train GROUP BY label),
x AS (SELECT vec_id, is_train, unnest(range(0, len(embedding))) AS f, unnest(embedding)::DOUBLE AS x FROM v),
st AS (SELECT f, min(x) AS lo, max(x) AS hi, count(*) AS n FROM x WHERE is_train GROUP BY f),
c AS (SELECT vec_id, is_train, f, CASE WHEN hi > lo THEN least({CELLS - 1}, floor((least(hi, greatest(lo, x)) - lo) * {CELLS} / (hi - lo)))::INT ELSE 0 END AS cell
      FROM x JOIN st USING (f)),
h AS (SELECT f, cell, sum(count(*)) OVER (PARTITION BY f ORDER BY cell) - count(*) AS before FROM c WHERE is_train GROUP BY f, cell),
e AS (SELECT f, min(cell) AS cell FROM (SELECT h.f, cell, (before * {bins} // n)::INT AS q FROM h JOIN st USING (f)) WHERE q > 0 GROUP BY f, q),
b AS (SELECT c.vec_id, c.f, count(e.cell) AS bin FROM c LEFT JOIN e ON e.f = c.f AND e.cell <= c.cell GROUP BY ALL),
p AS (SELECT vec_id, k, t, ('0x' || substr(md5('{seed}:' || t || ':' || vec_id), 1, 4))::INT AS u
      FROM v JOIN cls USING (label), (SELECT unnest(range(0, {trees})) AS t) WHERE is_train),
w AS (SELECT vec_id, k, t, {weight} AS w FROM p),
n0 AS (SELECT vec_id, t, k, w, 1 AS node FROM w WHERE w > 0),
r0 AS (SELECT vec_id, t, 1 AS node FROM v, (SELECT unnest(range(0, {trees})) AS t)),{",".join(levels)},
lf AS (SELECT r.t, r.node, w.k, sum(w.w)::BIGINT AS w FROM r{depth} AS r JOIN w ON w.vec_id = r.vec_id AND w.t = r.t WHERE w.w > 0 GROUP BY ALL),
sh AS (SELECT t, node, k, w * {VOTE} // sum(w) OVER (PARTITION BY t, node) AS vote FROM lf),
vt AS (SELECT r.vec_id, k, sum(vote)::BIGINT AS vote FROM r{depth} AS r JOIN sh ON sh.t = r.t AND sh.node = r.node GROUP BY ALL),
top AS (SELECT vec_id, k, vote, row_number() OVER (PARTITION BY vec_id ORDER BY vote DESC, k) AS i FROM vt)
SELECT v.vec_id, v.label, cls.label AS predicted, {r6(f'top.vote / {trees * VOTE}.0')} AS share
FROM v JOIN top ON top.vec_id = v.vec_id AND i = 1 JOIN cls ON cls.k = top.k WHERE NOT is_train"""


def pairs() -> str:
    """Tokens of the vocabulary joined with those that follow them closely; both directions."""
    return f"""
t0 AS (SELECT doc_id, unnest(t) AS word, unnest(range(0, len(t))) AS p FROM (SELECT doc_id, coalesce({ws_tokens(clean_text('text'))}, []) AS t FROM documents)),
voc AS (SELECT word FROM t0 GROUP BY word HAVING count(*) >= {MIN_COUNT}),
t1 AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM t0 JOIN voc USING (word)),
h AS (SELECT a.word AS a, b.word AS b, count(*) AS n FROM t1 AS a JOIN t1 AS b ON a.doc_id = b.doc_id AND b.i > a.i AND b.i <= a.i + {WINDOW_SIZE} GROUP BY ALL),
pairs AS (SELECT word, context, sum(n)::BIGINT AS n FROM (SELECT a AS word, b AS context, n FROM h UNION ALL SELECT b, a, n FROM h) GROUP BY ALL)"""


def stem(x: str) -> str:
    return f"regexp_replace({x}, '[\\\"''\\)\\]]+$', '')"


def core(x: str) -> str:
    return f"regexp_replace(lower({stem(x)}), '^[^a-z0-9]+', '')"


def kind(x: str) -> str:
    base = f"regexp_replace({core(x)}, '[^a-z0-9]+$', '')"
    return f"CASE WHEN regexp_matches({base}, '^[0-9][0-9.,]*$') THEN '{S.NUMBER}' ELSE {base} END"


def dunning(c1: str, c2: str, c12: str, n: str) -> str:
    def xlny(x, y):
        return f"(CASE WHEN ({x}) = 0 THEN 0.0 ELSE ({x}) * ln({y}) END)"

    def side(k, m, p):
        return f"{xlny(k, p)} + {xlny(f'({m}) - ({k})', f'1 - ({p})')}"

    p, p1, p2 = f"{c2} / {n}", f"{c12} / {c1}", f"(CASE WHEN {n} > {c1} THEN ({c2} - {c12}) / ({n} - {c1}) ELSE 0.0 END)"
    rest = (f"{c2} - {c12}", f"{n} - {c1}")
    return f"-2 * ({side(c12, c1, p)} + {side(*rest, p)} - ({side(c12, c1, p1)}) - ({side(*rest, p2)}))"


def sentence_ctes() -> str:
    flat = ascii_text("text", strip_quotes=False)
    inner = "(length(kind) - length(replace(kind, '.', '')))"
    letters = f"(length(kind) - {inner})::DOUBLE"
    likelihood = f"-2 * (n_dot * ln(p) + n_plain * ln(1 - p) - n_dot * ln({S.SURE}::DOUBLE) - n_plain * ln(1 - {S.SURE}::DOUBLE))"
    return f"""
t AS (SELECT doc_id, unnest(t) AS a, unnest(range(0, len(t))) AS i FROM (SELECT doc_id, list_filter(string_split({flat}, ' '), lambda s: s <> '') AS t FROM documents)),
u AS (SELECT *, lead(a) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM t),
k AS (SELECT doc_id, i, a, b, {kind('a')} AS kind, suffix({core('a')}, '.') AS dotted, right({stem('a')}, 1) AS mark, {kind('b')} AS next_kind FROM u),
cnt AS (SELECT kind, count(*) FILTER (dotted) AS n_dot, count(*) FILTER (NOT dotted) AS n_plain FROM k WHERE kind <> '' GROUP BY kind),
tot AS (SELECT sum(n_dot)::DOUBLE / sum(n_dot + n_plain) AS p, sum(n_dot + n_plain)::DOUBLE AS n FROM cnt),
sc AS (SELECT kind, n_dot, n_plain, {likelihood} * exp(-{letters}) * ({inner} + 1) * pow({letters}, -n_plain) AS score
       FROM cnt, tot WHERE n_dot > 0 AND regexp_matches(kind, '^[a-z][a-z.]*$') AND p > 0 AND p < 1),
ab AS (SELECT kind FROM sc WHERE score >= {S.ABBREVIATION_SCORE}),
nb AS (SELECT x.kind FROM (SELECT kind, count(*)::DOUBLE AS c12 FROM k WHERE dotted AND next_kind = '{S.NUMBER}' GROUP BY kind) AS x
       JOIN (SELECT kind, n_dot::DOUBLE AS c1 FROM cnt WHERE regexp_matches(kind, '^[a-z][a-z.]*$')) AS y USING (kind),
            (SELECT sum(n_dot + n_plain)::DOUBLE AS c2 FROM cnt WHERE kind = '{S.NUMBER}'), tot
       WHERE {dunning('c1', 'c2', 'c12', 'n')} >= {S.COLLOCATION_SCORE} AND c12 * n > c1 * c2),
en AS (SELECT next_kind FROM k WHERE next_kind <> '' AND (mark IN ('!', '?') OR (dotted AND length(kind) > 1 AND kind <> '{S.NUMBER}'
       AND kind NOT IN (SELECT kind FROM ab)))),
st AS (SELECT kind FROM (SELECT next_kind AS kind, count(*)::DOUBLE AS c12 FROM en GROUP BY ALL) JOIN
            (SELECT kind, (n_dot + n_plain)::DOUBLE AS c2 FROM cnt WHERE regexp_matches(kind, '^[a-z][a-z.]*$')) USING (kind),
            (SELECT count(*)::DOUBLE AS c1 FROM en), tot
       WHERE {dunning('c1', 'c2', 'c12', 'n')} >= {S.STARTER_SCORE} AND c12 * n > c1 * c2)"""


def learned_sentences() -> str:
    return f"""
WITH {sentence_ctes().strip()},
e AS (SELECT doc_id, i, a, CASE WHEN b IS NULL OR mark IN ('!', '?') THEN 1
             WHEN mark <> '.' OR regexp_matches(b, '^[^A-Za-z0-9]*[a-z]') THEN 0
             WHEN next_kind = '{S.NUMBER}' AND kind IN (SELECT kind FROM nb) THEN 0
             WHEN (regexp_matches(kind, '^[a-z]$') OR kind IN (SELECT kind FROM ab)) AND next_kind NOT IN (SELECT kind FROM st) THEN 0
             ELSE 1 END AS ends FROM k),
s AS (SELECT doc_id, i, a, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS sent_no FROM e)
SELECT doc_id, sent_no, string_agg(a, ' ' ORDER BY i) AS sentence FROM s GROUP BY ALL"""


def dictionary() -> str:
    toks = lemma_tokens(ascii_text("text"))
    return (f"(SELECT form, {lemma_of('form')} AS lemma FROM (SELECT lower(unnest(coalesce({toks}, []))) AS form FROM documents) "
            f"GROUP BY form HAVING count(*) >= {DICTIONARY_COUNT} AND regexp_full_match(form, '[a-z]{{4,}}'))")


def rules(pairs: str) -> str:
    """Every split of a pair is tried; the longest common prefix gives the rule."""
    return f"""
pr AS (SELECT form, min(lemma) AS lemma FROM {pairs} GROUP BY form),
pf AS (SELECT form, lemma, (SELECT max(i) FROM (SELECT unnest(range(0, least(length(form), length(lemma)) + 1)) AS i) WHERE substr(form, 1, i) = substr(lemma, 1, i)) AS p FROM pr),
cu AS (SELECT form, length(form) - p AS cut, substr(lemma, p + 1) AS added FROM pf),
vo AS (SELECT substr(form, length(form) - k + 1, k) AS suffix, CASE WHEN k >= cut THEN cut END AS cut, CASE WHEN k >= cut THEN added END AS added
       FROM (SELECT *, unnest(range(0, least(length(form), {X.MAX_SUFFIX}) + 1)) AS k FROM cu)),
co AS (SELECT suffix, cut, added, count(*) AS n, sum(count(*)) OVER (PARTITION BY suffix)::BIGINT AS total FROM vo GROUP BY suffix, cut, added),
ru AS (SELECT suffix, cut::INTEGER AS cut, added, n AS support, total
       FROM (SELECT *, row_number() OVER (PARTITION BY suffix ORDER BY n DESC, cut, added) AS r FROM co WHERE cut IS NOT NULL)
       WHERE r = 1 AND n >= {X.MIN_SUPPORT} AND 100 * n >= {X.MIN_PERCENT} * total)"""


def lemmatize_rules() -> str:
    toks = lemma_tokens(ascii_text("text"))
    return f"""
WITH {rules(f"(SELECT * FROM {dictionary()} WHERE {train_flag('form')})").strip()},
tk AS (SELECT doc_id, lower(unnest(t)) AS form, unnest(range(0, len(t))) AS p FROM (SELECT doc_id, coalesce({toks}, []) AS t FROM documents)),
fm AS (SELECT DISTINCT form FROM tk),
fk AS (SELECT form, unnest(range(0, least(length(form), {X.MAX_SUFFIX}) + 1)) AS k FROM fm),
lo AS (SELECT form, arg_max(cut, k) AS cut, arg_max(added, k) AS added FROM fk JOIN ru ON ru.suffix = substr(form, length(form) - k + 1, k) GROUP BY form),
lm AS (SELECT form, coalesce(nullif(substr(form, 1, length(form) - cut) || added, ''), form) AS lemma FROM fm LEFT JOIN lo USING (form)),
dl AS (SELECT doc_id, p, lemma FROM tk JOIN lm USING (form) WHERE length(lemma) >= {L.MIN_LEMMA_LENGTH} AND regexp_full_match(lemma, '\\p{{L}}+'))
SELECT d.doc_id, count(lemma)::INTEGER AS n_lemmas, coalesce(string_agg(lemma, ' ' ORDER BY p), '') AS lemmas
FROM documents AS d LEFT JOIN dl ON dl.doc_id = d.doc_id GROUP BY d.doc_id"""


def oracle_sql() -> dict[str, str]:
    counts = f"""
SELECT d.doc_id AS vec_id, any_value(lang) AS label, list(coalesce(c, 0)::DOUBLE ORDER BY b) AS embedding
FROM documents AS d JOIN (SELECT unnest(range(0, {LANGUAGE_BUCKETS})) AS b) ON true
LEFT JOIN (SELECT doc_id, {bucket('term', LANGUAGE_BUCKETS)} AS b, count(*) AS c
           FROM (SELECT doc_id, unnest({lemmas(ascii_text('text'))}) AS term FROM documents) GROUP BY ALL) AS x USING (doc_id, b)
GROUP BY d.doc_id"""
    suffix = "[a-z]*"
    worker = f"list_transform(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+'), lambda w: CASE WHEN length(w) > 3 AND regexp_full_match(w, '{suffix}[^s]s') THEN left(w, -1) ELSE w END)"
    return {
        "forest_predict": forest("SELECT vec_id, label, embedding FROM embeddings"),
        "forest_language": f"SELECT vec_id AS doc_id, label, predicted, share FROM ({forest(counts)})",
        "cooccurrence": f"WITH {pairs().strip()} SELECT * FROM pairs",
        "pmi": f"WITH {pairs().strip()}, m AS (SELECT word, sum(n) AS m FROM pairs GROUP BY word) "
               f"SELECT p.word, p.context, p.n, {r6('ln(p.n) + ln((SELECT sum(n) FROM pairs)) - ln(a.m) - ln(b.m)')} AS pmi "
               "FROM pairs AS p JOIN m AS a ON a.word = p.word JOIN m AS b ON b.word = p.context",
        "abbreviations": f"WITH {sentence_ctes().strip()} SELECT kind, n_dot, n_plain, {r6('score')} AS score FROM sc",
        "sentence_lists": f"WITH {sentence_ctes().strip()} SELECT 'abbreviation' AS list, kind FROM ab UNION ALL SELECT 'before_number', kind FROM nb "
                          "UNION ALL SELECT 'starter', kind FROM st",
        "learned_sentences": learned_sentences(),
        "suffix_rules": f"WITH {rules(dictionary()).strip()} SELECT * FROM ru",
        "lemmatize_rules": lemmatize_rules(),
        "row_numbers": "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS row_number FROM lineitem",
        "label_index_large": "SELECT label, n, (row_number() OVER (ORDER BY n DESC, label) - 1)::DOUBLE AS idx "
                             "FROM (SELECT o_custkey::VARCHAR AS label, count(*) AS n FROM orders GROUP BY 1)",
        "worker_lemmas": f"SELECT doc_id, array_to_string({worker}, ' ') AS lemmas FROM documents",
    }
