"""DuckDB twins of the registered queries (the correctness oracle).

These strings are only run by the checker against the same parquet tables; they
restate each query's semantics in plain SQL, sharing the fixed values of the
Spark side (rules, stop list, constants) so both sides read one source of truth.
Where a natural SQL form differs from the Spark plan (e.g. Naive Bayes scores
as base + overlap instead of a dense model), that difference is deliberate: it
makes the oracle an independent formulation.
"""

from __future__ import annotations

from quire.functions import lemma as L
from quire.functions import text as T
from quire.functions.features import NUM_FEATURES, SPLIT_SEED, TRAIN_PREFIX
from quire.functions.stopwords import default_stop_words
from quire.operators.labels import SUBMISSION_COLUMNS
from quire.operators.vectors import VECTOR_SIZE
from quire.plans.queries import DICTIONARY, OCR_QUERY_RATIO

WS = r"[\t\n\x0B\f\r ]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ascii_text(x: str, strip_quotes: bool = True) -> str:
    s = f"regexp_replace({x}, '\\p{{Han}}', ' ', 'g')"
    s = f"regexp_replace({s}, '[^\\x00-\\x7F]', ' ', 'g')"
    if strip_quotes:
        s = f"replace({s}, '\"', ' ')"
    s = f"(CASE WHEN regexp_full_match({s}, '{WS}*') THEN '.' ELSE {s} END)"
    s = f"regexp_replace({s}, '\\n+', ' ', 'g')"
    return f"regexp_replace({s}, '{WS}+', ' ', 'g')"


def clean_text(x: str) -> str:
    return f"regexp_replace({x}, '\\W+', ' ', 'g')"


def ws_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda s: length(s) > 0)"


def lemma_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(L.TOKEN_SPLIT)}), lambda s: length(s) > 0)"


def suffix_rule(w: str) -> str:
    parts = []
    for suffix, blocked, min_len, cut, add in L.SUFFIX_RULES:
        cond = f"suffix({w}, {q(suffix)}) AND length({w}) >= {min_len}"
        for b in blocked:
            cond += f" AND NOT suffix({w}, {q(b)})"
        parts.append(f"WHEN {cond} THEN substr({w}, 1, length({w}) - {cut}) || {q(add)}")
    return "(CASE " + " ".join(parts) + f" ELSE {w} END)"


def lemma_of(tok: str, pairs=L.IRREGULAR_FORMS) -> str:
    w = f"lower({tok})"
    irregular = " ".join(f"WHEN {q(f)} THEN {q(l)}" for f, l in pairs)
    return f"(CASE {w} {irregular} ELSE {suffix_rule(w)} END)"


def lemmas(x: str, pairs=L.IRREGULAR_FORMS) -> str:
    mapped = f"list_transform(coalesce({lemma_tokens(x)}, []), lambda t: {lemma_of('t', pairs)})"
    return (f"list_filter({mapped}, lambda x: length(x) >= {L.MIN_LEMMA_LENGTH} "
            f"AND regexp_full_match(x, '\\p{{L}}+'))")


def stop_list() -> str:
    return "(" + ", ".join(q(w) for w in default_stop_words()) + ")"


def remove_stop_words(arr: str) -> str:
    return f"list_filter({arr}, lambda s: lower(s) NOT IN {stop_list()})"


def bigrams(arr: str) -> str:
    return (f"(CASE WHEN len({arr}) >= 2 THEN list_transform(range(1, len({arr})), "
            f"lambda i: {arr}[i] || ' ' || {arr}[i + 1]) ELSE [] END)")


def bucket(term: str, n: int = NUM_FEATURES) -> str:
    return f"((('0x' || substr(md5({term}), 1, 8))::BIGINT) % {n})::INTEGER"


def train_flag(key: str) -> str:
    return f"(substr(md5('{SPLIT_SEED}:' || CAST({key} AS VARCHAR)), 1, 4) < '{TRAIN_PREFIX}')"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def ocr_ratio(x: str) -> str:
    octets = f"strlen({x})"
    word = f"length(regexp_replace({x}, '[^A-Za-z0-9_]', '', 'g'))"
    newlines = f"(length({x}) - length(replace({x}, chr(10), '')))"
    denom = f"({octets} - {newlines})"
    return f"(CASE WHEN {denom} > 0 THEN ({octets} - {word}) / {denom} END)"


# ---------------------------------------------------------------------------
# Naive Bayes flow as CTEs
# ---------------------------------------------------------------------------

def nb_ctes(label: str = "lang", n: int = NUM_FEATURES, lam: float = 1.0, score: str = "NOT is_train") -> str:
    """The flow; ``score`` says which documents are predicted."""
    words = remove_stop_words(lemmas(ascii_text("text")))
    return f"""
idx AS (
  SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx
  FROM (SELECT coalesce(CAST({label} AS VARCHAR), '') AS label, count(*) AS n FROM documents GROUP BY 1)),
docs AS (
  SELECT d.doc_id, coalesce(CAST(d.{label} AS VARCHAR), '') AS label, i.idx AS label_idx,
         {train_flag('d.doc_id')} AS is_train, d.text
  FROM documents d LEFT JOIN idx i ON coalesce(CAST(d.{label} AS VARCHAR), '') = i.label),
feats AS (SELECT doc_id, label_idx, is_train, {bigrams('ws')} AS ngrams
          FROM (SELECT doc_id, label_idx, is_train, {words} AS ws FROM docs)),
tf AS (
  SELECT doc_id, label_idx, is_train, {bucket('term', n)} AS bucket, count(*) AS tf
  FROM (SELECT doc_id, label_idx, is_train, unnest(ngrams) AS term FROM feats)
  GROUP BY ALL),
m AS (SELECT count(*) AS m FROM docs WHERE is_train),
idf AS (SELECT bucket, count(*) AS df, ln(((SELECT m FROM m) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tf WHERE is_train GROUP BY bucket),
w AS (SELECT tf.doc_id, tf.label_idx, tf.is_train, tf.bucket, tf.tf,
             tf.tf * coalesce(idf.idf, ln((SELECT m FROM m) + 1.0)) AS w
      FROM tf LEFT JOIN idf USING (bucket)),
counts AS (SELECT label_idx, count(*) AS n_docs FROM docs WHERE is_train GROUP BY 1),
s_cb AS (SELECT label_idx, bucket, sum(w) AS s_cb FROM w WHERE is_train GROUP BY ALL),
s_c AS (SELECT label_idx, sum(s_cb) AS s_c FROM s_cb GROUP BY 1),
priors AS (
  SELECT c.label_idx, c.n_docs,
         ln(c.n_docs + {lam}) - ln((SELECT sum(n_docs) FROM counts) + (SELECT count(*) FROM counts) * {lam}) AS pi,
         ln({lam}) - ln(coalesce(s_c.s_c, 0) + {n} * {lam}) AS theta0
  FROM counts c LEFT JOIN s_c USING (label_idx)),
theta AS (SELECT s_cb.label_idx, s_cb.bucket, s_cb.s_cb,
                 ln(s_cb.s_cb + {lam}) - ln(s_c.s_c + {n} * {lam}) AS theta
          FROM s_cb JOIN s_c USING (label_idx)),
test AS (SELECT doc_id, label FROM docs WHERE {score}),
sumx AS (SELECT doc_id, sum(w) AS sx FROM w WHERE {score} GROUP BY 1),
base AS (SELECT t.doc_id, p.label_idx AS cls, p.pi + p.theta0 * coalesce(s.sx, 0) AS base
         FROM test t CROSS JOIN priors p LEFT JOIN sumx s ON s.doc_id = t.doc_id),
overlap AS (SELECT w.doc_id, th.label_idx AS cls, sum(w.w * (th.theta - p.theta0)) AS ov
            FROM w JOIN theta th ON th.bucket = w.bucket
                   JOIN priors p ON p.label_idx = th.label_idx
            WHERE {score} GROUP BY ALL),
scores AS (SELECT b.doc_id, b.cls, b.base + coalesce(o.ov, 0) AS score
           FROM base b LEFT JOIN overlap o ON o.doc_id = b.doc_id AND o.cls = b.cls),
best AS (SELECT doc_id, cls FROM (
           SELECT doc_id, cls, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS r
           FROM scores) WHERE r = 1),
pred AS (SELECT t.doc_id, t.label, i.label AS predicted
         FROM test t JOIN best b USING (doc_id) JOIN idx i ON i.idx = b.cls),
cm AS (SELECT label, predicted, count(*) AS n FROM pred GROUP BY ALL),
roles AS (SELECT label AS cls, n AS support, 0 AS predicted, CASE WHEN label = predicted THEN n ELSE 0 END AS tp FROM cm
          UNION ALL
          SELECT predicted AS cls, 0, n, 0 FROM cm),
cls AS (SELECT cls, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM roles GROUP BY cls),
cls_m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
                    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM cls),
cls_f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                         ELSE 0.0 END AS f1 FROM cls_m)
"""


# ---------------------------------------------------------------------------
# One SQL string per registered query
# ---------------------------------------------------------------------------

def _arr_str(a: str, sep: str = " ") -> str:
    return f"array_to_string({a}, {q(sep)})"


def oracle_sql() -> dict[str, str]:
    at = ascii_text("text")
    lem = lemmas(at)
    words = remove_stop_words(lem)
    grams = bigrams("ws")
    toks = ws_tokens(clean_text("text"))
    nb = "WITH " + nb_ctes().strip() + "\n"
    sent_src = ascii_text("text", strip_quotes=False)
    bigram_docs = (f"(SELECT doc_id, {grams} AS ngrams FROM "
                   f"(SELECT doc_id, {words} AS ws FROM documents))")
    term_tf = (f"(SELECT doc_id, term, count(*) AS tf FROM "
               f"(SELECT doc_id, unnest(ngrams) AS term FROM {bigram_docs}) GROUP BY ALL)")
    sql = {
        "clean_text": f"SELECT doc_id, {clean_text('text')} AS text FROM documents",
        "ascii_text": f"SELECT doc_id, {at} AS text FROM documents",
        "labeled_corpus": f"SELECT CAST(lang AS VARCHAR) AS category, {clean_text('text')} AS text FROM documents",
        "unlabeled_corpus": f"SELECT CAST(doc_id AS VARCHAR) AS isin, {clean_text('text')} AS text FROM documents",
        "ocr_quality": (f"SELECT doc_id, {r6(ocr_ratio('text'))} AS ratio, "
                        f"coalesce({ocr_ratio('text')} > {T.OCR_BAD_RATIO}, true) AS is_bad FROM documents"),
        "bad_ocr": f"SELECT doc_id FROM documents WHERE coalesce({ocr_ratio('text')} > {OCR_QUERY_RATIO}, true)",
        "sentences": (
            "SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, trim(sentence) AS sentence FROM ("
            " SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_no, unnest(s) AS sentence FROM ("
            f"  SELECT doc_id, string_split(regexp_replace({sent_src}, '([.!?]) ', '\\1' || chr(10), 'g'), chr(10)) AS s"
            "  FROM documents)) WHERE length(trim(sentence)) > 0"),
        "tokens": (f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, {_arr_str('t')} AS tokens "
                   f"FROM (SELECT doc_id, coalesce({toks}, []) AS t FROM documents)"),
        "lemma_tokens": (f"SELECT doc_id, CAST(len(l) AS INTEGER) AS n_lemmas, {_arr_str('l')} AS lemmas "
                         f"FROM (SELECT doc_id, {lem} AS l FROM documents)"),
        "lemma_corpus": (f"SELECT doc_id, text, lang, source, n_chars, {_arr_str(lem)} AS LEMMAS FROM documents"),
        "stopwords_removed": (f"SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_words, {_arr_str('ws')} AS words "
                              f"FROM (SELECT doc_id, {words} AS ws FROM documents)"),
        "bigrams": (f"SELECT doc_id, CAST(len(g) AS INTEGER) AS n_bigrams, {_arr_str('g', '|')} AS bigrams "
                    f"FROM (SELECT doc_id, {grams} AS g FROM (SELECT doc_id, {words} AS ws FROM documents))"),
        "corpus_stats": ("SELECT count(*) AS n_docs, count(text) AS n_texts, "
                         "CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents"),
        "hashed_tf": (f"SELECT doc_id, {bucket('term')} AS bucket, count(*) AS tf FROM "
                      f"(SELECT doc_id, unnest(ngrams) AS term FROM {bigram_docs}) GROUP BY ALL"),
        "idf": (f"SELECT term, count(*) AS df, "
                f"round(ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)), 6) AS idf "
                f"FROM {term_tf} GROUP BY term"),
        "tfidf": (f"WITH tf AS {term_tf}, "
                  "idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf "
                  "FROM tf GROUP BY term) "
                  "SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * idf.idf, 6) AS tfidf "
                  "FROM tf JOIN idf USING (term)"),
        "hash_split": f"SELECT doc_id, {train_flag('doc_id')} AS is_train FROM documents",
        "label_index": ("SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx "
                        "FROM (SELECT CAST(lang AS VARCHAR) AS label, count(*) AS n FROM documents GROUP BY 1)"),
        "index_to_label": ("WITH idx AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx "
                           "FROM (SELECT source AS label, count(*) AS n FROM documents GROUP BY 1)) "
                           "SELECT d.doc_id, i.idx AS source_idx, i2.label AS source_back FROM documents d "
                           "LEFT JOIN idx i ON i.label = d.source LEFT JOIN idx i2 ON i2.idx = i.idx"),
        "nb_priors": nb + "SELECT label_idx, n_docs, round(pi, 6) AS pi, round(theta0, 6) AS theta0 FROM priors",
        "nb_theta": nb + "SELECT label_idx, bucket, round(s_cb, 6) AS s_cb, round(theta, 6) AS theta FROM theta",
        "nb_predict": nb + "SELECT doc_id, label, predicted FROM pred",
        "confusion_matrix": nb + "SELECT label, predicted AS prediction, n FROM cm",
        "weighted_f1": nb + ("SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1, "
                             "round(sum(tp) / sum(support), 6) AS accuracy, "
                             "round(sum(precision * support) / sum(support), 6) AS weighted_precision, "
                             "round(sum(recall * support) / sum(support), 6) AS weighted_recall, "
                             "CAST(sum(support) AS BIGINT) AS n FROM cls_f"),
        "preview_top5": nb + "SELECT doc_id, label, predicted FROM pred ORDER BY doc_id LIMIT 5",
        "merge_labels": _merge_labels_sql(at),
        "entities_with_text": ("SELECT DISTINCT c_custkey AS isin FROM customer "
                               "WHERE CAST(c_custkey AS VARCHAR) IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)"),
        "last_per_key": ("SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, "
                         "arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey"),
        "submission": ("SELECT CAST(conv_id AS VARCHAR) AS ISIN, arg_max(role, turn) AS \"ISSUER.NAME\", "
                       "'' AS \"GA.NAME\", '' AS \"OPS.CURR\", '' AS \"ZCP.FL\", '' AS \"ROC\", "
                       "0 AS \"MIN.TRAD.AMT\", 0 AS \"MLT.TRAD.AMT\" FROM conversations GROUP BY conv_id ORDER BY 1"),
        "w2v_vocab": (f"SELECT word, count(*) AS n FROM (SELECT unnest(coalesce({toks}, [])) AS word FROM documents) "
                      "GROUP BY word HAVING count(*) >= 30"),
        "mean_vector": _mean_vector_sql(toks),
    }
    own = lemmas(at, L.one_lemma_per_form(DICTIONARY))
    sql["lemmatize_dict"] = (f"SELECT doc_id, CAST(len(l) AS INTEGER) AS n_lemmas, {_arr_str('l')} AS lemmas "
                             f"FROM (SELECT doc_id, {own} AS l FROM documents)")
    sql["lemmatize_join"] = sql["lemmatize_dict"]
    sql["src_csv_corpus"] = sql["merge_labels"]
    sql["sink_parquet"] = sql["lemma_corpus"]
    sql["sink_sentences"] = f"SELECT sentence FROM ({sql['sentences']})"
    last = ("SELECT CAST(conv_id AS VARCHAR) AS isin, CASE WHEN conv_id % 10 = 0 THEN 'corrected' ELSE arg_max(role, turn) END AS label "
            "FROM conversations GROUP BY conv_id")
    sql["sink_predictions"] = ("SELECT isin AS ISIN, label AS \"ISSUER.NAME\", '' AS \"GA.NAME\", '' AS \"OPS.CURR\", '' AS \"ZCP.FL\", "
                               f"'' AS \"ROC\", 0 AS \"MIN.TRAD.AMT\", 0 AS \"MLT.TRAD.AMT\" FROM ({last})")
    header = ",".join(f'"{c}"' for c in SUBMISSION_COLUMNS)
    sql["sink_submission"] = (f"SELECT {q(header)} AS value UNION ALL "
                              f"SELECT '\"' || isin || '\",\"' || label || '\",,,,,0,0' FROM ({last})")
    sql["submission_parts"] = (f"SELECT 1::BIGINT AS place, {q(header)} AS value UNION ALL "
                               f"SELECT row_number() OVER (ORDER BY isin) + 1, '\"' || isin || '\",\"' || label || '\",,,,,0,0' FROM ({last})")
    merged = sql["src_csv_corpus"]
    line = "||','||".join(f"coalesce(CAST({c} AS VARCHAR), '')" if c in ("MIN_TRAD_AMT", "MLT_TRAD_AMT") else f"'\"' || replace({c}, '\"', '\"\"') || '\"'"
                          for c in ("ISIN", "ISSUER_NAME", "ZCP_FL", "MIN_TRAD_AMT", "MLT_TRAD_AMT", "OPS_CURR", "GA_NAME", "ROC", "TEXT"))
    sql["sink_labeled_csv"] = f"SELECT {line} AS value FROM ({merged})"
    sql["src_labeled_corpus"] = f"SELECT OPS_CURR AS category, {clean_text('TEXT')} AS text FROM ({merged})"
    sql["src_unlabeled_corpus"] = f"SELECT CAST(doc_id AS VARCHAR) AS isin, {clean_text(at)} AS text FROM documents"
    sql["src_label_csv"] = merged
    sql["src_text_lines"] = f"SELECT {at} AS value FROM documents"
    sql["src_whole_text"] = sql["src_text_lines"]
    sql["malformed_rows"] = ("SELECT CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey AS VARCHAR) "
                             "WHEN o_orderkey % 11 = 0 THEN o_orderkey || ',' || o_orderstatus || ',more' "
                             "ELSE 'x' || o_orderkey || ',' || o_orderstatus END AS line FROM orders "
                             "WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0")
    sql["ml_nb_predict"] = nb + "SELECT doc_id, label AS lang, predicted AS \"predictedCategory\" FROM pred"
    every = "WITH " + nb_ctes(score="true").strip() + "\n"
    sql["score_saved_pipeline"] = every + "SELECT doc_id AS \"ISIN\", predicted AS \"predictedCategory\" FROM pred"
    sql["ml_random_split"] = sql["hash_split"]
    sql["ml_hashed_tf"] = (f"WITH b AS (SELECT doc_id, list_transform(ngrams, lambda t: {bucket('t')}) AS b FROM {bigram_docs}) "
                           "SELECT doc_id, CAST(len(list_distinct(b)) AS BIGINT) AS nnz, CAST(len(b) AS DOUBLE) AS total_tf FROM b")
    vocab = (f"SELECT word FROM (SELECT unnest(coalesce({ws_tokens(clean_text('sentence'))}, [])) AS word "
             f"FROM (SELECT DISTINCT sentence FROM ({sql['sentences']}))) GROUP BY word HAVING count(*) >= 30")
    sql["w2v_vectors_check"] = (f"SELECT word, CAST({VECTOR_SIZE} AS BIGINT) AS size, true AS finite FROM ({vocab})")
    sql["w2v_doc_vectors_check"] = f"SELECT doc_id, CAST({VECTOR_SIZE} AS BIGINT) AS size, true AS finite FROM documents"
    sql["w2v_rf_check"] = (f"SELECT doc_id, true AS known_class, true AS sums_to_one FROM documents WHERE NOT {train_flag('doc_id')}")
    sql["distinct_sentences"] = f"SELECT DISTINCT sentence FROM ({sql['sentences']})"
    union = "(SELECT text FROM documents UNION ALL SELECT text FROM conversations)"
    sql["all_text_sentences"] = (
        "SELECT DISTINCT trim(sentence) AS sentence FROM ("
        " SELECT unnest(string_split(regexp_replace("
        f"{sent_src}, '([.!?]) ', '\\1' || chr(10), 'g'), chr(10))) AS sentence FROM {union})"
        " WHERE length(trim(sentence)) > 0")
    return sql


def _merge_labels_sql(at: str) -> str:
    return f"""
WITH iss AS (SELECT isin, arg_max(issuer_name, p) AS issuer_name, arg_max(zcp_fl, p) AS zcp_fl, arg_max(min_trad_amt, p) AS min_trad_amt,
                    arg_max(mlt_trad_amt, p) AS mlt_trad_amt, arg_max(ops_curr, p) AS ops_curr
             FROM (SELECT CAST(c_custkey AS VARCHAR) AS isin, replace(c_name, '"', '') AS issuer_name, 'N' AS zcp_fl,
                          CAST(c_acctbal AS DOUBLE) AS min_trad_amt, CAST(c_nationkey AS DOUBLE) AS mlt_trad_amt, c_mktsegment AS ops_curr, 0 AS p FROM customer
                   UNION ALL
                   SELECT CAST(s_suppkey AS VARCHAR), replace(s_name, '"', ''), 'N', CAST(s_acctbal AS DOUBLE), CAST(s_nationkey AS DOUBLE), 'SUPPLIER', 1 FROM supplier)
             GROUP BY isin),
ga AS (SELECT CAST(doc_id AS VARCHAR) AS isin, CASE WHEN max(toxic) = 1 THEN 'TOXIC' ELSE 'Q' || CAST(max(quality) AS VARCHAR) END AS ga_name
       FROM labels GROUP BY doc_id),
roc AS (SELECT CAST(o_custkey AS VARCHAR) AS isin,
               array_to_string(list_sort(list_distinct(list(replace(o_orderpriority, '"', '')))), '|') AS roc
        FROM orders GROUP BY 1),
dm AS (SELECT CAST(c_custkey AS VARCHAR) AS docid, CAST(c_custkey AS VARCHAR) AS isin FROM customer),
tx AS (SELECT CAST(doc_id AS VARCHAR) AS docid, text FROM documents),
first_doc AS (SELECT isin, min(docid) AS docid FROM dm WHERE docid IN (SELECT docid FROM tx) GROUP BY isin)
SELECT f.isin AS ISIN, coalesce(iss.issuer_name, '') AS ISSUER_NAME, coalesce(iss.zcp_fl, '') AS ZCP_FL,
       iss.min_trad_amt AS MIN_TRAD_AMT, iss.mlt_trad_amt AS MLT_TRAD_AMT,
       coalesce(iss.ops_curr, '') AS OPS_CURR, coalesce(ga.ga_name, '') AS GA_NAME,
       coalesce(roc.roc, '') AS ROC, {at.replace('text', 'tx.text')} AS TEXT
FROM first_doc f JOIN tx ON tx.docid = f.docid
LEFT JOIN iss ON iss.isin = f.isin LEFT JOIN ga ON ga.isin = f.isin LEFT JOIN roc ON roc.isin = f.isin
"""


def _mean_vector_sql(toks: str) -> str:
    return f"""
WITH t AS (SELECT doc_id, coalesce({toks}, []) AS tokens FROM documents),
vocab AS (SELECT word FROM (SELECT unnest(tokens) AS word FROM t) GROUP BY word HAVING count(*) >= 30),
wv AS (SELECT v.word, e.embedding AS vector FROM vocab v JOIN embeddings e
       ON e.vec_id = ((('0x' || substr(md5(v.word), 1, 8))::BIGINT) % (SELECT count(*) FROM embeddings))),
counts AS (SELECT doc_id, word, count(*) AS c FROM (SELECT doc_id, unnest(tokens) AS word FROM t) GROUP BY ALL),
ex AS (SELECT c.doc_id, c.c, generate_subscripts(w.vector, 1) - 1 AS dim, unnest(w.vector) AS v
       FROM counts c JOIN wv w USING (word)),
sums AS (SELECT doc_id, dim, sum(c * CAST(v AS DOUBLE)) AS s FROM ex GROUP BY doc_id, dim),
dims AS (SELECT unnest(range(0, (SELECT max(len(embedding)) FROM embeddings))) AS dim)
SELECT t.doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(dims.dim AS INTEGER) AS dim,
       CASE WHEN len(tokens) > 0 THEN round(coalesce(s, 0.0) / len(tokens), 6) ELSE 0.0 END AS value
FROM t CROSS JOIN dims LEFT JOIN sums ON sums.doc_id = t.doc_id AND sums.dim = dims.dim
"""
