import os

from quire.plans import ml
from quire.operators.corpus import lemma_corpus
from quire.sources.tables import read_table
from quire.streaming.scoring import scoring_stream, start_scoring

from conftest import SF001


def test_stream_scores_equal_batch_scores(spark, tmpdir_path):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    lem = lemma_corpus(docs)
    model = ml.nb_pipeline(ml.fit_label_indexer(lem, "lang")).fit(lem)
    src = os.path.join(tmpdir_path, "incoming")
    docs.select("doc_id", "text").repartition(3).write.parquet(src)
    out = os.path.join(tmpdir_path, "scored")
    q = start_scoring(scoring_stream(spark, src, "doc_id long, text string", model), out,
                      name="test-" + os.path.basename(tmpdir_path), available_now=True)
    q.awaitTermination(300)
    streamed = {r.doc_id: r.predictedCategory for r in spark.read.parquet(out).collect()}
    batch = {r.doc_id: r.predictedCategory
             for r in ml.score(model, lemma_corpus(docs.drop("lang")), "doc_id").collect()}
    assert streamed == batch and len(batch) == 200
