import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.operators import labels
from quire.sinks import files as sinks
from quire.sources import files as sources


def test_merge_labels_handmade(spark):
    issuers = spark.createDataFrame(
        [("I1", "Old", "N", 1.0, 1.0, "CHF", 1), ("I1", 'Acme "Corp"', "Y", 100.0, 10.0, "EUR", 2),
         ("I3", "Solo", "N", 1.0, 1.0, "USD", 3)],
        "isin string, issuer_name string, zcp_fl string, min_trad_amt double, "
        "mlt_trad_amt double, ops_curr string, position int")
    guarantors = spark.createDataFrame([("I1", "Guard", 2), ("I1", "Former", 1)], "isin string, ga_name string, position int")
    rocs = spark.createDataFrame([("I1", "B"), ("I1", "A"), ("I1", "B"), ("I2", '"X"')],
                                 "isin string, roc string")
    docmap = spark.createDataFrame([("d2", "I1"), ("d1", "I1"), ("d9", "I2"), ("d3", "I3")],
                                   "docid string, isin string")
    texts = spark.createDataFrame([("d1", "first"), ("d2", "second"), ("d3", "x\ny")],
                                  "docid string, text string")
    rows = labels.merge_labels(issuers, guarantors, rocs, docmap, texts).collect()
    out = {r.ISIN: r for r in rows}
    assert len(rows) == 2                    # repeated keys make no further rows
    assert set(out) == {"I1", "I3"}          # I2 has no existing text
    a = out["I1"]
    assert (a.ISSUER_NAME, a.GA_NAME, a.ROC, a.TEXT) == ("Acme Corp", "Guard", "A|B", "first")
    assert (a.ZCP_FL, a.MIN_TRAD_AMT, a.OPS_CURR) == ("Y", 100.0, "EUR")
    b = out["I3"]
    assert (b.GA_NAME, b.ROC, b.TEXT) == ("", "", "x y")


def test_last_per_key_and_submission(spark):
    preds = spark.createDataFrame([("B", "x", 1), ("A", "y", 1), ("B", "z", 2)],
                                  "isin string, label string, pos int")
    sub = labels.submission(preds, order_col="pos").collect()
    assert [r.ISIN for r in sub] == ["A", "B"]
    assert sub[1]["ISSUER.NAME"] == "z"
    assert list(sub[0].asDict()) == labels.SUBMISSION_COLUMNS


def test_label_index_ties_alphabetic(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("",)], "l string")
    idx = {r.label: r.idx for r in labels.label_index(df, "l").collect()}
    assert idx == {"c": 0.0, "": 1.0, "a": 2.0, "b": 3.0}


def test_csv_roundtrip_doubled_quotes(spark, tmpdir_path):
    df = spark.createDataFrame([("I1", "lab", 'hello, "w"'), ("I2", "x", "multi\nline")],
                               "ISIN string, ISSUER_NAME string, TEXT string")
    p = os.path.join(tmpdir_path, "labeled")
    sinks.write_labeled_csv(df, p)
    schema = "ISIN string, ISSUER_NAME string, TEXT string"
    back = sources.read_csv_corpus(spark, p, schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    sinks.write_labeled_csv(df.withColumn("TEXT", F.replace("TEXT", F.lit("\n"), F.lit(" "))).withColumn("N", F.lit(1.5)), p)
    lab = sources.read_labeled_corpus(spark, "ISSUER_NAME", p, schema=schema + ", N double").collect()
    assert sorted(r.text for r in lab) == ["hello w ", "multi line"]
    un = sources.read_unlabeled_corpus(spark, p, schema=schema + ", N double").collect()
    assert sorted((r.isin, r.text) for r in un) == [("I1", "hello w "), ("I2", "multi line")]
    lines = sorted({r.value for r in spark.read.text(p).collect()})
    assert lines == ['"I1","lab","hello, ""w""",1.5', '"I2","x","multi line",1.5', '"ISIN","ISSUER_NAME","TEXT","N"']


def test_whole_text_and_lines(spark, tmpdir_path):
    for d in ("a", "b"):
        os.makedirs(os.path.join(tmpdir_path, d))
    open(os.path.join(tmpdir_path, "a", "doc1.txt"), "w").write("line one\nline two\n")
    open(os.path.join(tmpdir_path, "b", "doc2.txt"), "w").write("other")
    open(os.path.join(tmpdir_path, "b", "skip.pdf"), "w").write("binary")
    dirs = [os.path.join(tmpdir_path, d) for d in ("a", "b")]
    docs = {r.docid: r.text for r in sources.read_whole_texts(spark, dirs).collect()}
    assert docs == {"doc1": "line one\nline two\n", "doc2": "other"}
    lines = sources.read_text_lines(spark, os.path.join(tmpdir_path, "a")).count()
    assert lines == 2


def test_predictions_roundtrip_last_wins(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "run")
    df = spark.createDataFrame([("I1", "A"), ("I2", "B")], "ISIN string, predictedCategory string")
    sinks.write_predictions(df, p)
    raw = open([os.path.join(p, f) for f in os.listdir(p) if f.startswith("part")
                and os.path.getsize(os.path.join(p, f)) > 0][0]).read()
    assert '"I1","A"' in raw or '"I2","B"' in raw
    back = sources.read_predictions(spark, p)
    last = labels.last_per_key(back, "isin", "position", ["label"])
    assert {r.isin: r.label for r in last.collect()} == {"I1": "A", "I2": "B"}


def test_last_file_wins_whatever_the_sizes(spark, tmpdir_path):
    for name, n in (("part-00000", 5), ("part-00001", 50_000), ("part-00002", 3)):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.writelines(f'"I{i % 7}","{name}:{i}"\n' for i in range(n))
    back = sources.read_predictions(spark, tmpdir_path)
    got = {r.isin: r.label for r in labels.last_per_key(back, "isin", "position", ["label"]).collect()}
    assert [got[f"I{i}"] for i in range(3)] == [f"part-00002:{i}" for i in range(3)]
    assert got["I3"] == "part-00001:49997" and got["I6"] == "part-00001:49993"


def test_submission_file(spark, tmpdir_path):
    preds = spark.createDataFrame([("B", 'x "y"', 1), ("A", "y", 1), ("B", "z", 0)], "isin string, label string, pos int")
    file = os.path.join(tmpdir_path, sinks.submission_name("runs/one/"))
    assert file.endswith("/runs_one.csv")
    sinks.write_submission(labels.submission(preds, order_col="pos"), file)
    assert open(file).read().splitlines() == ['"ISIN","ISSUER.NAME","GA.NAME","OPS.CURR","ZCP.FL","ROC","MIN.TRAD.AMT","MLT.TRAD.AMT"',
                                              '"A","y",,,,,0,0', '"B","x ""y""",,,,,0,0']


def test_malformed_rows(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    open(p, "w").write("a,b,c\n1,x,y\n2,only\n3,p,q\n")
    schema = StructType.fromDDL("a int, b string, c string")
    for _ in range(2):
        bad = sources.malformed_rows(spark, p, schema)
        assert [r.line for r in bad.collect()] == ["2,only"] and bad.count() == 1
    assert schema.names == ["a", "b", "c"]


def test_parquet_and_sentences_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "One."), (1, "Two.")], "doc_id long, sentence string")
    sinks.write_parquet(df, os.path.join(tmpdir_path, "pq"))
    sinks.write_parquet(df, os.path.join(tmpdir_path, "pq"))   # overwrite
    assert spark.read.parquet(os.path.join(tmpdir_path, "pq")).count() == 2
    sinks.write_sentences(df, os.path.join(tmpdir_path, "txt"))
    assert sorted(r.value for r in spark.read.text(os.path.join(tmpdir_path, "txt")).collect()) == ["One.", "Two."]


def test_every_csv_file_has_a_header_whatever_the_session_says(spark, tmpdir_path):
    df = spark.range(0, 50, 1, 2).select(F.col("id").cast("string").alias("ISIN"), F.lit("t").alias("TEXT"))
    p = os.path.join(tmpdir_path, "capped")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        sinks.write_labeled_csv(df, p)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sources.read_csv_corpus(spark, p, "ISIN string, TEXT string").count() == 50


def test_submission_parts_are_ordered_and_all_or_nothing(spark, tmpdir_path):
    rows = spark.range(500).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("isin"), F.lit('x "y"').alias("label"))
    p = os.path.join(tmpdir_path, "parts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would be one part
    try:
        sinks.write_submission_parts(labels.submission(rows), p)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = sorted(n for n in os.listdir(p) if n.startswith("part"))
    lines = [line for n in names for line in open(os.path.join(p, n)).read().splitlines()]
    assert len(names) > 1 and lines[0].startswith('"ISIN","ISSUER.NAME"') and len(lines) == 501
    assert lines[1:] == [f'"{i:04d}","x ""y""",,,,,0,0' for i in range(500)]
    bad = labels.submission(rows).withColumn("ISSUER.NAME", F.when(F.col("ISIN") == "0444", F.raise_error(F.lit("no"))).otherwise(F.col("`ISSUER.NAME`")))
    q = os.path.join(tmpdir_path, "failed")
    try:
        sinks.write_submission_parts(bad, q)
    except Exception as e:  # noqa: BLE001
        assert "no" in str(e)
    else:
        raise AssertionError("must fail")
    assert not os.path.isdir(q) or not [n for n in os.listdir(q) if n.startswith("part") or n == "_SUCCESS"]
    sinks.write_submission_parts(labels.submission(rows.limit(0)), q)
    assert sources.read_text_lines(spark, q).count() == 1


def test_headers_of_files_of_one_name(spark, tmpdir_path):
    for d in ("a", "b"):
        os.makedirs(os.path.join(tmpdir_path, "h", d))
        open(os.path.join(tmpdir_path, "h", d, "x.csv"), "w").write(f"k,v\n1,{d}\n2\n")
    bad = sources.malformed_rows(spark, [os.path.join(tmpdir_path, "h", d) for d in ("a", "b")], "k int, v string").collect()
    assert [r.line for r in bad] == ["2", "2"]
