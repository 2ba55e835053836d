"""Each stage of the pipeline against a plain version of it, on what its predecessor kept."""

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from collections import Counter

import corpus_pipeline
from quire.llm.bpe import read_ranks
from quire.llm.common import documents, written

SF001 = "/root/testdata/sf0.001"
ODD = [(10_001, None, "en", "src0", 0), (10_002, "12 34 !?", "en", None, 8), (10_003, "", None, "src1", 0),
       (None, "the and of that with this", "en", "src2", 25), (10_004, "The the and of that with this", "en", "src2", 29)]


@pytest.fixture(scope="module")
def steps(spark):
    docs = documents(spark, SF001)
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF001), f"test-{name}"))
    return [[r.asDict() for r in df.collect()] for df in out]


def test_stages_are_in_order_and_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "byte_bpe"]
    for rows in steps[:-1]:
        assert rows and set(rows[0]) == {"doc_id", "text", "lang", "source", "n_chars"}


def test_language_stage_drops_only_what_has_no_language(steps):
    kept = {r["doc_id"] for r in steps[1]}
    assert {r["doc_id"] for r in steps[0]} - kept == {10_001, 10_002, 10_003}
    assert all(r in steps[0] for r in steps[1])


def test_line_stage(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1]]
    want = {d: (n, gone, sha) for d, n, gone, _, sha in brute.lines(rows)}
    got = {r["doc_id"]: r for r in steps[2]}
    for d, (n, gone, sha) in want.items():
        assert (d in got) == (n == 0 or gone < n)
        if d in got:
            assert brute.sha(got[d]["text"]) == sha and got[d]["n_chars"] == len(got[d]["text"])


def test_near_stage(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[2] if r["doc_id"] is not None]
    want = {d for d, _, _, kept in brute.near(rows, 5, 80) if kept} | {None}
    assert Counter(r["doc_id"] for r in steps[3]) == Counter(dict.fromkeys(want, 1))
    assert all(r in steps[2] for r in steps[3])


def test_mixing_stage(steps):
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"])) for r in steps[3]}
    per, taken = Counter(), Counter()
    for r in steps[3]:
        per[r["source"]] += size[r["doc_id"]]
    for r in steps[4]:
        taken[r["source"]] += size[r["doc_id"]]
    for s, want in brute.targets(per).items():
        assert abs(taken[s] - want) <= max(size.values())
    assert max(Counter(r["doc_id"] for r in steps[4]).values()) <= 2
    assert all(r in steps[3] for r in steps[4])


def test_token_stage(steps):
    ranks = read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in steps[4]:
        ids = enc.encode_ordinary(r["text"])
        want[(r["doc_id"], len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(r["text"]))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in steps[5]) == want


def test_run_agrees_with_itself_and_takes_an_empty_table(spark, tmp_path):
    rows = [sorted(map(str, corpus_pipeline.run(spark, SF001).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
    documents(spark, SF001).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
