import hashlib

import pytest
import sentencepiece

import corpus_pipeline as P
from binscope.llm import quality
from binscope.llm.queries import tokenizer_path

from . import test_decontaminate, test_neardup, test_secrets
from .cases import CLASH, awkward, awkward_rows, by_row

SMALL = "/root/testdata/sf0.001"


def test_run_matches_a_brute_force_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score_quality(docs, model, keep=["doc_id"]).collect() if r["_quality"]["kept"]}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good)
    rows = [r for r, c in zip(rows, test_neardup.brute(rows)) if r[0] == dict(test_neardup.brute(rows))[r[0]] and c is not None]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [r for r in rows if not test_decontaminate.brute(r[1], items)[1]]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = []
    for i, t in rows:
        spans = test_secrets.base(t)
        out, at = "", 0
        for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in spans.split(",") if x):
            if s >= at:
                out += t[at:s] + "[SECRET]"
            at = max(at, e)
        ids = sp.encode(out + t[at:])
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert by_row(P.run(spark, SMALL).collect()) == by_row(want)
    assert len(want) > 50


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_each_stage_takes_awkward_rows_and_empty_tables(spark, k):
    name, stage = P.STAGES[k]
    docs = awkward(spark)
    got = stage(spark, docs, SMALL)
    if k < len(P.STAGES) - 1:
        assert got.columns == docs.columns
        assert {r["doc_id"] for r in got.collect()} <= {i for i, _ in awkward_rows()}
    assert got.count() <= len(awkward_rows())
    assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert len(CLASH) == len(docs.columns) - 3
