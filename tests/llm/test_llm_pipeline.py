"""Every stage of the pipeline against a plain version of it, on a small table."""

import os
import zlib

import numpy as np
import pytest
from test_llm_pairs_and_files import distance_brute, groups_brute, plain_ids

import corpus_pipeline
from sievelake.llm import classifier, decontaminate, mixing
from sievelake.llm.storage import keep

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held.append(keep(stage(spark, held[-1], SF_DIR)))
        assert held[-1].columns == docs.columns
    tables = [[tuple(r) for r in d.collect()] for d in held]
    ids = [{r[0] for r in t} for t in tables]

    predicted = {r["doc_id"]: r["predicted"] for r in classifier.scored(docs, classifier.train(docs, labels)).collect()}
    assert ids[1] == {d for d, p in predicted.items() if p} and ids[1] < ids[0]

    assert ids[2] == {d for d, g in groups_brute(tables[1], 5, 80, 100).items() if d == g} and ids[2] < ids[1]

    gone = set()
    for d in tables[2]:
        whole = decontaminate.normal(d[1])
        for item in map(decontaminate.normal, benchmark):
            budget = int(len(item) * 0.05)
            pieces = [p for _, p in decontaminate.pieces(item, budget)]
            if any(p in whole for p in pieces) and distance_brute(item, whole) <= budget:
                gone.add(d[0])
    assert ids[3] == ids[2] - gone

    mixed = {r["doc_id"]: r["mix"] for r in mixing.mix(held[3]).select("doc_id", "mix").collect()}
    assert ids[4] == {d for d, m in mixed.items() if m["selected"]} and ids[4] < ids[3]

    out = corpus_pipeline.run(spark, SF_DIR).orderBy("start").collect()
    table = sorted(tables[4])
    at = 0
    for row, d, tokens in zip(out, table, plain_ids([d[1] for d in table]), strict=True):
        assert tuple(row) == (d[0], at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        at += len(tokens)


def test_contract():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
