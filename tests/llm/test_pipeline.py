"""The pipeline's stages on planted documents."""

from __future__ import annotations

import random

import corpus_pipeline
import pandas as pd
from logweir.llm.common import written

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rng = random.Random(1)
    text = max((r for r in rows if r[2] == "en"), key=lambda r: r[4] if r[4] < 4000 else 0)[1]
    near = text.split(" ")
    near[rng.randrange(len(near))] = "changed"
    rows += [(9001, " ".join(near), "en", "src1", 1), (9002, text, "en", "src1", 1), (9003, "12 34 !!", "en", "src1", 1), (9004, None, None, None, None)]
    rows += [(9005, f"{text} and more {' '.join(f'w{i}' for i in range(300))} mail some.one@corp.example.com", "en", None, 1)]
    at = spark.createDataFrame(rows, docs.schema)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        at = written(stage(spark, at, FOLDER), "stage")
        seen.append((name, at))
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for _, df in seen]
    assert 9003 not in ids[0] and 9004 not in ids[0] and {9001, 9002, 9005} <= ids[0]
    assert not {9001, 9002} & ids[1] and 9005 in ids[1]
    assert seen[1][1].count() == len(ids[1])
    assert all(df.columns == list(corpus_pipeline.COLUMNS) for _, df in seen[:4])
    hidden = seen[2][1].where("doc_id = 9005").first()
    assert "some.one@corp" not in hidden["text"] and hidden["n_chars"] == len(hidden["text"])
    assert ids[3] <= ids[2] and ids[4] == ids[3]


def test_run_gives_pieces(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 100


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    def sizes(batches):
        for b in batches:
            total = str(b["text"].str.len().sum())
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": b["text"], "lang": total, "source": None, "n_chars": 0})

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    monkeypatch.setattr(corpus_pipeline, "replace_pii", lambda docs: docs.mapInPandas(sizes, schema))
    docs = spark.range(200, numPartitions=1).selectExpr("id as doc_id", "repeat('a', 40000) as text", "'en' as lang", "'s' as source", "0L as n_chars")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    seen = [int(r["lang"]) for r in corpus_pipeline.personal_data(spark, docs, FOLDER).select("lang").collect()]
    assert len(seen) == 200 and max(seen) <= 1_200_000
