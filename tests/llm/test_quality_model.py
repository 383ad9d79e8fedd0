"""The quality classifier: held-out accuracy and awkward rows."""

import os
import zlib

import numpy as np

from pyspark.sql import functions as F

from snaptrack.llm import quality_model
from tests.llm.cases import documents
from tests.llm.test_packing import ODD

SF_DIR = os.environ.get("LLM_MODEL_SF_DIR", "/root/testdata/sf0.01")
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = quality_model.op2(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
    tried = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in tried]) > 0.9


def test_held_out_labels_are_never_read(spark):
    docs = documents(spark, [f"{'good' if i % 2 else 'bad ###'} text {i}" for i in range(200)])
    kept = [(i, i % 2, 0) for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    others = [(i, 1 - i % 2, 0) for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    runs = [
        sorted(map(tuple, quality_model.scored(docs, spark.createDataFrame(rows, LABELS)).collect()))
        for rows in (kept, kept + others)
    ]
    assert runs[0] == runs[1]
    assert all(row[3] == row[0] % 2 for row in runs[0])


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 7, 0)], LABELS)
    rows = quality_model.scored(documents(spark, ODD), labels).collect()
    assert len(rows) == len(ODD) and {row["score"] for row in rows} == {0.5}
    none = spark.createDataFrame([], LABELS)
    assert quality_model.scored(documents(spark, []), none).collect() == []
    clashing = documents(spark, ["a", "a"]).selectExpr("cast(null as long) doc_id", "text", "1 as y", "2 as score")
    assert quality_model.scored(clashing, none).count() == 2


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, quality_model.POOLED))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality_model.fitted(x[:2000], y[:2000])
    scores = net.scores(x[2000:])
    raw = net._replace(temperature=1.0)
    calibrated = quality_model.loss(net.logits(x[2000:]) / net.temperature, y[2000:])
    assert calibrated <= quality_model.loss(raw.logits(x[2000:]), y[2000:]) + 1e-9
    assert abs(scores.mean() - y[2000:].mean()) < 0.08


def test_a_repeated_id_gives_one_row(spark):
    ids = [i for i in range(40) if spark.range(i, i + 1).select(~quality_model.held_out(F.col("id"))).first()[0]][:4]
    rows = [(ids[0], f"text {n}") for n in range(50)] + [(i, f"own {i}") for i in ids[1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    found = [row["text"] for row in quality_model.learnt(docs, labels, sample=4).collect()]
    assert len(found) == 4 and sum(text.startswith("text ") for text in found) == 1
