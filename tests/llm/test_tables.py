"""Shared helpers."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from snaptrack.llm import tables
from snaptrack.llm.tables import first_ids, ranked


def test_first_ids_are_the_first(spark):
    docs = spark.range(5000).withColumnRenamed("id", "doc_id")
    plain = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(50).collect()
    assert first_ids(docs, 50).collect() == plain
    assert first_ids(docs.limit(3), 50).count() == 3
    same = docs.select(F.lit(7).cast("long").alias("doc_id"))
    assert first_ids(same, 50).count() == 50


def test_ranks_are_gapless(spark):
    rows = spark.range(2000).selectExpr("id", "id % 3 as g", "id % 5 + 1 as w")
    found = ranked(ranked(rows, "r", ["g"], ["id"]), "at", [], ["id"], weight="w").collect()
    for g in range(3):
        ranks = sorted(row["r"] for row in found if row["g"] == g)
        assert ranks == list(range(len(ranks)))
    end = 0
    for row in sorted(found, key=lambda row: row["at"]):
        assert row["at"] == end
        end += row["w"]


def test_stored_frames_leave_no_shuffle_files(spark, tmp_path):
    folder = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir")
    root = (folder or tempfile.gettempdir()).split(",")[0]

    def files():
        return set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True))

    rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").agg(F.sum("id").alias("s"))
    before = files()
    rows.write.parquet(f"{tmp_path}/plain")
    plain = files()
    assert plain - before
    kept = tables.stored(rows, "kept")
    assert not files() - plain
    assert sorted(kept.collect()) == sorted(rows.collect())
    assert spark.conf.get(tables.FREED) == "false"
