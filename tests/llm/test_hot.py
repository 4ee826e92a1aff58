"""One key, time or text that holds half of all rows: results stay whole, and no task gets them all."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from stagelight.llm import packing, url_filter


def test_packing_of_equal_pieces_without_ids(spark):
    rows = [(None, "the same short text")] * 1500 + [(i, "another text " * (i % 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = packing.packed(df, public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(list)
    for r in out.collect():
        got[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in got.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(map(len, got.values())) == 1800
    parts = packing.pieces(df, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)
    salts = Counter(r["s"] for r in parts.where("doc_id is null").withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(16))).collect())
    assert len(salts) == 16 and max(salts.values()) < 300


def test_captures_of_one_host_at_one_time(spark):
    at = datetime(2024, 3, 1, 12)
    captures = [(i, "http://hot.example.com/a/b", at) for i in range(2000)] + [(3000 + i, f"http://h{i}.example.com/", at + timedelta(minutes=i)) for i in range(200)]
    changes = [("hot.example.com", "add", datetime(2024, 1, 1)), ("h5.example.com", "add", at), ("hot.example.com/a/", "add", at), ("hot.example.com/a/", "remove", at + timedelta(seconds=1))]
    got = url_filter.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").repartition(5), spark.createDataFrame(changes, "pattern string, action string, at timestamp"))
    rows = {r["page_id"]: (r["blocked"], r["pattern"]) for r in got.collect()}
    assert len(rows) == 2200 and all(rows[i] == (1, "hot.example.com/a/") for i in range(2000)) and rows[3005] == (1, "h5.example.com") and sum(b for b, _ in rows.values()) == 2001
    points = spark.createDataFrame(captures, "page_id long, url string, at timestamp").select(F.explode(url_filter.patterns(F.col("url"))).alias("pattern"), "at").distinct()
    assert points.where("pattern like 'hot%'").count() == 2  # what a window gets, whatever number of captures there is


def test_no_changes_and_captures(spark):
    captures = spark.createDataFrame([(1, "http://a.example.com/x", datetime(2024, 1, 1)), (2, None, None)], "page_id long, url string, fetched_at timestamp")
    got = url_filter.evaluate(captures, spark.createDataFrame([], "pattern string, action string, at timestamp"))
    assert sorted((r["page_id"], r["blocked"], r["pattern"]) for r in got.collect()) == [(1, 0, None), (2, 0, None)]


def test_pipeline_keeps_one_of_very_many_rows_without_ids(spark, tmp_path):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(None, words, "en", "s", i) for i in range(1500)] + [(None, None, "en", "s", 0)] * 500 + [(7, words + " more", "en", "s", 1), (8, "quite another text of five words and more", "en", "s", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == [7, 8]  # an id comes before none
    assert sum(r["text"] is None for r in out) == 500 and len(out) == 502  # rows without words are linked with nothing
    assert "Window" not in corpus_pipeline.one_of_each_group(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
