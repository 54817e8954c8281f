"""The fit of the quality ranking against plain Newton steps, and what reaches the driver."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lanebeacon.llm import bpe, quality

SF_DIR = "/root/testdata/sf0.01"
# An even id that is not held out.
KEPT = 8


def plain_newton(differences, ridge):
    weights = np.zeros(differences.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(differences @ weights)))
        slope = differences.T @ (1 - p) / len(differences) - ridge * weights
        curve = differences.T @ np.diag(p * (1 - p)) @ differences / len(differences) + ridge * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


@pytest.mark.parametrize("at_once", [7, 100, 10_000])
def test_blocks_of_pairs_give_the_weights_of_all_pairs(at_once):
    chance = np.random.default_rng(1)
    features = chance.random((40, 6))
    better, worse = chance.integers(0, 20, 500), chance.integers(20, 40, 500)
    got = quality.fit_weights(better, worse, features, at_once=at_once)
    assert np.allclose(got, plain_newton(features[better] - features[worse], quality.RIDGE), atol=1e-5)


def caught(monkeypatch):
    seen = []
    plain = quality.fit_ranking
    monkeypatch.setattr(quality, "fit_ranking", lambda counts, good, copies, **more: seen.append((counts, good, copies)) or plain(counts, good, copies, **more))
    return seen


def test_an_id_on_many_rows_is_one_row_of_the_driver(spark, monkeypatch):
    seen = caught(monkeypatch)
    same = spark.range(30_000).selectExpr(f"cast({KEPT} as bigint) as doc_id", "'The same text again.' as text")
    others = spark.range(KEPT + 1, 400).selectExpr("id as doc_id", "if(id % 2 = 0, concat('Some sentence, number ', id, '. And more.'), concat('||| @@ ', id, ' ###')) as text")
    labels = spark.range(KEPT, 400).selectExpr("id as doc_id", "cast(id % 2 = 0 as int) as quality")
    quality.learn_quality(same.unionByName(others), labels)
    ((counts, good, copies),) = seen
    kept = labels.where(~quality.held_out(F.col("doc_id"))).count()
    assert len(counts) <= kept and copies.max() == 30_000 and copies.sum() == kept + 29_999


def test_rows_of_one_id_with_many_texts_are_bounded(spark, monkeypatch):
    seen = caught(monkeypatch)
    rows = spark.range(3000).selectExpr(f"cast({KEPT} as bigint) as doc_id", "repeat(concat('word ', id, ' '), cast(id % 50 as int) + 1) as text")
    assert rows.where(quality.held_out(F.col("doc_id"))).count() == 0
    labels = spark.createDataFrame([(KEPT, 1)], "doc_id bigint, quality int")
    quality.learn_quality(rows, labels, most=100)
    assert len(seen[0][0]) == 100


def test_texts_without_words_and_of_symbols_are_not_good(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    ranking = quality.learn_quality(docs, labels)
    empty, blank, symbols = ranking.scores(quality.text_counts(pa.array(["", " \n ", "!!! $$$ ### @@@"])))
    assert empty == blank < 0.5 and symbols < 0.5


def test_cut_is_a_quantile_of_all_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    ranking = quality.learn_quality(docs, labels, most=60)
    used = labels.where(~quality.held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    known = docs.join(used, "doc_id").select("text", "quality").collect()
    worths = np.sort(ranking.worths(quality.text_counts(pa.array([r["text"] for r in known]))))
    n_bad, around = sum(r["quality"] == 0 for r in known), max(1, len(known) // 100)
    exact = (worths[max(n_bad - around, 0)] + worths[min(n_bad + around - 1, len(worths) - 1)]) / 2
    assert len(known) > 200 and abs(ranking.cut - exact) <= 2 * ranking.furthest / quality.BINS


def test_one_worker_encodes_and_decodes(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for coded in (bpe.op2_byte_bpe(spark, SF_DIR), corpus_pipeline.encode(spark, docs, SF_DIR)):
        plan = coded._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [") == 1 and plan.count("code(text") == 1


def test_digests_of_long_id_lists(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    decoder = bpe.Decoder(ranks)
    ids = np.array([257, 0, 10, 256, 99] * 7, dtype=np.int32)
    whole = decoder.ids_digest(ids), decoder.bytes_digest(ids)
    monkeypatch.setattr(bpe, "SPELLED_IDS", 3)
    assert (decoder.ids_digest(ids), decoder.bytes_digest(ids)) == whole
    assert whole[0] == hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
    assert whole[1] == hashlib.sha256(b"abc\x00\nabc" * 7).hexdigest()
    with pytest.raises(KeyError):
        decoder.bytes_digest(np.array([300]))
