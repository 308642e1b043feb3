"""Pipeline stages on odd, repeated and clashing rows, and on an empty table."""

import random
import resource

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from billshift.llm import jaccard_join, language_id, mixing, places
from billshift.sources.writers import materialise


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns_of_odd_rows(spark, sf_dir, odd, none, name, stage):
    rows = stage(spark, odd, sf_dir)
    assert set(odd.columns) - {"text"} <= set(rows.columns)
    kept = rows.collect()
    assert 0 < len(kept) <= 40 and all(r["target"] == "x" and r["lang_pred"] == "x" for r in kept)
    assert stage(spark, none, sf_dir).count() == 0


def test_whole_pipeline_on_odd_rows(spark, sf_dir, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "odd-stage")
    assert docs.where("score <> 'x' or lang_pred <> 'x'").isEmpty()
    assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in odd.collect()}


def test_language_stage_keeps_columns_of_its_own_names(spark):
    rows = [(i, "the house and the garden " * 3, "en", "text", "mine") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, _score string")
    kept = language_id.keep_identified(docs, language_id.fit(docs))
    assert kept.columns == docs.columns and {(r["score"], r["_score"]) for r in kept.collect()} == {("text", "mine")}


def test_mix_keeps_columns_of_its_helpers_names(spark):
    names = ("_text_hash", "_id", "_source", "_hash", "_times", "_copy")
    docs = spark.createDataFrame([(i, f"a b c {i}", "s") for i in range(9)], "doc_id long, text string, source string")
    docs = docs.withColumns({n: F.lit("kept") for n in names})
    rows = mixing.mixed_documents(docs).collect()
    assert len(rows) == 9 and all(r[n] == "kept" for r in rows for n in names)


def test_near_copies_with_repeated_ids(spark):
    words = [f"w{i}" for i in range(200)]
    near = lambda i: " ".join([*words[:100], f"x{i}", *words[101:]])
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(5, near(1)), (5, near(2)), (5, other), (None, near(3)), (7, near(4)), (9, None), (9, "short one"), (9, "short one")]
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, _place string").coalesce(1)
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(5, near(1)), (5, other), (9, None), (9, "short one")], key=str)


def test_places_are_unique_and_stay(spark):
    docs = materialise(spark.range(1000).repartition(7), "placed")
    a, b = ({r["id"]: r["n"] for r in places.with_places(docs, "n").collect()} for _ in range(2))
    assert a == b and len(set(a.values())) == 1000 and max(a.values()) == 999
    assert places.with_places(spark.range(5).withColumn("x", F.lit(1)), "_file").count() == 5


def plain_scores(texts, langs, logp, prior):
    out = []
    for t in texts:
        chars = np.array([ord(c) for c in t], np.uint64)
        total, rolled = prior.copy(), np.zeros(len(chars), np.uint64)
        for n in (1, 2, 3):
            shifted = np.concatenate([chars[n - 1 :], np.zeros(min(n - 1, len(chars)), np.uint64)])
            rolled = language_id.mix(rolled * np.uint64(0x100000001B3) + shifted + np.uint64(n))
            for h in rolled[: max(0, len(chars) - n + 1)]:
                total = total + logp[int(h % np.uint64(language_id.BUCKETS))]
        out.append(total)
    return np.array(out)


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1 << 18])
def test_scores_do_not_depend_on_the_pieces(monkeypatch, size):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé漢\U0001f600 x") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["", "é" * 50]
    logp = np.random.default_rng(3).normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    prior = np.log(np.array([0.5, 0.3, 0.2]))
    want = plain_scores(texts, "abc", logp, prior)
    monkeypatch.setattr(language_id, "PIECE_BYTES", size)
    named, sure = language_id.score_texts(pa.array(texts), list("abc"), logp, prior)
    lettered = [any(c.isalpha() for c in t) for t in texts]
    assert named == ["abc"[b] if ok else "und" for b, ok in zip(want.argmax(axis=1), lettered)]
    posterior = 1 / np.exp(want - want.max(axis=1, keepdims=True)).sum(axis=1)
    assert np.allclose(sure, np.where(lettered, posterior, 0))


def test_a_long_text_takes_little_more_memory():
    text = pa.array(["the cat é " * (64 << 20 >> 3)])
    logp, prior = np.zeros((language_id.BUCKETS, 4), np.float32), np.zeros(4)
    language_id.score_texts(pa.array(["warm up"]), list("abcd"), logp, prior)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    language_id.score_texts(text, list("abcd"), logp, prior)
    assert text.nbytes > 64 << 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 << 10
