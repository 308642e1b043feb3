"""Exact dedup, mixing, language ID, sharding."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from compare import normalised, spark_rows, sql_rows
from pyspark.sql import functions as F

from billshift.llm import exact_dedup, language_id, mixing, sharding
from billshift.llm.queries_rows import ORACLE, QUERIES
from billshift.sources.writers import scratch_path


def test_exact_dedup_agrees_with_sql(spark, sf_dir):
    got = spark_rows(QUERIES["op6_exact_dedup"](spark, sf_dir))
    assert got == normalised(*sql_rows(sf_dir, ORACLE["op6_exact_dedup"]))


def test_exact_dedup_of_odd_rows(odd):
    rows = exact_dedup.exact_duplicates(odd).collect()
    assert len(rows) == 14
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text_sha256"], []).append(r)
    empty = by_text[hashlib.sha256(b"").hexdigest()]
    assert {r["doc_id"] for r in empty} == {1, 2} and {r["keep_id"] for r in empty} == {2}
    copies = [r for r in rows if r["doc_id"] in (3, 4)]
    assert {(r["keep_id"], r["group_size"]) for r in copies} == {(4, 3)} and sum(r["kept"] for r in copies) == 1
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True]


def test_colliding_digests_do_not_merge_texts(odd):
    weak = exact_dedup.exact_duplicates(odd, digest=lambda t: (F.length(t) % 3).cast("string"))
    strong = exact_dedup.exact_duplicates(odd)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert spark_rows(weak.select(*columns)) == spark_rows(strong.select(*columns))


def test_exact_state_lasts_across_increments(spark):
    root = scratch_path(spark, "increments")
    for ids in ((1, 2), (3,)):
        frame = spark.createDataFrame([("d", i, "f", i) for i in ids], exact_dedup.ARRIVAL)
        frame.write.mode("append").parquet(f"{root}/arrivals")
        exact_dedup.deduplicate_stream(spark, f"{root}/arrivals", f"{root}/checkpoint", f"{root}/states")
    last = exact_dedup.latest_states(spark, f"{root}/states").collect()
    assert [(r["keeper"]["doc_id"], r["n"]) for r in last] == [(3, 3)]


def test_empty_tables(spark, none):
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert language_id.identify(none, language_id.fit_corpus(none)).count() == 0
    assert sharding.shard(none).count() == 0


def test_exact_dedup_runs_no_python(odd, capsys):
    exact_dedup.drop_duplicates(odd).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mix_meets_targets(spark, sf_dir):
    rows = QUERIES["op7_source_mixing"](spark, sf_dir).collect()
    again = QUERIES["op7_source_mixing"](spark, sf_dir).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    taken, target, total = Counter(), {}, Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        total[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"] if r["size"] else r["taken"] == 0
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total))}
    want, open_ = {}, set(total)
    while True:  # share, cap, share the excess again
        left = sum(total.values()) - sum(want.values())
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * total[s]}
        if not over:
            want |= {s: level * weights[s] for s in open_}
            break
        want |= {s: 3.0 * total[s] for s in over}
        open_ -= over
    for s in total:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 100)


def test_mix_of_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert sum(r["n"] for r in rows) == 14
    assert {r["source"] for r in rows} == {"a", None, "b", "", "c"}
    assert all(r["times"] <= 3 for r in rows)
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(1, 900, 300), np.ones(300)]).astype(float)
    p = np.full(300, 0.37)
    q = mixing.flight(p, x, spare=0)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    assert q @ x == pytest.approx(p @ x)


def test_language_id_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language_id"](spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 30
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_of_odd_rows(odd):
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd, language_id.fit_corpus(odd)).collect()}
    assert [found[i] for i in (1, 2, 6, 7)] == ["und"] * 4 and found[11] == "en"


def test_hilbert_curve_is_a_path():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    index = sharding.hilbert_index(cells, 3)
    assert sorted(index) == list(range(512))
    walk = cells[np.argsort(index)]
    assert (abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, sf_dir, odd):
    rows = QUERIES["op10_hilbert_shards"](spark, sf_dir).collect()
    slots, bytes_ = {}, Counter()
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        bytes_[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(bytes_.values()) / 24
    assert all(abs(b - share) <= 2 * max(r["size"] for r in rows) for b in bytes_.values())
    few = sharding.shard(odd).collect()
    assert len(few) == 14 and len({(r["shard"], r["slot"]) for r in few}) == 14
    assert {r["size"] for r in few if r["doc_id"] in (1, 2)} == {8}
