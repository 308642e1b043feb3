"""Jaccard join, passages, components, and the pipeline."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from billshift.llm import jaccard_join, substring_dedup
from billshift.llm.components import components
from billshift.llm.queries_pairs import QUERIES


def brute_components(texts, make):
    sets = {i: make(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * len(x) <= 5 * len(y) and 4 * len(y) <= 5 * len(x):
                if 100 * len(x & y) >= 80 * len(x | y):
                    low, high = sorted((find(a), find(b)))
                    label[high] = low
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def sets_of(text):
    import re

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_join_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want, sizes = brute_components(texts, sets_of)
    got = QUERIES["op1_jaccard_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes


def test_jaccard_join_of_edited_copies_in_blocks(spark, monkeypatch):
    """Many copies with edits, near the threshold, in groups of several blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = np.random.default_rng(5)
    rows = []
    for base in range(3):
        words = [f"b{base}w{i}" for i in range(60 + 90 * base)]
        for i in range(40):
            copy = list(words)
            for place in rng.choice(len(copy), rng.integers(0, len(copy) // 20 + 2), replace=False):
                copy[place] = f"e{base}x{i}x{place}"
            rows.append((1000 * base + i, " ".join(copy)))
    rows += [(9000 + n, " ".join(f"s{n}w{i}" for i in range(n))) for n in range(12)]
    rows += [(9100 + n, " ".join(f"s{n}w{i}" for i in range(n + (n > 8)))) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_components(dict(rows), sets_of)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == want and len(set(want.values())) > 20


def test_jaccard_join_of_odd_rows(odd, none):
    rows = jaccard_join.jaccard_components(odd).collect()
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert len(rows) == 14
    assert [found[i] for i in (3, 4, 5)] == [3, 3, 3] and found[8] == found[9] == 8
    assert [found[i] for i in (1, 2, 6)] == [1, 2, 6] and found[None] is None
    assert jaccard_join.jaccard_components(none).count() == 0
    assert jaccard_join.one_of_each(odd).where("doc_id in (4, 5, 9)").count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 230)]
    rows = components(spark.createDataFrame(path + star, "a long, b long")).collect()
    assert {r["id"]: r["label"] for r in rows} == {**{i: 100 for i in range(100, 141)}, 7: 7, **{i: 7 for i in range(200, 230)}}


def test_every_repeated_passage_is_found(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    import re

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t.translate(fold)) for i, t in texts.items()}
    holders = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 51):
            holders[tuple(w[k : k + 52])].add(i)
    found = {r["doc_id"]: r for r in QUERIES["op3_substring_dedup"](spark, sf_dir).collect()}
    missed = total = 0
    for i, w in words.items():
        covered = np.zeros(len(w), bool)
        for span in filter(None, found[i]["spans"].split(",")):
            a, b = map(int, span.split(":"))
            assert b - a >= 50 and b <= len(w)
            covered[a:b] = True
        for k in range(len(w) - 51):
            if len(holders[tuple(w[k : k + 52])]) > 1:
                total += 1
                missed += not covered[k + 1 : k + 51].all()
    assert total > 100 and missed <= 0.005 * total


def test_passages_in_other_surroundings(spark, odd, none):
    shared = " ".join(f"p{i}" for i in range(60))
    edited = shared.replace("p30 ", "q30 ")
    own = lambda c: " ".join(f"{c}{i}" for i in range(80))
    rows = [(1, f"{own('a')} {shared} {own('b')}"), (2, f"{shared} {own('c')}"), (3, own("d")), (4, f"{own('e')} {edited}"),
            (5, "same " * 5000), (6, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 " + own("f"))]
    found = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["spans"] == "80:140" and found[2]["spans"] == "0:60"
    assert found[1]["first_id"] == found[2]["first_id"] == 1
    assert [found[i]["n_spans"] for i in (3, 5, 6)] == [0, 0, 0]
    rest = substring_dedup.repeated_passages(odd).collect()
    assert len(rest) == 14 and {r["doc_id"] for r in rest if r["n_spans"]} == {3, 4, 5}
    assert substring_dedup.repeated_passages(none).count() == 0


def test_pipeline(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in rows}
    assert all(r["exact"] for r in rows) and kept <= set(texts)
    assert len({texts[i] for i in kept}) == len(kept)
    label, _ = brute_components({i: texts[i] for i in kept}, sets_of)
    assert all(i == c for i, c in label.items())


def test_window_keys_are_those_of_the_tree():
    rng = np.random.default_rng(5)
    # Few different values in one sequence: equal minima; a short one has no window.
    sequences = [rng.integers(1, top, n).astype(np.uint64) for top, n in ((1 << 62, 300), (9, 200), (1 << 62, 45), (2, 90))]

    def nodes(values, left, right):
        if right - left + 1 >= substring_dedup.WIDTH:
            least = min(values[left : right + 1])
            ties = [c for c in range(left, right + 1) if values[c] == least]
            yield from ((left, c, right) for c in ties)
            for a, b in zip([left - 1, *ties], [*ties, right + 1]):
                yield from nodes(values, a + 1, b - 1)

    sizes = np.array([len(s) for s in sequences])
    keys, owners, places = substring_dedup.window_keys(np.concatenate(sequences), sizes)
    run = substring_dedup.RUN
    for k, s in enumerate(sequences):
        runs = set()
        for f in range(substring_dedup.HASHES):
            salt = np.uint64((f + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            for left, c, right in nodes(substring_dedup.mix(s ^ salt).tolist(), 0, len(s) - 1):
                runs |= {tuple(s[c : c + run])} if c + run - 1 <= right else set()
                runs |= {tuple(s[c - run + 1 : c + 1])} if c - run + 1 >= left else set()
        own = owners == k
        assert own.sum() == len(runs) == len(set(keys[own].tolist()))
        assert all(0 <= p < len(s) for p in places[own])


def test_one_changed_word_is_met():
    rng = np.random.default_rng(6)
    met = 0
    for _ in range(200):
        words = rng.integers(1, 1 << 62, (2, 150))
        words[1, 60:110] = words[0, 30:80]
        words[1, rng.integers(60, 110)] = 0
        shingles = [substring_dedup.mix(sum(w[i : i + 146].astype(np.uint64) << np.uint64(i) for i in range(5))) for w in words]
        keys, owners, _ = substring_dedup.window_keys(np.concatenate(shingles), np.array([146, 146]))
        met += len(np.intersect1d(keys[owners == 0], keys[owners == 1])) > 0
    assert met >= 180
