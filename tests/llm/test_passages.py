"""Passages at the threshold: keys, search within a pair, and links of documents."""

import numpy as np

from billshift.llm import substring_dedup
from billshift.sources.writers import materialise


def shingled(words):
    n = len(words) - 4
    return substring_dedup.mix(sum(words[i : i + n].astype(np.uint64) << np.uint64(i) for i in range(5)))


def changed(rng, at):
    """Two texts of 150 words with 50 in common, one of them changed at ``at`` of the passage."""
    words = rng.integers(1, 1 << 62, (2, 150))
    words[1, 60:110] = words[0, 30:80]
    words[1, 60 + at] = 0
    return [shingled(w) for w in words]


def test_an_equal_stretch_always_shares_a_key():
    rng = np.random.default_rng(3)
    n = substring_dedup.STRETCH
    for k in range(300):
        values = rng.integers(1, 1 << 62 if k % 2 else 40, (2, 120)).astype(np.uint64)
        i, j = rng.integers(0, 120 - n + 1, 2)
        values[1, j : j + n] = values[0, i : i + n]
        keys, owners, _ = substring_dedup.stretch_keys(np.concatenate(values), np.array([120, 120]))
        assert len(np.intersect1d(keys[owners == 0], keys[owners == 1])) > 0
    assert all(len(x) == 0 for x in substring_dedup.stretch_keys(values[0, : n - 1], np.array([n - 1])))


def test_one_changed_word_is_found_wherever_it_is():
    rng = np.random.default_rng(4)
    for at in range(50):
        a, b = changed(rng, at)
        keys, owners, _ = substring_dedup.stretch_keys(np.concatenate([a, b]), np.array([146, 146]))
        assert len(np.intersect1d(keys[owners == 0], keys[owners == 1])) > 0
        (i0, i1, j0, j1), = substring_dedup.passages(a, b)
        x, y = set(a[i0 : i1 + 1].tolist()), set(b[j0 : j1 + 1].tolist())
        assert min(i1 - i0, j1 - j0) + 1 >= substring_dedup.WIDTH and len(x & y) >= 0.8 * len(x | y)
        assert i0 <= 34 and i1 >= 71 and i1 < 146 and j1 < 146


def test_parts_that_are_not_alike_are_none():
    rng = np.random.default_rng(7)
    words = rng.integers(1, 1 << 62, (2, 150))
    words[1, 60:104] = words[0, 30:74]  # 44 equal words: 40 shingles, 40 of 52
    assert substring_dedup.passages(*[shingled(w) for w in words]) == []
    words[1, 60:105] = words[0, 30:75]
    assert len(substring_dedup.passages(*[shingled(w) for w in words])) == 1
    # Repeated shingles count once.
    tune = np.tile(rng.integers(1, 1 << 62, 12), 10)
    assert substring_dedup.passages(shingled(tune), shingled(tune[3:]))


def test_documents_with_a_change_near_the_end_of_a_passage_are_linked(spark):
    own = lambda c: " ".join(f"{c}{i}" for i in range(80))
    shared = [f"p{i}" for i in range(50)]
    rows = [(1, f"{own('a')} {' '.join(shared)} {own('b')}")]
    for doc, at in ((2, 2), (3, 25), (4, 47)):
        rows.append((doc, " ".join([own(f"x{doc}"), *shared[:at], "other", *shared[at + 1 :], own(f"y{doc}")])))
    rows.append((5, " ".join([own("z"), *shared[:30], own("w")])))
    found = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i]["first_id"] for i in range(1, 6)] == [1, 1, 1, 1, None]
    assert all(found[i]["n_spans"] == 1 for i in range(1, 5))


def test_a_line_that_many_share_makes_few_pairs(spark, monkeypatch):
    counts = []

    def counted(df, name, *rest):
        stored = materialise(df, name, *rest)
        counts.append(stored.count() if name == "substring-tried" else 0)
        return stored

    monkeypatch.setattr(substring_dedup, "materialise", counted)
    own = lambda c, n=80: [f"{c}{i}" for i in range(n)]
    line = [f"l{i}" for i in range(30)]
    rows = [(k, " ".join([*own(f"x{k}"), *line, *own(f"y{k}")])) for k in range(40)]
    # A passage around the line that two of them have, with another word in it.
    rows += [(40, " ".join([*own("a"), *line, "one", *own("p", 24), *own("b")])),
             (41, " ".join([*own("c"), *line, "two", *own("p", 24), *own("d")]))]
    # Runs of one word share a key; those that are as wide as a passage are alike.
    rows += [(k, " ".join([*[f"m{k}"] * 40, *["the"] * (45 if k < 70 else 60), *[f"n{k}"] * 40])) for k in range(50, 74)]
    found = {r["doc_id"]: r["first_id"] for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = {k: c for k, c in found.items() if c is not None}
    assert linked == {40: 40, 41: 40, **{k: 70 for k in range(70, 74)}}
    assert sum(counts) <= 3 * len(rows)  # all pairs: 1,137


def test_copies_that_differ_everywhere_make_few_pairs(spark, monkeypatch):
    """All share lines of 18 words and more; what few of them share is found without a search of each pair."""
    counts = []

    def counted(df, name, *rest):
        stored = materialise(df, name, *rest)
        counts.append(stored.count() if name == "substring-tried" else 0)
        return stored

    monkeypatch.setattr(substring_dedup, "materialise", counted)
    rng = np.random.default_rng(11)
    base, texts = [f"w{i}" for i in range(240)], []
    for k in range(60):
        words = list(base)
        for at in range(int(rng.integers(0, 28)), len(words), 28):
            words[at] = f"x{k}y{at}"
        texts.append(words)
    texts[50][100:160] = texts[51][100:160]
    number = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
    shingles = [shingled(substring_dedup.mix(np.array([number[w] for w in t], np.uint64)) >> np.uint64(2)) for t in texts]
    want = {k for k in range(60) for m in range(60) if k != m and substring_dedup.passages(shingles[k], shingles[m])}
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {50, 51} <= want and {r["doc_id"] for r in found if r["n_spans"]} == want
    assert sum(counts) <= 10 * len(rows)  # all pairs: 1,770


def test_large_groups_are_dealt_and_searched(spark, monkeypatch):
    own = lambda c, n=80: [f"{c}{i}" for i in range(n)]
    line = [f"l{i}" for i in range(30)]
    rows = [(k, " ".join([*own(f"x{k}"), *line, *own(f"y{k}")])) for k in range(20)]
    rows += [(40, " ".join([*own("a"), *line, "one", *own("p", 24), *own("b")])),
             (41, " ".join([*own("c"), *line, "two", *own("p", 24), *own("d")]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Also where each open document is compared in a task of its own.
    for large, share in ((4, 512), (100, 1)):
        monkeypatch.setattr(substring_dedup, "LARGE", large)
        monkeypatch.setattr(substring_dedup, "SHARE", share)
        found = {r["doc_id"]: r["first_id"] for r in substring_dedup.repeated_passages(docs).collect()}
        assert {k: c for k, c in found.items() if c is not None} == {40: 40, 41: 40}


def test_reach_holds_all_passages():
    rng = np.random.default_rng(12)
    total = 0
    for n in range(120):
        words = rng.integers(1, 1 << 62, (2, 400)) if n % 3 else rng.integers(1, 40, (2, 400))
        words[1] = words[0]
        for at in rng.integers(0, 400, rng.integers(0, 24)):
            words[1, at] = rng.integers(1, 1 << 62)
        a, b = shingled(words[0]), shingled(np.delete(words[1], rng.integers(0, 400, n % 4)))
        docs = substring_dedup._Documents(np.arange(2), np.concatenate([a, b]), np.array([len(a), len(b)]))
        both = np.flatnonzero(np.isin(a, b))
        for i0, i1, _, _ in substring_dedup.passages(a, b):
            at = both[(both >= i0) & (both <= min(i1, len(a) - substring_dedup.SHORT))]
            may = [m[0] for _, m in docs.near(0, at, np.array([1]), np.ones((1, len(at)), bool))]
            assert may and may[0].mean() > (0.999 if n % 3 else 0.9)
            total += 1
    assert total > 100
