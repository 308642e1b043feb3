"""Exact top-k, importance resampling, divergence audit."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import normalised, spark_rows, sql_rows
from pyspark.sql import functions as F

from billshift.llm import block_topk, divergence, importance
from billshift.llm.queries_samples import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got[1] and got == normalised(*sql_rows(sf_dir, ORACLE[name]))


# --- top-k ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, score string, shard string, row string"


def brute_top(rows, top):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (query, q) in enumerate(usable):
        if query is None or query % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), math.inf if i is None else i, i) for b, (i, v) in enumerate(usable) if a != b]
        out += [(query, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:top])]
    return sorted(map(str, out))


def top_rows(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS).repartition(3)
    found = block_topk.top_products(frame, F.col("vec_id") % 50 == 0, **options)
    return sorted(str(tuple(r)) for r in found.collect())


def test_top_products_of_clusters_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.1).tolist()) for i in range(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1200)]  # a third is one vector
    rows += [
        (1200, None), (1250, [1.0, None] + [0.0] * 6), (1300, [float("nan")] * 8), (1350, [float("inf")] * 8),
        (1400, []), (1450, [0.5]), (0, rows[7][1]), (0, rows[7][1]), (None, rows[3][1]), (50, [-1e6] * 8),
    ]
    for shard in (8192, 100):
        assert top_rows(spark, rows, shard=shard) == brute_top(rows, 5)


def test_few_candidates_and_no_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert top_rows(spark, rows) == brute_top(rows, 5) and len(top_rows(spark, rows)) == 2
    assert top_rows(spark, [(0, [1.0])]) == [] and top_rows(spark, []) == []


def test_search_skips_blocks_below_the_kth_score(monkeypatch):
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 5, size=(16, 4)) + 10 * (b == 3) for b in range(40)]
    rows = [np.arange(16) + 16 * b for b in range(40)]
    scored, real = [], block_topk.products
    monkeypatch.setattr(block_topk, "products", lambda a, b: scored.append(len(b)) or real(a, b))
    least = np.full(1, block_topk._NONE)
    score, place = block_topk.search(np.ones((1, 4), int), np.array([-1]), least, blocks, rows, rows, 5, step=1)
    # Two products for the bounds, then one block only.
    assert len(scored) == 3 and set(place[0] // 16) == {3}
    assert score[0].tolist() == sorted(np.concatenate(blocks).sum(axis=1).tolist(), reverse=True)[:5]


def test_large_numbers_stay_exact_or_fail():
    big = np.array([[1 << 30, 1]])
    assert block_topk.products(big, big)[0, 0] == (1 << 60) + 1
    with pytest.raises(OverflowError):
        block_topk.products(big * 8, big * 8)


# --- resampling -----------------------------------------------------------


def brute_resampling(docs, target, lengths, buckets, least, percent):
    def grams(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + n]) for n in lengths for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    rows = [(doc_id, *grams(text)) for doc_id, text in docs]
    raw, wanted = Counter(b for r in rows for b in r[2]), Counter(b for t in target for b in grams(t)[1])
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in raw
    }
    scored = []
    for doc_id, words, found in rows:
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        scored.append((doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    enough = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    drawn = enough[: percent * len(enough) // 100]
    out = [(r[0], r[2], r[3], r[4], i + 1) for i, r in enumerate(drawn)]
    out += [(r[0], r[2], r[3], r[4], None) for r in [*enough[len(drawn) :], *(r for r in scored if r[1] < least)]]
    return sorted(map(str, out))


@pytest.mark.parametrize("lengths", [(1,), (1, 2), (3,)])
def test_resampling_of_odd_rows(spark, odd, lengths):
    target = spark.createDataFrame([("w1 w2 w3 quick brown",), (None,), ("",), ("One two",)], "text string")
    found = importance.resampling_scores(odd, target, lengths, buckets=97, least_words=2, percent=40)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute_resampling(docs, [r["text"] for r in target.collect()], lengths, 97, 2, 40)
    assert sorted(str(tuple(r)) for r in found.collect()) == want
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_spans_meet_every_run_of_words():
    text = "  One\ttwo,,three x 4! "
    data = importance.collapsed(text.encode())
    assert data == " one two three x 4 ".encode()
    words = data.split()
    for n in range(1, 6):
        got = [data[a:b] for a, b in importance.spans(text, (n,))]
        assert got == [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    assert list(importance.spans("", (1, 2))) == [] and list(importance.spans(" ?! ")) == []


def test_resampling_of_empty_tables(spark, odd, none):
    texts = spark.createDataFrame([], "text string")
    assert importance.resampling_scores(none, texts).count() == 0
    assert importance.resampling_scores(odd, texts, least_words=1).where("rank is not null").count() == 1


# --- divergence -----------------------------------------------------------


def brute_audit(docs, least_docs, terms):
    counts, of_docs, names = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]
        names.add((lang, source))
        counts[lang, source].update(found)
        of_docs[lang].update(set(found))
    out = []
    for lang in {n[0] for n in names}:
        kept = [t for t, n in of_docs[lang].items() if n >= least_docs]
        sources = [s for x, s in names if x == lang]
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])

        def shares(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (size + len(kept)) for t in kept}

        of_lang = shares(total)
        for s in sources:
            p, items = shares(counts[lang, s]), {"pair": [], "term": []}
            for other in sources:
                if other != s:
                    q = shares(counts[lang, other])
                    items["pair"].append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other))
            for t in kept:
                if counts[lang, s][t] and p[t] > of_lang[t]:
                    items["term"].append((-((p[t] - of_lang[t]) ** 2 // of_lang[t]), t))
            for part, found in items.items():
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))
                found = found if part == "pair" else found[:terms]
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(found)]
    return sorted(map(str, out))


ROWS = [(t, lang, source) for lang in ("en", "de") for source in ("a", "b", "c") for t in ("Alpha beta beta", "beta gamma é", f"{source} delta")]


@pytest.mark.parametrize("cells", [1 << 20, 7, 1])
def test_audit_by_brute_force(spark, odd, cells):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()] + ROWS + [("lonely", "xx", "a"), (None, "xx", "b")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "text string, lang string, source string, term string, n string")
    found = divergence.audit(frame, least_docs=2, terms=5, segment_cells=cells)
    assert sorted(str(tuple(r)) for r in found.collect()) == brute_audit(rows, 2, 5)


def test_audit_of_an_empty_table(none):
    assert divergence.audit(none).count() == 0


def test_runs_and_their_intersections():
    rng = np.random.default_rng(2)
    a, b = (np.repeat(rng.integers(1, 10**9, 9), rng.multinomial(200, [1 / 9] * 9)) for _ in range(2))
    assert len(divergence.runs(a)[0]) <= 9
    want = sum((x - y) ** 2 // y for x, y in zip(a.tolist(), b.tolist())), sum((x - y) ** 2 // x for x, y in zip(a.tolist(), b.tolist()))
    assert divergence.divergences(divergence.runs(a), divergence.runs(b), 200) == want


def test_vocabulary_puts_equal_columns_side_by_side(spark):
    rows = [(lang, s, f"t{i}", 1 + i % 3, 3) for lang in ("en",) for i in range(60) for s in ("a", "b")]
    counts = spark.createDataFrame(rows, "lang string, source string, term string, n long, n_docs long")
    kept = sorted(divergence.vocabulary(counts).collect(), key=lambda r: r["place"])
    assert [r["place"] for r in kept] == list(range(60))
    assert len(divergence.runs(np.array([r["lang_n"] for r in kept]))[0]) == 3


def test_shares_are_exact_for_large_counts(spark):
    n, total = 9 * 10**18, 9 * 10**18 + 5
    row = spark.range(1).select(F.lit(n).alias("n"), F.lit(total).alias("total"), F.lit(7).alias("size"))
    got = row.select(divergence.share("n", "total", "size")).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + 7)
