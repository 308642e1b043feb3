"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its inner
s-mers is that of its first or last. Whether a k-mer is chosen depends on itself
alone, so the same passage gives the same anchors wherever it stands. A fingerprint
keeps the anchors with the smallest hashes, each with the place of its first
occurrence; two fingerprints estimate the resemblance of their texts, and places of
common anchors tell how the texts are shifted against each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift.llm.arrays import code_points, mix, text_slices

#: Lengths of the k-mers and of their inner s-mers.
K = 16
S = 8
#: Anchors kept in a fingerprint.
ANCHORS = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points from every position on (short ones at the end are left out)."""
    if len(chars) < n:
        return np.zeros(0, np.uint64)
    # Binary powers: the hash of 2m points from two hashes of m.
    acc, acc_len = None, 0
    power, length = mix(chars.astype(np.uint64) + np.uint64(1)), 1
    rest = n
    while rest:
        if rest & 1:
            if acc is None:
                acc, acc_len = power, length
            else:
                m = len(chars) - acc_len - length + 1
                acc = mix(acc[:m] * _BASE + power[acc_len : acc_len + m])
                acc_len += length
        rest >>= 1
        if rest:
            m = len(power) - length
            power = mix(power[:m] * _BASE + power[length : length + m])
            length *= 2
    return acc


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    out, span = h, 1
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: len(out) - (width - span)], out[width - span :])
    return out


def anchors(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and code-point places of all closed syncmers of every text, in text order.

    A text shorter than ``K`` has one anchor, the whole of it; an empty one has none.
    """
    chars, offsets = code_points(texts)
    grams = _gram_hashes(chars, K)
    inner = _gram_hashes(chars, S)
    width = K - S + 1
    chosen = np.zeros(0, np.int64)
    if len(grams):
        least = _window_minima(inner, width)[: len(grams)]
        edge = (inner[: len(grams)] == least) | (inner[width - 1 : width - 1 + len(grams)] == least)
        chosen = np.flatnonzero(edge)
    out = []
    first = np.searchsorted(chosen, offsets[:-1])
    last = np.searchsorted(chosen, np.maximum(offsets[1:] - K + 1, offsets[:-1]))
    for i in range(len(texts)):
        start, end = offsets[i], offsets[i + 1]
        if end - start >= K:
            places = chosen[first[i] : last[i]]
            if len(places) == 0:  # no window of this text has its minimum at an edge
                places = np.array([start])
            out.append((grams[places], places - start))
        elif end > start:
            whole = _gram_hashes(chars[start:end], int(end - start))
            out.append((whole, np.zeros(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def sketch(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``ANCHORS`` smallest distinct hashes with the first place of each."""
    values, first = np.unique(hashes, return_index=True)
    return values[:ANCHORS], places[first[:ANCHORS]]


def encode(values: np.ndarray, places: np.ndarray) -> str:
    """``hash@place`` in hexadecimal, by hash."""
    return " ".join(f"{v:016x}@{p:x}" for v, p in zip(values.tolist(), places.tolist()))


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = [x.split("@") for x in fingerprint.split()]
    return (
        np.array([int(v, 16) for v, _ in pairs], np.uint64),
        np.array([int(p, 16) for _, p in pairs], np.int64),
    )


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common anchors: among the smallest of both, those in both.

    Two empty texts are alike (1), an empty and another text are not (0).
    """
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = np.intersect1d(a, b, assume_unique=True)
    union = np.union1d(a, b)[:ANCHORS]
    return float(np.isin(both, union, assume_unique=True).sum() / len(union))


def shift(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """The commonest place difference of common anchors, and how many agree on it."""
    _, i, j = np.intersect1d(a[0], b[0], return_indices=True)
    if len(i) == 0:
        return 0, 0
    steps, counts = np.unique(b[1][j] - a[1][i], return_counts=True)
    return int(steps[counts.argmax()]), int(counts.max())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; null texts count as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text")
                marks = [encode(*sketch(*x)) for x in anchors(texts)]
                lengths = pc.utf8_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lengths, pa.array(marks, pa.string())],
                    names=["doc_id", "n_chars", "fingerprint"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_chars long, fingerprint string"
    )


class _Buckets:
    """Ranges of ids in descending order, and the ids at the head of each.

    Both lists are as long as the number of buckets, not as the table.
    """

    def __init__(self, docs: DataFrame, buckets: int):
        ids = docs.select(F.col("doc_id").cast("long"))
        shares = [i / buckets for i in range(1, buckets)]
        cuts = ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
        self.cuts = sorted(set(cuts or []))
        heads = ids.withColumn("bucket", self.bucket()).groupBy("bucket").agg(F.max("doc_id").alias("head"))
        self.heads = {r["bucket"]: r["head"] for r in heads.collect()}

    def bucket(self):
        """Bucket 0 holds the largest ids; null ids come last."""
        above = F.size(F.filter(F.array(*[F.lit(c) for c in self.cuts]), lambda c: c >= F.col("doc_id"))) if self.cuts else F.lit(0)
        return F.when(F.col("doc_id").isNull(), F.lit(len(self.cuts) + 1)).otherwise(above)

    def before(self) -> dict[int, int]:
        """For every bucket the one whose last row its first row follows."""
        held = sorted(self.heads)
        return {b: held[i - 1] for i, b in enumerate(held)}


def compare_with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, which ends as the next begins.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The next row is that with the next smaller doc_id (null last, equal
    ids by text); after the last comes the first. The last half of a text gives way
    to as many code points from the start of the next.

    Texts move once: rows go to buckets of neighbouring ids, and the first row of
    a bucket also to the bucket before, so that each bucket is worked off alone as a
    sorted stream that looks one row ahead.
    """
    spark = docs.sparkSession
    if buckets is None:
        buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout = _Buckets(docs, buckets)
    before = layout.before()
    if not before:
        return spark.createDataFrame([], _COMPARED)
    is_head = F.lit(False)
    for b, head in layout.heads.items():
        if head is None:
            is_head = is_head | (F.col("bucket") == b)
    heads = F.create_map(*[F.lit(x) for b, h in layout.heads.items() if h is not None for x in (b, h)]) if any(
        h is not None for h in layout.heads.values()
    ) else None
    if heads is not None:
        is_head = F.coalesce(F.col("doc_id") == heads[F.col("bucket")], F.lit(False)) | is_head
    previous = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    # The head of a bucket follows the last row of the bucket before as its "ghost".
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("ghost"))
    ghost = F.struct(previous[F.col("bucket")].alias("to"), F.lit(True).alias("ghost"))
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("bucket", layout.bucket())
    sent = placed.select(
        "doc_id", "text", F.explode(F.when(is_head, F.array(own, ghost)).otherwise(F.array(own))).alias("place")
    ).select(F.col("place.to").alias("to"), F.col("place.ghost").alias("ghost"), "doc_id", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = sent.repartition(parts, "to").sortWithinPartitions(
        "to", "ghost", F.desc_nulls_last("doc_id"), "text"
    )
    return stream.mapInArrow(_compare, _COMPARED)


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole buckets, in order, each bucket ending with its ghosts.

    Holds one slice of rows and the row before it.
    """
    held: pa.RecordBatch | None = None
    for batch in batches:
        for part in text_slices(batch):
            if held is not None:
                part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            done = _compared(part)
            if done is not None:
                yield done
            held = part.slice(part.num_rows - 1, 1)


def _compared(part: pa.RecordBatch) -> pa.RecordBatch | None:
    """Each row of the slice against the one after it; ghosts only follow."""
    to, ghost = part.column("to").to_pylist(), part.column("ghost").to_pylist()
    here = [i for i in range(part.num_rows - 1) if not ghost[i]]
    assert all(to[i] == to[i + 1] for i in here), "a row has no row after it"
    if not here:
        return None
    column = part.column("text")
    texts = column.to_pylist()
    marks = [sketch(*x) for x in anchors(column)]
    edited = []
    for i in here:
        text, half = texts[i], len(texts[i]) // 2
        edited.append(text[: len(text) - half] + texts[i + 1][:half])
    edited_marks = []
    for piece in text_slices(pa.RecordBatch.from_pydict({"text": pa.array(edited, pa.string())})):
        edited_marks += [sketch(*x) for x in anchors(piece.column("text"))]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": part.column("doc_id").take(pa.array(here)),
            "n_chars": pa.array([len(texts[i]) for i in here], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            "fingerprint": pa.array([encode(*marks[i]) for i in here]),
            "edited_fingerprint": pa.array([encode(*m) for m in edited_marks]),
            "near_edited": pa.array([likeness(marks[i][0], m[0]) for i, m in zip(here, edited_marks)]),
            "near_next": pa.array([likeness(marks[i][0], marks[i + 1][0]) for i in here]),
        }
    )
