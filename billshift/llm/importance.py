"""Target-distribution importance resampling over hashed word n-grams.

Documents that look like a target corpus get a higher weight: the sum, over their
n-grams, of the log ratio of the n-gram's hash bucket in the target and in the raw
corpus. A perturbed top-k (Gumbel noise from a hash of the id) then draws without
replacement in proportion to the weights, and reruns draw the same.

N-grams come from one regular expression per length: separators are collapsed to
single spaces, and an overlapped scan between boundary lookarounds meets every run of
words as a span, whose bytes go to the CRC as they stand. No word list is built.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift.llm.arrays import text_slices
from billshift.operators.ranking import numbered
from billshift.sources.writers import materialise

#: N-gram lengths and hash buckets.
LENGTHS = (1,)
BUCKETS = 10_000
#: Documents below so many words are not drawn; this percentage of the others is.
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"

#: ASCII letters in lower case, digits, all bytes of other characters; the rest is a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SPACES = re.compile(rb" +")


def collapsed(text: bytes) -> bytes:
    """UTF-8 text in lower case, every run of separators one space."""
    return _SPACES.sub(b" ", text.translate(_FOLD))


def span_pattern(length: int) -> regex.Pattern:
    """Runs of ``length`` words of a collapsed text; to be scanned overlapped."""
    more = rb"(?: [^ ]+){%d}" % (length - 1) if length > 1 else b""
    return regex.compile(rb"(?<![^ ])[^ ]+" + more + rb"(?![^ ])")


def spans(text: str, lengths: Sequence[int] = LENGTHS) -> Iterator[tuple[int, int]]:
    """Start and end, in the collapsed text's bytes, of every n-gram."""
    data = collapsed(text.encode())
    for length in lengths:
        for match in span_pattern(length).finditer(data, overlapped=True):
            yield match.span()


def bucket_counts(data: bytes, patterns: Sequence[regex.Pattern], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the n-grams of a collapsed text, and how often each occurs.

    Matches are consumed one by one, so a long text costs four bytes an n-gram.
    """
    crcs = [
        np.fromiter((zlib.crc32(m[0]) for m in p.finditer(data, overlapped=True)), np.uint32) for p in patterns
    ]
    found, counts = np.unique(np.concatenate(crcs) % np.uint32(buckets), return_counts=True)
    return found.astype(np.int32), counts.astype(np.int64)


_COUNTED = "{id}n_words long, buckets array<int>, counts array<long>"


def count_features(
    texts: DataFrame, lengths: Sequence[int] = LENGTHS, buckets: int = BUCKETS, with_id: bool = True
) -> DataFrame:
    """``doc_id, n_words, buckets, counts`` per row of ``texts`` (``doc_id, text``), in one scan."""
    texts = texts.select("doc_id", "text") if with_id else texts.select("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(n) for n in lengths]
        for batch in batches:
            for part in text_slices(batch):
                words, found, counts = [], [], []
                for text in part.column("text").cast(pa.binary()):
                    data = collapsed(text.as_py())
                    words.append(data.strip().count(b" ") + 1 if data.strip() else 0)
                    pair = bucket_counts(data, patterns, buckets)
                    found.append(pair[0])
                    counts.append(pair[1])
                arrays = [
                    pa.array(words, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ]
                names = ["n_words", "buckets", "counts"]
                if with_id:
                    arrays, names = [part.column("doc_id"), *arrays], ["doc_id", *names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, " if with_id else ""
    return texts.mapInArrow(scan, _COUNTED.format(id=kind))


def bucket_totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of every bucket over all rows: one long per bucket reaches the driver."""
    cells = counted.select(F.inline(F.arrays_zip(F.col("buckets").alias("bucket"), F.col("counts").alias("n"))))
    totals = np.zeros(buckets, np.int64)
    for row in cells.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    return totals


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in target and raw corpus."""
    size, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * float(s_all + size)) / (float(s + 1) * float(t_all + size))))
            for s, t in zip(raw.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(counted: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per counted row; the gains are one long per bucket."""
    shared = counted.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = batch.column("buckets"), batch.column("counts")
            n = counts.flatten().to_numpy(zero_copy_only=False)
            gain = shared.value[found.flatten().to_numpy(zero_copy_only=False)] * n
            sizes = np.diff(counts.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(features, owner, n)
            np.add.at(weight, owner, gain)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    kind = counted.schema["doc_id"].dataType.simpleString()
    return counted.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def resampling_scores(
    docs: DataFrame,
    target: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    buckets: int = BUCKETS,
    seed: str = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs``.

    ``target`` needs a column ``text``, ``docs`` also ``doc_id``; other columns don't
    matter. Of the documents with at least ``least_words`` words, the ``percent``
    with the highest scores are drawn and get a ``rank`` from 1 on; equal scores go by
    doc_id, rows without one last. Null and empty texts have no features and weight 0.
    Repeated rows are rows of their own with equal scores; which of them gets the
    earlier of two ranks is open, the result is the same. An empty ``docs`` gives an
    empty table, an empty ``target`` leaves only the smoothing.
    """
    counted = materialise(count_features(docs, lengths, buckets), "resampling-counts")
    wanted = count_features(target, lengths, buckets, with_id=False)
    gains = bucket_gains(bucket_totals(counted, buckets), bucket_totals(wanted, buckets))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weighted(counted, gains).withColumn("score", F.col("weight") + noise.cast("long"))
    scored = materialise(scored, "resampling-scores")
    enough = F.col("n_words") >= least_words
    drawn = percent * scored.where(enough).count() // 100
    ranked = numbered(
        scored.where(enough), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank", start=1
    ).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
