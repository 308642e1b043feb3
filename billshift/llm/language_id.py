"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is one matrix of log-probabilities, languages by hash buckets. Its size
is fixed by the number of languages and ``BUCKETS``, not by the corpus, so it is
broadcast. Texts are scored in numpy, batch by batch: the n-grams of a text pick
rows of the matrix, and their sum decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billshift.functions.names import unused
from billshift.llm.arrays import code_points, mix, text_slices, utf8

#: Lengths of the character n-grams, and the hash buckets they share.
NGRAMS = (1, 2, 3)
BUCKETS = 1 << 14
#: Added to every count.
SMOOTHING = 0.5
#: The fit reads about so many labelled rows of each language, chosen by the hash of
#: doc_id: a bounded sample. Languages with fewer rows are read whole.
FIT_ROWS = 4000
UNKNOWN = "und"
#: N-grams are made for so many bytes at once, also within one text.
PIECE_BYTES = 256 << 10


def _pieces(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Texts without nulls in pieces of about ``size`` bytes, so memory follows the piece, not the text.

    A piece is several texts or a part of one: the place of its first text, its code
    points, where its texts begin and end in them, and how many of the code points n-grams may
    begin at. A part of a text also has the code points that its last n-grams reach into.
    """
    data, ends = utf8(texts)
    more = max(NGRAMS) - 1
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + size, side="right")) - 1)
        if ends[stop] - ends[start] <= size:
            chars, offsets = code_points(texts.slice(start, stop - start))
            yield start, chars, offsets, len(chars)
        else:
            at, end = int(ends[start]), int(ends[stop])
            while at < end:
                upto = min(at + size, end)
                # Code points of UTF-8 have at most four bytes.
                after = data[upto : min(upto + 4 * (more + 1), end)]
                heads = np.flatnonzero((after & 0xC0) != 0x80)
                reach = upto + (int(heads[more]) if len(heads) > more else len(after))
                upto += int(heads[0]) if len(heads) else len(after)
                chars = np.frombuffer(data[at:reach].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
                ahead = int(((data[upto:reach] & 0xC0) != 0x80).sum())
                yield start, chars, np.array([0, len(chars)]), len(chars) - ahead
                at = upto
        start = stop


def _grams(chars: np.ndarray, offsets: np.ndarray, begin: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one n-gram length after the other: bucket of every n-gram, and its text's place in the piece."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = np.repeat(offsets[1:], np.diff(offsets))
    position = np.arange(len(chars))
    rolled = np.zeros(len(chars), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        shifted = np.zeros(len(chars), np.uint64)
        if len(chars) >= n:
            shifted[: len(chars) - n + 1] = chars[n - 1 :]
        rolled = mix(rolled * np.uint64(0x100000001B3) + shifted + np.uint64(n))
        if n in NGRAMS:
            inside = (position + n <= end) & (position < begin)
            yield (rolled[inside] % np.uint64(BUCKETS)).astype(np.int32), owner[inside]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task one row of counts for each language it met."""
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for part in text_slices(batch):
            texts, langs = part.column("text"), part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            found = np.zeros(len(names) * BUCKETS, np.int64)
            for start, *piece in _pieces(texts, PIECE_BYTES):
                for buckets, owners in _grams(*piece):
                    found += np.bincount(number[start + owners] * BUCKETS + buckets, minlength=len(found))
            found = found.reshape(-1, BUCKETS)
            for i, name in enumerate(names):
                counts[name] = counts.get(name, 0) + found[i]
                rows[name] = rows.get(name, 0) + int((number == i).sum())
    yield pa.RecordBatch.from_pydict(
        {
            "lang": pa.array(list(counts), pa.string()),
            "n_rows": pa.array(list(rows.values()), pa.int64()),
            "counts": pa.array([c.astype(np.int64) for c in counts.values()], pa.list_(pa.int64())),
        }
    )


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> dict[str, np.ndarray | list[str]]:
    """Log-probabilities from rows with ``doc_id, text, lang``.

    Rows without text or language are left out. Returns the sorted languages, the
    matrix ``[bucket, language]`` and the log-priors; no languages, empty arrays.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"langs": [], "logp": np.zeros((BUCKETS, 0)), "prior": np.zeros(0)}
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20))
    share = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1, fit_rows / n) * (1 << 20)))]
    )
    sample = rows.where(draw < share[F.col("lang")]).select("text", "lang")
    parts = sample.mapInArrow(_count_task, "lang string, n_rows long, counts array<long>")
    # Cells are summed across tasks by (language, bucket): languages x buckets rows at most.
    cells = (
        parts.select("lang", F.posexplode("counts").alias("bucket", "n"))
        .where("n > 0")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(sizes)
    counts = np.zeros((BUCKETS, len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    counts[cells["bucket"].to_numpy(int), cells["lang"].map(column).to_numpy(int)] = cells["n"]
    counts += SMOOTHING
    prior = np.array([sizes[lang] for lang in langs], float)
    return {
        "langs": langs,
        "logp": np.log(counts / counts.sum(axis=0)).astype(np.float32),
        "prior": np.log(prior / prior.sum()),
    }


def score_texts(texts: pa.Array, langs: list[str], logp: np.ndarray, prior: np.ndarray):
    """Predicted language and its posterior probability for every text of a batch."""
    total = np.zeros((len(langs), len(texts)))
    columns = np.ascontiguousarray(logp.T)
    for start, *piece in _pieces(texts, PIECE_BYTES):
        for buckets, owners in _grams(*piece):
            for j, column in enumerate(columns):
                sums = np.bincount(owners, weights=column[buckets])
                total[j, start : start + len(sums)] += sums
    total = total.T + prior
    best = total.argmax(axis=1)
    posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    named = [langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return named, np.where(lettered, posterior, 0.0)


def identify(docs: DataFrame, model: dict, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``lang_pred`` and ``score`` beside every column of ``docs``.

    ``und`` with score 0 for a null text, one without letters, or a model that knows
    no language. Columns of these two names are replaced; they can be named otherwise.
    """
    docs = docs.drop(lang_pred, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            whole, at = batch, 0
            for part in text_slices(batch):
                texts = part.column("text")
                if m["langs"]:
                    named, sure = score_texts(texts, m["langs"], m["logp"], m["prior"])
                else:
                    named, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
                rows = whole.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(named, pa.string()), pa.array(sure, pa.float64())],
                    names=[*names, lang_pred, score],
                )

    schema = StructType([*docs.schema.fields]).add(lang_pred, "string").add(score, "double")
    return docs.mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may read: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_corpus(docs: DataFrame) -> dict:
    """Fit on the rows that aren't held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The documents whose language is recognised: not ``und``, posterior at least ``least``."""
    lang, score = (unused(docs.columns, n) for n in ("_lang_pred", "_score"))
    judged = identify(docs, model, lang, score)
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
