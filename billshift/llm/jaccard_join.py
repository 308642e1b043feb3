"""Exact Jaccard join of documents on word shingles, by parity sketches.

Every shingle of a document flips one bit of a parity sketch; two sketches differ in
no more bits than the sets differ in elements. Sets of sizes a and b with similarity
J or more differ in at most ``(a + b) * (1 - J) / (1 + J)`` elements. Sizes are
grouped into bands; for a band the sketch is cut into more parts than sets of the
band may differ in, so that similar sets agree in at least one whole part
(pigeonhole). Parts are compared by a 64-bit fold of their parity bits.

1. One pass over the texts gives sets and parts; equal sets count once per task.
2. Parts are shuffled, packed by bucket. Sets that agree in a part form a group;
   groups with the same members are one.
3. Within groups short parity sketches are compared, in blocks, and only a spanning
   forest of the pairs within the bound is kept: a group of n sets gives less than n
   pairs. These are verified on the shingle sets.
4. What a failed pair may have hidden comes next: all pairs within the bound whose
   sets are still in different components are verified too.

Shingles are 55-bit hashes and sets are known by 64-bit sums of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.llm.arrays import mix, ranges, text_slices, word_hashes
from billshift.llm.components import components
from billshift.llm.places import with_places
from billshift.sources.writers import materialise

#: Words of a shingle; similarity from which sets link, as a fraction.
WORDS = 5
NUM, DEN = 80, 100
#: Rows of a slice: nine bits of a sort key number them.
_SLICE_ROWS = 512
_SLICE_BYTES = 1 << 20
#: Sets compared with each other at once; larger groups are compared block by block.
BLOCK = 1024


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, and how many each has.

    A text with fewer words is one shingle as a whole, one without words has none.
    At most ``_SLICE_ROWS`` texts.
    """
    hashes, counts = word_hashes(texts)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    full = np.where(counts >= words, counts - words + 1, 0)
    at = ranges(starts, full)
    value = np.zeros(len(at), np.uint64)
    for i in range(words):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[at + i] if i else hashes[at].copy()
    owner = np.repeat(np.arange(len(texts)), full)
    short = np.flatnonzero((counts > 0) & (counts < words))
    whole = np.zeros(len(short), np.uint64)
    for k in range(words - 1):  # word k of the short texts that have it
        have = counts[short] > k
        whole[have] = whole[have] * np.uint64(0x9E3779B97F4A7C15) + hashes[starts[short[have]] + k]
    whole += counts[short].astype(np.uint64)
    value = np.concatenate([mix(value), mix(whole + np.uint64(1))])
    owner = np.concatenate([owner, short]).astype(np.uint64)
    key = np.sort((owner << np.uint64(55)) | (value >> np.uint64(9)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    sizes = np.bincount((key >> np.uint64(55)).astype(np.int64), minlength=len(texts))
    return key & np.uint64((1 << 55) - 1), sizes


def _bands(most: int) -> np.ndarray:
    """Lower bounds of the size bands up to a size. Sets below 4 link to equal sets only."""
    low = [4]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, low[-1] * DEN // NUM + 1))
    return np.array(low + [max(low[-1] + 1, low[-1] * DEN // NUM + 1)])


def most_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Elements in which linked sets of sizes ``a`` and ``b`` may differ."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def signatures(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folds of the parts that each set enters in its band and the next, and their set's number.

    A part without shingles would join all sets that lack it. There are more parts
    than needed: linked sets agree in at least ``parts - most_apart`` of them, so a set
    with fewer empty parts than that shares a filled one with every partner. Only sets
    with more empty parts enter these too.
    """
    if sizes.sum() == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _bands(int(sizes.max()))
    own = np.searchsorted(low, sizes, side="right") - 1
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out, owners = [], []
    for step in (0, 1):
        reach = sizes * DEN // NUM
        sets = np.flatnonzero((own >= 0) & (reach >= low[np.minimum(own + step, len(low) - 1)]))
        if len(sets) == 0:
            continue
        band = own[sets] + step
        last = low[np.minimum(band + 1, len(low) - 1)] - 1
        widest = most_apart(last, last)
        parts = widest + 2 + widest // 10
        apart = most_apart(sizes[sets], np.minimum(reach[sets], last))
        first = np.concatenate([[0], np.cumsum(parts)])[:-1]
        items = x[ranges(starts[sets], sizes[sets])]
        salt = np.repeat(band, sizes[sets]).astype(np.uint64)
        part = (mix(items ^ (salt << np.uint64(56))) >> np.uint64(16)) % np.repeat(parts, sizes[sets]).astype(np.uint64)
        cell = np.repeat(first, sizes[sets]) + part.astype(np.int64)
        fold = np.zeros(int(parts.sum()), np.uint64)
        np.bitwise_xor.at(fold, cell, mix(items + np.uint64(0x5851F42D4C957F2D)))
        filled = np.bincount(cell, minlength=len(fold)) > 0
        empty = np.add.reduceat(~filled, first, dtype=np.int64)
        keep = filled | np.repeat(empty >= parts - apart, parts)
        number = np.arange(len(fold)) - np.repeat(first, parts)
        name = (np.repeat(band, parts).astype(np.uint64) << np.uint64(40)) | number.astype(np.uint64)
        out.append(mix(fold ^ mix(name + np.uint64(1)))[keep])
        owners.append(np.repeat(sets, parts)[keep])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def sketches(x: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Parity sketches of about two bits per shingle, a power of two and at least 64."""
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    place = (mix(x ^ np.uint64(0xA5A5A5A5)) >> np.uint64(8)) & np.repeat(bits - 1, sizes).astype(np.uint64)
    parity = np.bincount(np.repeat(first[:-1], sizes) + place.astype(np.int64), minlength=first[-1]) & 1
    packed = np.packbits(parity.astype(np.uint8), bitorder="little")
    return [packed[a // 8 : b // 8].tobytes() for a, b in zip(first[:-1], first[1:])]


_FIRST = "bucket int, parts binary, owners binary, doc_id long, n long, set_id long, sketch binary"
_SECOND = "is_doc boolean, doc_id long, n long, set_id long, sketch binary, grp long"


def _set_ids(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x + np.uint64(7)))])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return mix((total[ends[1:]] - total[ends[:-1]]) ^ (sizes.astype(np.uint64) << np.uint64(32))).view(np.int64)


def _first_pass(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(batch, size=_SLICE_BYTES, rows=_SLICE_ROWS):
                x, sizes = shingle_sets(part.column("text"))
                ids = _set_ids(x, sizes)
                new = np.zeros(len(ids), bool)
                for i, s in enumerate(ids.tolist()):
                    if sizes[i] and s not in seen:
                        seen.add(s)
                        new[i] = True
                drawn = [s if n else None for s, n in zip(sketches(x, sizes), new)]
                rows = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((ids.view(np.uint64) % np.uint64(buckets)).astype(np.int32)),
                        pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary()), part.column("doc_id"),
                        pa.array(sizes.astype(np.int64)), pa.array(ids), pa.array(drawn, pa.binary()),
                    ],
                    names=_names(_FIRST),
                )
                held = x[np.repeat(new, sizes)]
                sig, owner = signatures(held, sizes[new])
                yield pack(sig, ids[new][owner], buckets)
    return work


def pack(sig: np.ndarray, owner: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Signatures and owners as one row per bucket."""
    bucket = (sig % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    sig, owner, bucket = sig[order], owner[order], bucket[order]
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    ends = np.append(heads[1:], len(bucket))
    n = len(heads)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[heads], pa.int32()),
            pa.array([sig[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
            pa.array([owner[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
            *[pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())],
        ],
        names=_names(_FIRST),
    )


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def agreeing(parts: list[bytes], owners: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Groups (named by their members) of two and more owners with a signature in common."""
    sig = np.frombuffer(b"".join(parts), np.uint64)
    owner = np.frombuffer(b"".join(owners), np.int64)
    order = np.lexsort((owner, sig))
    sig, owner = sig[order], owner[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])
    sig, owner = sig[fresh], owner[fresh]
    heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
    sizes = np.diff(np.append(heads, len(sig)))
    many = sizes > 1
    heads, sizes = heads[many], sizes[many]
    if len(heads) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    members = owner[ranges(heads, sizes)]
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    name = mix(np.add.reduceat(mix(members.view(np.uint64)), begin) + sizes.astype(np.uint64))
    _, kept = np.unique(name, return_index=True)
    return np.repeat(name[kept].view(np.int64), sizes[kept]), members[ranges(begin[kept], sizes[kept])]


def _second_pass(table: pa.Table) -> pa.Table:
    docs = table.filter(table.column("parts").is_null())
    packed = table.filter(table.column("parts").is_valid())
    group, member = agreeing(packed.column("parts").to_pylist(), packed.column("owners").to_pylist())
    n, k = docs.num_rows, len(group)
    return pa.table(
        {
            "is_doc": pa.array(np.arange(n + k) < n),
            "doc_id": pa.concat_arrays([*docs.column("doc_id").chunks, pa.nulls(k, pa.int64())]),
            "n": pa.concat_arrays([*docs.column("n").chunks, pa.nulls(k, pa.int64())]),
            "set_id": pa.concat_arrays([*docs.column("set_id").chunks, pa.array(member, pa.int64())]),
            "sketch": pa.concat_arrays([*docs.column("sketch").chunks, pa.nulls(k, pa.binary())]),
            "grp": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(group, pa.int64())]),
        }
    )


def _close(sizes: np.ndarray, words: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` are within the sketch bound of ``i``."""
    apart = np.bitwise_count(words[others] ^ words[i]).sum(axis=1)
    return apart <= most_apart(sizes[i], sizes[others])


def _folded(drawn: list[bytes]) -> np.ndarray:
    """Sketches of one group at the length of the shortest: halves XORed together."""
    least = min(map(len, drawn))
    rows = []
    for s in drawn:
        row = np.frombuffer(s, np.uint64)
        while len(row) * 8 > least:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        rows.append(row)
    return np.stack(rows)


def forest(ids: np.ndarray, sizes: np.ndarray, drawn: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the bound."""
    words, left, edges = _folded(drawn), np.argsort(ids, kind="stable"), []
    while len(left):
        wave, left = [left[0]], left[1:]
        while wave and len(left):
            i = wave.pop()
            close = _close(sizes, words, i, left)
            found = left[close]
            edges += [(int(ids[i]), int(ids[j])) for j in found]
            wave += found.tolist()
            left = left[~close]
    return edges


def crossing(ids: np.ndarray, sizes: np.ndarray, drawn: list[bytes], label: np.ndarray) -> list[tuple[int, int]]:
    """All pairs within the bound whose labels differ."""
    if len(set(label.tolist())) < 2:
        return []
    words, edges = _folded(drawn), []
    for i in range(len(ids) - 1):
        others = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if len(others):
            edges += [(int(ids[i]), int(ids[j])) for j in others[_close(sizes, words, i, others)]]
    return edges


def _per_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of groups that arrive whole and in order; holds one group at a time."""
    tail: list[pa.RecordBatch] = []

    def keys(batch):
        return [np.asarray(batch.column(c)) for c in ("grp", "i", "j")]

    def pairs(rows: pa.Table) -> list[tuple[int, int]]:
        ids, sizes = np.asarray(rows.column("set_id")), np.asarray(rows.column("n"))
        drawn = rows.column("sketch").to_pylist()
        if "label" in rows.column_names:
            return crossing(ids, sizes, drawn, np.asarray(rows.column("label")))
        return forest(ids, sizes, drawn)

    def flush():
        edges = pairs(pa.Table.from_batches(tail)) if sum(t.num_rows for t in tail) > 1 else []
        return edges

    def emit(edges):
        low = [min(e) for e in edges]
        high = [max(e) for e in edges]
        return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        edges = []
        k = keys(batch)
        change = np.ones(batch.num_rows, bool)
        change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in k])
        if tail:
            change[0] = any(c[0] != t[-1] for c, t in zip(k, keys(tail[-1])))
        heads = np.flatnonzero(change)
        first = heads[0] if len(heads) else batch.num_rows
        if first:
            tail.append(batch.slice(0, first))
        for a, b in zip(heads, np.append(heads[1:], batch.num_rows)):
            edges += flush()
            tail[:] = [batch.slice(a, b - a)]
        yield emit(edges)
    if tail:
        yield emit(flush())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``a, b, left, right`` with sorted shingle sets; keeps the pairs that link."""
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        keep = []
        for i in range(batch.num_rows):
            x, y = np.asarray(left[i].values), np.asarray(right[i].values)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, size=_SLICE_BYTES, rows=_SLICE_ROWS):
            x, sizes = shingle_sets(part.column("text"))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_set_ids(x, sizes)), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.view(np.int64)))],
                names=["set_id", "shingles"],
            )


def _blocks(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of groups with size and sketch; a large group once per pair of its blocks."""
    count = groups.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, F.col("block")).alias("i"), F.greatest(other, F.col("block")).alias("j")),
    )
    placed = (
        groups.join(count.hint("merge"), "grp")
        .withColumn("block", block)
        .select("grp", "set_id", F.explode(pair).alias("pair"))
        .select("grp", "pair.i", "pair.j", "set_id")
    )
    return placed.join(sets.hint("merge"), "set_id")


def _candidates(members: DataFrame) -> DataFrame:
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = members.repartition(parts, "grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return ordered.mapInArrow(_per_group, "a long, b long").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that link, verified on the shingle sets of one document of each set."""
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = ids.join(sets.select("set_id", "rep").hint("merge"), "set_id").select("set_id", F.col("rep").alias("_rep"))
    texts = docs.select("doc_id", "text").join(
        wanted.select("_rep").distinct().hint("merge"), F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi"
    )
    # A repeated doc_id may bring other texts too; only wanted sets go on.
    full = texts.select("text").mapInArrow(_full_sets, "set_id long, shingles array<long>")
    full = materialise(full.join(wanted.select("set_id").hint("merge"), "set_id", "left_semi").dropDuplicates(["set_id"]), "jaccard-sets")
    sides = pairs.join(full.select(F.col("set_id").alias("a"), F.col("shingles").alias("left")).hint("merge"), "a").join(
        full.select(F.col("set_id").alias("b"), F.col("shingles").alias("right")).hint("merge"), "b"
    )
    return sides.select("a", "b", "left", "right").mapInArrow(_verify, "a long, b long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, set_id`` for every row of ``docs`` (``doc_id, text``).

    Documents link at 80 % similarity of their sets of five-word shingles (A-Z in
    lower case). ``component_id``: the smallest doc_id reachable by links, its own
    included. Texts that are null or without words have no shingles and link with
    nothing. Rows with equal sets link; repeated rows do too. A null doc_id counts
    as larger than any.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = source.mapInArrow(_first_pass(8 * parts), _FIRST)
    second = first.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_second_pass, _SECOND)
    second = materialise(second, "jaccard-groups")
    rows = second.where("is_doc").select("doc_id", "n", "set_id", "sketch")
    groups = second.where("not is_doc").select("grp", "set_id").distinct()
    sets = materialise(
        rows.where("n > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
        ),
        "jaccard-set-table",
    )
    members = materialise(_blocks(groups, sets.select("set_id", "n", "sketch")), "jaccard-members")
    tried = materialise(_candidates(members), "jaccard-tried")
    links = materialise(_linked(tried, sets, source), "jaccard-links")
    found = components(links)
    label = F.coalesce("label", "set_id").alias("label")
    labelled = members.join(found.withColumnRenamed("id", "set_id").hint("merge"), "set_id", "left")
    rest = _candidates(labelled.select("grp", "i", "j", "set_id", "n", "sketch", label))
    rest = materialise(rest.join(tried.hint("merge"), ["a", "b"], "left_anti"), "jaccard-rest")
    if rest.limit(1).count():
        more = _linked(rest, sets, source)
        links = materialise(links.union(more), "jaccard-links")
        found = components(links)
    least = found.join(sets.select(F.col("set_id").alias("id"), "rep").hint("merge"), "id")
    least = least.join(
        least.groupBy("label").agg(F.min("rep").alias("component")).hint("merge"), "label"
    ).select(F.col("id").alias("set_id"), "component")
    whole = sets.select("set_id", "rep").join(least.hint("merge"), "set_id", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component")
    )
    out = rows.select("doc_id", "n", "set_id").join(materialise(whole, "jaccard-components").hint("merge"), "set_id", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), "set_id",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with its smallest doc_id.

    Rows are told apart by their place, so a repeated or null doc_id is no matter: of rows
    with equal ids the first stays, a null id counts as larger than any. Documents
    without shingles stay. All columns are kept as they are.
    """
    place = unused(docs.columns, "_place")
    rows = with_places(docs, place)
    judged = jaccard_components(rows.select(F.col(place).alias("doc_id"), "text"))
    # With the real ids, and one row per component: rows of a large component are not joined.
    ids = rows.select(F.col(place).alias("place"), F.col("doc_id").alias("id"))
    judged = judged.select(F.col("doc_id").alias("place"), "component_id").join(ids.hint("merge"), "place")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place"))
    kept = judged.groupBy("component_id").agg(first.alias("first")).select(F.col("first.place").alias(place))
    return rows.join(kept.hint("merge"), place, "left_semi").select(*docs.columns)
