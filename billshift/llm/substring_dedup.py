"""Near-duplicate passages across documents, by compact windows.

A document is its sequence of five-word shingles. For one hash function the
sub-sequences of at least ``WIDTH`` shingles fall into compact windows (l, c, r): all
that reach from [l, c] to [c, r] have their minimum at c. The windows are the nodes,
wide enough, of the sequence's Cartesian tree. Two passages with similarity J have
the same minimum with probability J, equal passages always.

1. At 0.8 a passage holds ``STRETCH`` equal shingles in a row. The windows are taken over the hashes
   of the runs of ``SHORT`` shingles, as wide as such a stretch; the run at a window's minimum is a
   key. Equal stretches have the same windows, so passages always meet (``stretch_keys``);
   documents that share a line shorter than the run do not.
2. Keys are shuffled, packed by bucket; documents that share a key form a group.
3. In each group documents are compared with one leader. Candidate pairs are
   verified on their shingle sequences: matches are chained along the diagonal and a
   chain counts if both sides are wide enough and similar at 0.8 or more, also after what differs
   beside it has made it wide enough.
4. Places that a passage verified with a leader of the group covers are settled. What is left is searched in
   one task for all groups of a leader, or more for many (``partners``): each place meets the other rows of its group, by counts of
   equal shingles along the two (``reach``), and pairs that may share a passage there are verified until one covers it.
   Very large groups are dealt into smaller ones first, by the shingles beside the key that the leader does not
   have (``_context_keys``): rows that can share a passage there share one of them, rows that share a line do not.

Not compared: two rows of a group that are both settled. Passages keep the order of their
words, and of shingles that repeat within one the nearest are chained.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift.llm.arrays import mix, ranges, text_slices, word_hashes
from billshift.llm.components import components
from billshift.sources.writers import materialise

WORDS = 5
#: Words of a passage at least, and its shingles.
PASSAGE = 50
WIDTH = PASSAGE - WORDS + 1
NUM, DEN = 80, 100
#: Hash functions; a passage is met where any of them has the same minimum and run: equal
#: ones always, 50 words with one changed in 94 % of cases, longer ones more often.
HASHES = 3
#: Shingles in a row that must be equal next to a minimum. At most WIDTH / 2, so that
#: equal passages always meet. A lower value meets more passages with a change inside,
#: and more documents that share a line only.
RUN = 18
#: Equal shingles in a row that a passage at the threshold has: at 0.8 the shingles that differ on
#: both sides are at most a quarter of the equal ones. Where equal stretches part, at least 8 differ (four
#: on each side), so of 46 shingles 41 are equal in two stretches at most, and in wider
#: passages the longest is longer.
STRETCH = 21
#: Shingles of a key. Documents that share a shorter line only do not meet; a lower value gives fewer keys.
SHORT = 14
#: Equal shingles of two passages at the threshold, at least: with fewer the widths cannot both be ``WIDTH``.
LEAST = -(-NUM * 2 * WIDTH // (DEN + NUM))
#: Shingles a chain may skip, and the shift it may take there.
GAP = 16
#: Shingles beside a key, on either side, among which rows of a group that share a passage there have
#: ``LEAST`` in common: the rest of a stretch with the key, a gap, and what the next stretch must add.
BESIDE = LEAST - SHORT + GAP
#: Rows of a group that one task searches; those of a larger one are dealt by what stands beside the key.
LARGE = 100_000
#: Documents with open rows that a task compares with the others of their groups, about.
SHARE = 512
_SLICE_BYTES = 1 << 20

_FIRST = "bucket int, keys binary, owners binary, places binary, doc_id long, n_words long, seq_id long"
_SECOND = "is_doc boolean, doc_id long, n_words long, seq_id long, grp long, at int"


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all texts in order, how many each has, and its words (A-Z in lower case)."""
    hashes, counts = word_hashes(texts)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    full = np.maximum(counts - WORDS + 1, 0)
    at = ranges(starts, full)
    value = np.zeros(len(at), np.uint64)
    for i in range(WORDS):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[at + i]
    return mix(value), full, counts


def sequence_ids(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of every sequence."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    place = ranges(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ mix(place + np.uint64(11))))])
    return mix((total[ends[1:]] - total[ends[:-1]]) ^ (sizes.astype(np.uint64) << np.uint64(32))).view(np.int64)


def _sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: done - width], x[width - done :]) if done < width else x


def compact_windows(
    values: np.ndarray, inside: np.ndarray, run: int = RUN, width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """Minima of the compact windows, all sequences at once: those whose window reaches
    ``run`` places on, and those whose window reaches as far back, themselves counted.

    The nodes of the Cartesian tree that span ``width`` are its top; their minima are
    just the places that are least in some passage of that width (all of equal ones). So
    the narrow nodes below need not be built. ``inside``: places where a passage of that
    width begins that stays in its sequence.
    """
    n = len(values)
    if n < width:
        return (np.zeros(0, np.int64),) * 2
    least = np.zeros(n, np.uint64)
    least[: n - width + 1] = np.where(inside[: n - width + 1], _sliding(np.minimum, values, width), np.uint64(0))
    # Greatest of the minima of the passages that hold the run which begins at a place.
    among = width - run + 1
    held = _sliding(np.maximum, np.concatenate([np.zeros(among - 1, np.uint64), least]), among)
    begins = held == values
    ends = held[: n - run + 1] == values[run - 1 :]
    return np.flatnonzero(begins), np.flatnonzero(ends) + run - 1


def window_keys(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys by the minima of ``HASHES`` functions, which most passages share; ``stretch_keys`` all share.

    Keys of sequences, the number of the sequence of each, and the place of a minimum there.

    A key is the ``RUN`` shingles that begin or end at the minimum of a window, as far as
    they are in the window. A passage of full width around a minimum holds one of the two.
    """
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(shingles)) - first[owner] + WIDTH <= sizes[owner]
    starts, places = [], []
    for k in range(HASHES):
        values = mix(shingles ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        begins, ends = compact_windows(values, inside)
        starts += [begins, ends - RUN + 1]
        places += [begins, ends]
    start, kept = np.unique(np.concatenate(starts), return_index=True)
    place = np.concatenate(places)[kept]
    key = np.zeros(len(start), np.uint64)
    for i in range(RUN):
        key = key * np.uint64(0x9E3779B97F4A7C15) + shingles[start + i]
    key, owner = mix(key), owner[start]
    # Repetition gives a sequence the same key many times.
    order = np.lexsort((key, owner))
    key, owner, place = key[order], owner[order], place[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return key[fresh], owner[fresh], (place - first[owner])[fresh]


def stretch_keys(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``window_keys``, such that sequences with ``STRETCH`` equal shingles in a row share a key, always.

    A key is a run of ``SHORT`` shingles, the least by hash in a compact window of as many runs as
    begin in such a stretch with room for them: an equal stretch has the same windows. A key that a
    sequence repeats is given again ``WIDTH`` places on, or further: it has other neighbours there.
    """
    first, n = np.cumsum(sizes) - sizes, len(shingles)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    runs = max(n - SHORT + 1, 0)
    value = np.zeros(runs, np.uint64)
    for i in range(SHORT):
        value = value * np.uint64(0x9E3779B97F4A7C15) + shingles[i : i + runs]
    value = mix(value)
    # Zero bars a place: windows of a stretch that leaves its sequence are not ``inside``.
    inside = np.arange(runs) - first[owner[:runs]] + STRETCH <= sizes[owner[:runs]]
    place, _ = compact_windows(np.maximum(value, np.uint64(1)), inside, 1, STRETCH - SHORT + 1)
    key, owner = value[place], owner[place]
    place = place - first[owner]
    order = np.lexsort((place, key, owner))
    key, owner, place = key[order], owner[order], place[order]
    fresh = _spaced(key, owner, place)
    return key[fresh], owner[fresh], place[fresh]


def _spaced(key: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of sorted places of the same key and owner the first in each stretch of ``WIDTH`` places, and the first."""
    other = np.ones(len(key), bool)
    other[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    start = place[np.flatnonzero(other)][np.cumsum(other) - 1] if len(key) else place
    stretch = (place - start) // WIDTH
    other[1:] |= stretch[1:] != stretch[:-1]
    return other


def _first_pass(buckets: int):
    names = [f.split()[0] for f in _FIRST.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(batch, size=_SLICE_BYTES):
                shingles, sizes, words = sequences(part.column("text"))
                ids = sequence_ids(shingles, sizes)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((ids.view(np.uint64) % np.uint64(buckets)).astype(np.int32)),
                        *[pa.nulls(n, pa.binary())] * 3,
                        part.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(ids),
                    ],
                    names=names,
                )
                take = []
                for i in np.flatnonzero(sizes >= WIDTH).tolist():
                    if int(ids[i]) not in seen:
                        seen.add(int(ids[i]))
                        take.append(i)
                if not take:
                    continue
                starts, some = (np.cumsum(sizes) - sizes)[take], sizes[take]
                key, owner, place = stretch_keys(shingles[ranges(starts, some)], some)
                owner = ids[take][owner]
                bucket = (key % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                key, owner, place, bucket = key[order], owner[order], place[order].astype(np.int32), bucket[order]
                heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                cuts = list(zip(heads, np.append(heads[1:], len(bucket))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[heads]),
                        *[pa.array([c[a:b].tobytes() for a, b in cuts], pa.binary()) for c in (key, owner, place)],
                        *[pa.nulls(len(heads), pa.int64())] * 3,
                    ],
                    names=names,
                )
    return work


def _second_pass(table: pa.Table) -> pa.Table:
    """Documents as they are; of the keys those that several sequences share."""
    packed = table.filter(table.column("keys").is_valid())
    docs = table.filter(table.column("keys").is_null())
    key, owner, place = (
        np.frombuffer(b"".join(packed.column(c).to_pylist()), t)
        for c, t in (("keys", np.uint64), ("owners", np.int64), ("places", np.int32))
    )
    order = np.lexsort((place, owner, key))
    key, owner, place = key[order], owner[order], place[order]
    # A sequence may come from several tasks.
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    key, owner, place = key[fresh], owner[fresh], place[fresh]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(key)))
    shared = np.repeat(owner[heads] != owner[heads + sizes - 1], sizes)
    key, owner, place = key[shared].view(np.int64), owner[shared], place[shared]
    n, k = docs.num_rows, len(key)
    joined = lambda c, rest: pa.concat_arrays([*docs.column(c).chunks, rest])
    return pa.table(
        {
            "is_doc": pa.array(np.arange(n + k) < n),
            "doc_id": joined("doc_id", pa.nulls(k, pa.int64())),
            "n_words": joined("n_words", pa.nulls(k, pa.int64())),
            "seq_id": joined("seq_id", pa.array(owner, pa.int64())),
            "grp": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(key, pa.int64())]),
            "at": pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(place, pa.int32())]),
        }
    )


_CONTEXTS = "bucket int, keys binary, owners binary"


def context_features(
    context: pa.ListArray, key_at: np.ndarray, leading: pa.ListArray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and shingles such that two rows of a group that share a passage there share one of them.

    Rows that share a passage have ``_common`` shingles in common, so of a row's different shingles all but
    as many less one do, in an order of its group: those that its leader does not have (``leading``)
    come first. What all rows have in common is left out that way, if it is no passage.
    ``key_at``: where the key begins in the context.
    """
    def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.diff(np.asarray(lists.offsets))
        values = np.asarray(lists.flatten()).astype(np.int32).view(np.uint32).astype(np.uint64)
        return np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << np.uint64(32), values, sizes

    of, values, sizes = flat(context)
    least = _common(values, sizes, key_at)
    own = np.unique(of | values)
    of, values, _ = flat(leading)
    late = np.isin(own, of | values).astype(np.uint64)
    row, value = own >> np.uint64(32), own & np.uint64(0xFFFFFFFF)
    # An odd factor deals the shingles and keeps them apart.
    order = np.argsort((row << np.uint64(33)) | (late << np.uint64(32)) | (value * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)))
    row, value = row[order].astype(np.int64), value[order]
    kinds = np.bincount(row, minlength=len(sizes))
    rank = np.arange(len(row)) - (np.cumsum(kinds) - kinds)[row]
    kept = rank <= (kinds - least)[row]
    return row[kept], value[kept]


def _common(values: np.ndarray, sizes: np.ndarray, key_at: np.ndarray) -> np.ndarray:
    """Different shingles that each context has in common with others it shares a passage with around the key, at least.

    ``LEAST`` of them are equal, and repeated ones may stand for as many; and 0.8 of the different
    ones of any ``WIDTH`` places around the key.
    """
    own = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    # Only contexts that repeat a shingle are looked at closer.
    order = np.lexsort((values, own))
    same = np.zeros(len(own), bool)
    same[1:] = (own[order][1:] == own[order][:-1]) & (values[order][1:] == values[order][:-1])
    repeats = np.bincount(own[order][same], minlength=len(sizes))
    least = np.full(len(sizes), LEAST)
    some = np.flatnonzero(repeats)
    if len(some) == 0:
        return least
    values, key_at, repeats = values[(repeats > 0)[own]], key_at[some], repeats[some]
    sizes = sizes[some]
    wide = int(sizes.max())
    column = ranges(np.zeros(len(sizes), np.int64), sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    # The place of the same shingle before, -1 for none; beyond the end none is new.
    before = np.full((len(sizes), wide), wide, np.int64)
    order = np.lexsort((column, values, row))
    r, v, c = row[order], values[order], column[order]
    same = np.zeros(len(r), bool)
    same[1:] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    before[r, c] = np.where(same, np.concatenate([[0], c[:-1]]), -1)
    fewest = sizes - repeats
    for start in range(max(wide - WIDTH + 1, 0)):
        around = (start <= key_at) & (key_at + SHORT <= start + WIDTH) & (start + WIDTH <= sizes)
        if around.any():
            n = (before[around, start : start + WIDTH] < start).sum(axis=1)
            fewest[around] = np.minimum(fewest[around], n)
    least[some] = np.maximum(np.maximum(LEAST - repeats, -(-NUM * fewest // DEN)), 1)
    return least


def _context_keys(buckets: int):
    """Keys of each row by ``context_features``, packed by bucket; an owner's last bit tells that it is settled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, value = context_features(
                batch.column("context"), np.minimum(np.asarray(batch.column("at")), BESIDE), batch.column("leading")
            )
            grp = np.asarray(batch.column("grp")).view(np.uint64)[row]
            owner = np.asarray(batch.column("owner"))[row]
            key = mix(grp ^ mix(value + np.uint64(1)))
            # Most keys of a group in one task, which knows those that the same rows share.
            bucket = (mix(grp + key % np.uint64(4)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            key, owner, bucket = key[order], owner[order], bucket[order]
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            cuts = list(zip(heads, np.append(heads[1:], len(bucket))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[heads]), *[pa.array([c[a:b].tobytes() for a, b in cuts], pa.binary()) for c in (key, owner)]],
                names=["bucket", "keys", "owners"],
            )
    return work


def _shared_contexts(table: pa.Table) -> pa.Table:
    """Groups of the rows that share a key, one of them open at least; keys of the same rows make one group."""
    key = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    owner = np.frombuffer(b"".join(table.column("owners").to_pylist()), np.int64)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    alike = key[1:] == key[:-1]
    shared = np.concatenate([[False], alike]) | np.concatenate([alike, [False]])
    key, owner = key[shared], owner[shared]
    if len(key) == 0:
        return pa.table({"grp": pa.array([], pa.int64()), "owner": pa.array([], pa.int64())})
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(heads, len(key)))
    name = np.add.reduceat(mix(owner.view(np.uint64)), heads)
    kept = np.add.reduceat((owner & 1) == 0, heads, dtype=np.int64) > 0
    _, first = np.unique(name, return_index=True)
    kept &= np.isin(np.arange(len(heads)), first)
    rows = ranges(heads[kept], sizes[kept])
    return pa.table({"grp": pa.array(np.repeat(mix(name[kept]), sizes[kept]).view(np.int64)), "owner": pa.array(owner[rows])})


def _news(values: np.ndarray) -> np.ndarray:
    """How many shingles that the ``WIDTH`` places before do not have stand before each place, and before the end."""
    order = np.argsort(values, kind="stable")
    new = np.ones(len(values), np.int64)
    again = np.flatnonzero((values[order][1:] == values[order][:-1]) & (np.diff(order) < WIDTH))
    new[order[again + 1]] = 0
    return np.concatenate([[0], np.cumsum(new)])


def _last(values: np.ndarray) -> np.ndarray:
    """Where each shingle was before, -1 for nowhere."""
    order = np.argsort(values, kind="stable")
    same = np.flatnonzero(values[order][1:] == values[order][:-1])
    out = np.full(len(values), -1)
    out[order[same + 1]] = order[same]
    return out


def _single(values: np.ndarray) -> np.ndarray:
    """Which shingles stand at one place only."""
    order = np.argsort(values, kind="stable")
    same = np.concatenate([[False], values[order][1:] == values[order][:-1], [False]])
    out = np.empty(len(values), bool)
    out[order] = ~(same[1:] | same[:-1])
    return out


def reach(pair: np.ndarray, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Which matching places a passage may cover, for many pairs at once, without a search for chains.

    ``pair``: number of the pair, in order; ``i``: places of a sequence whose shingle the other has; ``j``: where
    the other has it; ``left``, ``right``: ``_news`` of the sequences, in which ``i`` and ``j`` are places. ``sure``:
    either has it at one place only. At 0.8 a passage has four matches for each shingle that differs, on either
    side; a step back or wider than a gap counts as none, as one that is not sure. Exact where no shingle repeats.
    """
    same = pair[1:] == pair[:-1]
    step = j[1:] - j[:-1]
    differ = left[i[1:]] - left[np.minimum(i[:-1] + 1, i[1:])]
    # Of one pair ``right`` never falls.
    differ = differ + np.where(same & sure[1:] & sure[:-1] & (step > 0) & (step <= GAP + 1), right[j[1:]] - right[j[:-1] + 1], 0)
    # Each pair starts below all of the pairs before it, so that no passage begins there.
    gain = np.where(same, left[i[1:] + 1] - left[i[1:]] - 4 * differ, 0)
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    score = np.concatenate([[0], np.cumsum(gain)])
    span = int(score.max() - score.min()) + 2
    score = score - span * pair
    begin = np.searchsorted(-np.minimum.accumulate(score), -(score + 1))
    begin = np.maximum(begin, np.repeat(heads, np.diff(np.append(heads, len(i)))))
    # A passage spans so many places, all of them matches where none repeats.
    plain = np.repeat(np.logical_and.reduceat(sure, heads), np.diff(np.append(heads, len(i))))
    ends = np.flatnonzero((i - i[begin] >= LEAST - 1) & (~plain | (np.arange(len(i)) - begin >= LEAST - 1)))
    opened = np.bincount(begin[ends], minlength=len(i)) - np.bincount(ends + 1, minlength=len(i) + 1)[:-1]
    return np.cumsum(opened) > 0


class _Documents:
    """Documents of one task, and the places in them that are compared with other documents."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, sizes: np.ndarray):
        self.ids, self.values, self.sizes = ids, values, sizes
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(values, kind="stable")
        fresh = np.concatenate([[True], values[order][1:] != values[order][:-1]])
        self.code = np.empty(len(values), np.int32)
        self.code[order] = np.cumsum(fresh) - 1
        owner = np.repeat(np.arange(len(ids)), sizes)[order]
        heads = np.flatnonzero(fresh)
        #: Shingles that several documents have.
        self.shared = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
        self.place = np.full(len(heads), -1, np.int32)
        self.different: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def codes(self, x: int) -> np.ndarray:
        return self.code[self.ends[x] : self.ends[x + 1]]

    def news(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        if x not in self.different:
            self.different[x] = _news(self.codes(x)), _single(self.codes(x))
        return self.different[x]

    def beside(self, x: int, at: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Which rows of ``marks``, places of ``x`` each, have at each of ``at`` what a passage has beside a key, at least.

        As ``_common``: so many different shingles.
        """
        size = int(self.sizes[x])
        low, high = np.maximum(at - BESIDE, 0), np.minimum(at + SHORT + BESIDE, size)
        total = np.zeros((len(marks), size + 1), np.int32)
        np.cumsum(marks, axis=1, out=total[:, 1:])
        counts = total[:, high] - total[:, low]
        if self.news(x)[1].all():
            return counts >= LEAST
        own, least = self.codes(x), np.full(len(at), LEAST)
        last = _last(own)
        for k, (a, b, key) in enumerate(zip(low.tolist(), high.tolist(), at.tolist())):
            new = last[a:b] < a
            if new.all():
                continue
            counts[:, k] = np.count_nonzero(marks[:, a:b] & new, axis=1)
            starts = np.arange(max(a, key + SHORT - WIDTH), min(key, b - WIDTH) + 1)
            fewest = (last[starts[:, None] + np.arange(WIDTH)] < starts[:, None]).sum(axis=1).min()
            least[k] = max(LEAST - np.count_nonzero(~new), -(-NUM * int(fewest) // DEN), 1)
        return counts >= least

    def near(self, x: int, at: np.ndarray, others: np.ndarray, meet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Those of ``others`` that may share a passage with ``x`` at one of ``at``, and which of these, a block at a time.

        ``meet``: which of ``others`` are compared at each of ``at``.
        """
        own, size = self.codes(x), int(self.sizes[x])
        left, mine = self.news(x)
        block = max(8, min(256, (1 << 19) // size))
        for start in range(0, len(others), block):
            some = others[start : start + block]
            lengths = self.sizes[some]
            self.place[own[::-1]] = np.arange(size, dtype=np.int32)[::-1]
            first, found = self.place[own], self.place[self.code[ranges(self.ends[some], lengths)]]
            self.place[own] = -1
            hits = np.zeros((len(some), size + 1), bool)
            hits[np.repeat(np.arange(len(some)), lengths), found] = True
            marks = hits[:, first]
            kept = np.flatnonzero((self.beside(x, at, marks) & meet[start : start + block]).any(axis=1))
            if len(kept) == 0:
                continue
            # Where the others have each shingle of ``x`` first, in all that is kept.
            ends = np.concatenate([[0], np.cumsum(lengths)])
            found = found[ranges(ends[kept], lengths[kept])]
            row = np.repeat(np.arange(len(kept)), lengths[kept])
            where = np.zeros((len(kept), size + 1), np.int64)
            where[row[::-1], found[::-1]] = np.arange(len(found))[::-1]
            pair, i = np.nonzero(marks[kept])
            j = where[pair, first[i]]
            news = [self.news(y) for y in some[kept].tolist()]
            right = np.concatenate([n[:-1] for n, _ in news] + [[0]])
            theirs = np.concatenate([s for _, s in news])
            covered = np.zeros((len(kept), size), bool)
            covered[pair, i] = reach(pair, i, j, left, right, mine[i] & theirs[j])
            may = covered[:, at] & meet[start + kept]
            if may.any():
                yield some[kept], may

    def sequence(self, x: int) -> np.ndarray:
        return self.values[self.ends[x] : self.ends[x + 1]]


def _by(values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different values in order, and the places of each."""
    kinds, first = np.unique(values[(order := np.argsort(values, kind="stable"))], return_index=True)
    return kinds, np.split(order, first[1:])


def partners(docs: _Documents, doc: np.ndarray, grp: np.ndarray, at: np.ndarray, open_: np.ndarray, leader: int) -> list[tuple[int, int, int, int]]:
    """Passages of the open rows and of other rows of their groups, until each is covered or has met all.

    A row is a key: its document, group and place. ``leader``: the sequence that all have been compared with.
    """
    out, open_ = [], open_.copy()
    _, group = np.unique(grp, return_inverse=True)
    members = [np.unique(doc[rows]) for rows in _by(group)[1]]
    holds = lambda g, y: members[g][min(np.searchsorted(members[g], y), len(members[g]) - 1)] == y
    rows_of = dict(zip(*(x if isinstance(x, list) else x.tolist() for x in _by(doc))))
    for x, rows in rows_of.items():
        rows = rows[open_[rows]]
        if len(rows):
            # Shingles that no other document has are in no passage.
            rows = rows[docs.beside(x, at[rows], docs.shared[docs.codes(x)][None, :])[0]]
        if len(rows) == 0:
            continue
        others = np.unique(np.concatenate([members[g] for g in group[rows].tolist()]))
        others = others[(others != x) & (docs.ids[others] != leader)]
        meet = np.stack([np.isin(others, members[g], assume_unique=True) for g in group[rows].tolist()], axis=1)
        for some, may in docs.near(x, at[rows], others, meet):
            # Those that may cover most first.
            while len(some) and open_[rows].any():
                most = np.count_nonzero(may & open_[rows], axis=1)
                k = int(most.argmax())
                if most[k] == 0:
                    break
                y, may[k] = int(some[k]), False
                theirs = np.array([r for r in rows_of[y].tolist() if open_[r] and holds(group[r], x)], np.int64)
                mine = rows[meet[np.searchsorted(others, y)]]
                for i0, i1, j0, j1 in passages(docs.sequence(x), docs.sequence(y)):
                    out += [(docs.ids[x], docs.ids[y], i0, i1), (docs.ids[y], docs.ids[x], j0, j1)]
                    open_[mine] &= (at[mine] < i0) | (at[mine] > i1)
                    open_[theirs] &= (at[theirs] < j0) | (at[theirs] > j1)
            if not open_[rows].any():
                break
    return out


def _partners(table: pa.Table) -> pa.Table:
    """Passages of ``partners``, a unit of documents at a time."""
    table = table.sort_by([("unit", "ascending"), ("seq_id", "ascending")])
    unit = table.column("unit").to_numpy()
    heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]])) if len(unit) else np.zeros(0, np.int64)
    found = []
    for a, b in zip(heads.tolist(), np.append(heads[1:], len(unit)).tolist()):
        part = table.slice(a, b - a).combine_chunks()
        shingles, grps = (part.column(c).combine_chunks() for c in ("shingles", "grps"))
        sizes, rows = (np.asarray(x.value_lengths()).astype(np.int64) for x in (shingles, grps))
        docs = _Documents(part.column("seq_id").to_numpy(), np.asarray(shingles.flatten()), sizes)
        at, open_ = (np.asarray(part.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)) for c in ("ats", "opens"))
        found += partners(docs, np.repeat(np.arange(b - a), rows), np.asarray(grps.flatten()), at.astype(np.int64), open_.astype(bool), int(part.column("leader")[0].as_py()))
    return _spans(found)


def _spans(found: list[tuple[int, int, int, int]]) -> pa.Table:
    columns = list(zip(*found)) or [[]] * 4
    return pa.table({c: pa.array(x, t) for c, x, t in zip(("seq_id", "other", "first", "last"), columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))})


def _wide_runs(matched: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matching places of ``b`` without those that no passage can hold.

    A passage lies in a run of places with gaps of at most ``GAP``, as wide as a passage.
    Where the run repeats no shingle, similarity also asks for so many matches.
    """
    cuts = np.flatnonzero(np.diff(matched) > GAP + 1) + 1
    kept = [np.zeros(0, np.int64)]
    for run in np.split(matched, cuts) if len(matched) else ():
        wide = run[-1] - run[0] + 1
        if wide < LEAST:
            continue
        if len(run) >= LEAST or len(np.unique(b[run[0] : run[-1] + 1])) < wide:
            kept.append(run)
    return np.concatenate(kept)


def _chains(a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matching places of two sequences, as chains near one diagonal, in the order of ``b``."""
    order = np.argsort(a, kind="stable")
    ordered = a[order]
    low, high = np.searchsorted(ordered, b), np.searchsorted(ordered, b, side="right")
    places = _wide_runs(np.flatnonzero(high > low), b)
    if len(places) == 0:
        return []
    if (high[places] - low[places] == 1).all():
        return _chained_stretches(order[low[places]], places)
    chains: list[list[tuple[int, int]]] = []
    at, low, high = order.tolist(), low.tolist(), high.tolist()
    for j in places.tolist():
        for chain in reversed(chains[-4:]):
            i0, j0 = chain[-1]
            if j - j0 > GAP + 1:
                continue
            # The place nearest to the diagonal, of those within a gap.
            same = i0 + j - j0
            k = bisect_left(at, same, low[j], high[j])
            near = [i for i in at[max(k - 1, low[j]) : min(k + 1, high[j])] if i0 < i <= i0 + GAP + 1]
            if near:
                chain.append((min(near, key=lambda i: abs(i - same)), j))
                break
        else:
            chains.append([(at[low[j]], j)])
    return [tuple(np.array(x) for x in zip(*c)) for c in chains if len(c) > 1]


def _chained_stretches(i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same where each place matches one other: stretches of equal shingles are linked."""
    cuts = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1
    heads, tails = np.append(0, cuts), np.append(cuts, len(i))
    chains: list[list[int]] = []
    for k, (x, y) in enumerate(zip(i[heads].tolist(), j[heads].tolist())):
        for chain in reversed(chains[-4:]):
            end = tails[chain[-1]] - 1
            di, dj = x - i[end], y - j[end]
            if 0 < di <= GAP + 1 and dj <= GAP + 1 and abs(di - dj) <= GAP:
                chain.append(k)
                break
        else:
            chains.append([k])
    whole = [np.concatenate([np.arange(heads[k], tails[k]) for k in chain]) for chain in chains]
    return [(i[w], j[w]) for w in whole if len(w) > 1]


def passages(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Near-duplicate passages: (first, last) shingle in ``a``, then in ``b``.

    Parts of a chain that are not alike when it is cut at its gaps are searched for any that are.
    """
    out: list[tuple[int, int, int, int]] = []
    chains = _chains(a, b)
    likeness = _likeness(a, b) if chains else None
    for chain in chains:
        found, rest = _halved(likeness, chain)
        out += found
        for i, j in rest:
            out += _any_alike(a, b, i, j)
    return out


def _likeness(a: np.ndarray, b: np.ndarray):
    """A function of ranges of both: how many different shingles each has, and how many are in both."""
    def befores(values: np.ndarray, order: np.ndarray) -> np.ndarray:
        out, ordered = np.full(len(values), -1), values[order]
        same = np.flatnonzero(ordered[1:] == ordered[:-1])
        out[order[same + 1]] = order[same]
        return out

    order = np.argsort(a, kind="stable")
    ordered = a[order]
    before_a, before_b = befores(a, order), befores(b, np.argsort(b, kind="stable"))
    low, high = np.searchsorted(ordered, b), np.searchsorted(ordered, b, side="right")
    # Where each shingle of ``b`` stands in ``a``, if at one place only.
    once, often = np.append(order, -1)[low], high - low > 1
    once[high - low != 1] = -1

    def likeness(i0: int, i1: int, j0: int, j1: int) -> tuple[int, int, int]:
        new = before_b[j0 : j1 + 1] < j0
        at = once[j0 : j1 + 1]
        both = np.count_nonzero(new & (at >= i0) & (at <= i1))
        for j in (np.flatnonzero(new & often[j0 : j1 + 1]) + j0).tolist():
            places = order[low[j] : high[j]]
            first = int(np.searchsorted(places, i0))
            both += first < len(places) and places[first] <= i1
        return np.count_nonzero(before_a[i0 : i1 + 1] < i0), np.count_nonzero(new), int(both)
    return likeness


def _halved(likeness, chain: tuple[np.ndarray, np.ndarray]) -> tuple[list, list]:
    """Passages of a chain that is cut at its widest gaps until the parts are alike, and the parts beside them."""
    out, rest, open_ = [], [], [chain]
    while open_:
        i, j = open_.pop()
        if min(i[-1] - i[0], j[-1] - j[0]) + 1 < WIDTH:
            # Parts come from the last to the first; those side by side are one again.
            if rest and rest[-1][2]:
                rest[-1] = (np.concatenate([i, rest[-1][0]]), np.concatenate([j, rest[-1][1]]), True)
            else:
                rest.append((i, j, True))
            continue
        left, right, both = likeness(int(i[0]), int(i[-1]), int(j[0]), int(j[-1]))
        if DEN * both >= NUM * (left + right - both):
            out.append((int(i[0]), int(i[-1]), int(j[0]), int(j[-1])))
            rest = [(*part[:2], False) for part in rest]
            continue
        # Not alike as a whole: cut at the widest gap and try both parts.
        cut = int(np.argmax(i[1:] - i[:-1] + j[1:] - j[:-1])) + 1
        open_ += [(i[:cut], j[:cut]), (i[cut:], j[cut:])]
    return out, [part[:2] for part in rest]


def _any_alike(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Passages from the begin of one equal stretch of a chain to the end of another, the widest from each begin.

    Narrower ones are widened by what differs beside them. A passage that ends within a stretch
    is no more alike than one that goes on to its end.
    """
    if len(i) < 2 or len(i) < LEAST and len(np.unique(b[j[0] : j[-1] + 1])) == j[-1] - j[0] + 1:
        return []
    cuts = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1
    heads, tails = np.append(0, cuts), np.append(cuts, len(i)) - 1
    x, y = a[i[0] : i[-1] + 1], b[j[0] : j[-1] + 1]
    repeats = len(np.unique(x)) < len(x) or len(np.unique(y)) < len(y)
    if not repeats:
        # The widest alike from each begin, all at once.
        left, right = i[tails] - i[heads][:, None] + 1, j[tails] - j[heads][:, None] + 1
        both = tails - heads[:, None] + 1
        sides = np.maximum(left, WIDTH) + np.maximum(right, WIDTH)
        alike = (both > 0) & (DEN * both >= NUM * (sides - both))
        if not alike.any():
            return []
        ends = np.where(alike.any(axis=1), len(tails) - 1 - alike[:, ::-1].argmax(axis=1), -1)
        best = np.concatenate([[-1], np.maximum.accumulate(ends)[:-1]])
        return [
            (*_widened(i[heads[k]], i[tails[ends[k]]], len(a)), *_widened(j[heads[k]], j[tails[ends[k]]], len(b)))
            for k in np.flatnonzero(ends > best).tolist()
        ]
    out, covered = [], -1
    for s, head in enumerate(heads.tolist()):
        ends = tails[s:]
        both, left, right = _distinct(a, b, i, j, head, ends)
        # Where it is narrower than a passage, what it is widened by counts as different.
        left = left + np.maximum(WIDTH - (i[ends] - i[head] + 1), 0)
        right = right + np.maximum(WIDTH - (j[ends] - j[head] + 1), 0)
        alike = np.flatnonzero(DEN * both >= NUM * (left + right - both))
        if len(alike) and ends[alike[-1]] > covered:
            covered = ends[alike[-1]]
            out.append((*_widened(i[head], i[covered], len(a)), *_widened(j[head], j[covered], len(b))))
    return out


def _distinct(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, head: int, ends: np.ndarray) -> tuple:
    """Different shingles from one place of a chain to each of ``ends``: in both, in ``a``, in ``b``."""
    sides = []
    for values, at in ((a, i), (b, j)):
        kinds, first = np.unique(values[at[head] : at[ends[-1]] + 1], return_index=True)
        sides.append((kinds, np.searchsorted(at[ends] - at[head], first)))
    _, p, q = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
    count = lambda at: np.cumsum(np.bincount(at, minlength=len(ends)))
    return count(np.maximum(sides[0][1][p], sides[1][1][q])), count(sides[0][1]), count(sides[1][1])


def _widened(first: int, last: int, size: int) -> tuple[int, int]:
    """The range, as wide as a passage at least, within the sequence."""
    more = max(WIDTH - (last - first + 1), 0)
    low = max(min(first - more // 2, size - WIDTH), 0) if more else first
    return int(low), int(max(last, low + WIDTH - 1) if more else last)


_SPANS = "seq_id long, other long, first int, last int"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of each pair, as one row for either side."""
    for batch in batches:
        rows = []
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        left, right = batch.column("left"), batch.column("right")
        for k in range(batch.num_rows):
            x, y = np.asarray(left[k].values), np.asarray(right[k].values)
            for i0, i1, j0, j1 in passages(x, y):
                rows += [(a[k], b[k], i0, i1), (b[k], a[k], j0, j1)]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["seq_id", "other", "first", "last"]
        )


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of the texts that are the wanted ones (a repeated doc_id may bring others).

    Shingles are cut to 32 bits here: enough to tell the few of two documents apart.
    """
    for batch in batches:
        for part in text_slices(batch, size=_SLICE_BYTES):
            shingles, sizes, _ = sequences(part.column("text"))
            ids = sequence_ids(shingles, sizes)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            low = (shingles >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.ListArray.from_arrays(pa.array(ends), pa.array(low))],
                names=["seq_id", "shingles"],
            ).filter(pa.array(ids == np.asarray(part.column("seq_id"))))


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("leader", "seq_id").alias("a"), F.greatest("leader", "seq_id").alias("b")).distinct()


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_spans, repeated_words, spans, first_id, seq_id``.

    ``spans``: word ranges ``start:end`` (end exclusive), merged and comma-joined, of
    passages of ``PASSAGE`` words and more that are near-duplicates of a passage in
    another row. ``first_id``: the smallest doc_id of its class, the rows that share
    passages directly or through others. A null text counts as empty; short texts have none.
    Rows whose words are equal throughout repeat as a whole.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = source.mapInArrow(_first_pass(8 * parts), _FIRST)
    second = first.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_second_pass, _SECOND)
    second = materialise(second, "substring-groups")
    rows = second.where("is_doc").select("doc_id", "n_words", "seq_id")
    classes = materialise(
        rows.groupBy("seq_id").agg(
            F.min("doc_id").alias("rep"), F.max("n_words").alias("n_words"), F.count("*").alias("n")
        ),
        "substring-classes",
    )
    open_ = second.where("not is_doc").select("grp", "seq_id", "at")

    # One document for each sequence that shares a key.
    wanted = materialise(
        open_.select("seq_id").distinct().join(classes.select("seq_id", F.col("rep").alias("_rep")).hint("merge"), "seq_id"),
        "substring-wanted",
    )
    texts = source.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_rep")))
    full = texts.select("seq_id", "text").mapInArrow(_full, "seq_id long, shingles array<int>")
    full = materialise(full, "substring-sequences")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        left = full.select(F.col("seq_id").alias("a"), F.col("shingles").alias("left"))
        right = full.select(F.col("seq_id").alias("b"), F.col("shingles").alias("right"))
        sides = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
        return materialise(sides.select("a", "b", "left", "right").mapInArrow(_verify, _SPANS), name)

    def uncovered(rows: DataFrame, spans: DataFrame) -> DataFrame:
        """Rows that no passage shared with the leader of the same group covers.

        A passage shared with another document says nothing of the rest of this group.
        """
        cover = spans.select(F.col("seq_id").alias("_seq"), "other", "first", "last").hint("merge")
        hit = (F.col("seq_id") == F.col("_seq")) & (F.col("leader") == F.col("other")) & F.col("at").between(F.col("first"), F.col("last"))
        return rows.join(cover, hit, "left_anti")

    def dealt(rows: DataFrame) -> DataFrame:
        """The rows of large groups in smaller ones, by what stands beside the key."""
        sides = full.hint("merge")
        lead = rows.where("seq_id = leader").join(sides, "seq_id").groupBy("grp").agg(F.flatten(F.collect_list(beside)).alias("leading"))
        name = F.xxhash64("grp", "seq_id", "at")
        owner = F.when(F.col("open"), name.bitwiseAND(F.lit(-2))).otherwise(name.bitwiseOR(F.lit(1)))
        held = materialise(rows.withColumn("owner", owner), "substring-large")
        context = held.join(sides, "seq_id").select("grp", "at", "owner", beside.alias("context")).join(lead.hint("merge"), "grp")
        keys = context.select("grp", "at", "owner", "context", "leading").mapInArrow(_context_keys(8 * parts), _CONTEXTS)
        keys = keys.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_shared_contexts, "grp long, owner long")
        return keys.distinct().join(held.drop("grp").hint("merge"), "owner").select(rows.columns)

    def searched(rows: DataFrame, unit: str) -> DataFrame:
        """Passages of the open ``rows`` and others of their groups; documents go to a task once for each ``unit``.

        A unit of many open documents is dealt to several tasks, by these: all members of their groups go there too.
        """
        rows = rows.withColumn("unit", F.col(unit))
        shares = rows.where("open").groupBy("unit").agg(F.ceil(F.countDistinct("seq_id") / SHARE).alias("shares"))
        share = F.pmod(F.xxhash64("seq_id"), F.col("shares"))
        groups = rows.where("open").join(shares.hint("merge"), "unit").select("unit", "grp", "shares", share.alias("share")).distinct()
        held = rows.join(groups.hint("merge"), ["unit", "grp"]).withColumn("open", F.col("open") & (share == F.col("share")))
        held = held.groupBy(F.xxhash64("unit", "share").alias("unit"), "leader", "seq_id").agg(F.collect_list(F.struct("grp", "at", "open")).alias("rows"))
        held = held.join(full.hint("merge"), "seq_id").select(
            F.pmod(F.xxhash64("unit"), F.lit(8 * parts)).cast("int").alias("bucket"), "unit", "leader", "seq_id",
            F.col("rows.grp").alias("grps"), F.col("rows.at").alias("ats"), F.col("rows.open").alias("opens"), "shingles",
        )
        return held.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_partners, _SPANS)

    beside = F.slice("shingles", F.greatest(F.col("at") - BESIDE, F.lit(0)) + 1, F.least("at", F.lit(BESIDE)) + SHORT + BESIDE)
    # The smallest sequence of a group leads it.
    groups = open_.groupBy("grp").agg(F.min("seq_id").alias("leader"), F.count("*").alias("n"))
    every = materialise(open_.join(groups.hint("merge"), "grp"), "substring-led")
    follow = every.where("seq_id != leader")
    # First each document with one leader only, which settles whole copies cheaply.
    near = follow.groupBy("seq_id").agg(F.min("leader").alias("leader"))
    # Verifying a pair finds all its passages: no pair is verified twice.
    tried = materialise(_ordered_pairs(near), "substring-tried")
    spans = verified(tried, "substring-spans")
    # Then the rest with the leaders of all its groups.
    follow = materialise(uncovered(follow, spans), "substring-left")
    fresh = materialise(_ordered_pairs(follow).join(tried.hint("merge"), ["a", "b"], "left_anti"), "substring-tried")
    spans = spans.union(verified(fresh, "substring-fresh"))
    # What is left looks for a partner among the other rows of its groups, those settled before included.
    left = materialise(uncovered(follow.where("n > 2"), spans), "substring-left")
    marked = left.select("grp", "seq_id", "at", F.lit(True).alias("_open")).hint("merge")
    held = every.join(left.select("grp").distinct().hint("merge"), "grp").join(marked, ["grp", "seq_id", "at"], "left")
    held = materialise(held.withColumn("open", F.col("_open").isNotNull()).drop("_open"), "substring-held")
    some = searched(held.where(F.col("n") <= LARGE), "leader")
    if held.where(F.col("n") > LARGE).limit(1).count():
        some = some.union(searched(dealt(held.where(F.col("n") > LARGE)), "grp"))
    found = spans.union(materialise(some, "substring-partners"))
    # Documents that share passages, directly or through others, form a class.
    label = components(found.select(F.col("seq_id").alias("a"), F.col("other").alias("b")).distinct())
    member = label.join(classes.select(F.col("seq_id").alias("id"), "rep").hint("merge"), "id")
    least = member.groupBy("label").agg(F.min("rep").alias("least"))
    member = member.join(least.hint("merge"), "label").select(F.col("id").alias("seq_id"), "least")
    found = found.select(
        "seq_id", F.col("first").cast("long").alias("start"), (F.col("last") + WORDS).cast("long").alias("end")
    )
    whole = classes.where((F.col("n") > 1) & (F.col("n_words") >= PASSAGE)).select(
        "seq_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")
    )
    # Overlapping ranges of a sequence become one.
    per = found.union(whole).groupBy("seq_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges")
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    grow = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
        ),
    ).otherwise(F.concat(acc, F.array(x)))
    per = per.withColumn("ranges", F.aggregate("ranges", empty, grow))
    out = rows.join(classes.select("seq_id", "rep").hint("merge"), "seq_id").join(per.hint("merge"), "seq_id", "left")
    out = out.join(member.hint("merge"), "seq_id", "left")
    span_text = F.array_join(F.transform("ranges", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.select(
        "doc_id", "n_words",
        F.when(F.col("ranges").isNull(), 0).otherwise(F.size("ranges")).cast("long").alias("n_spans"),
        F.coalesce(F.aggregate("ranges", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]), F.lit(0)).alias("repeated_words"),
        F.coalesce(span_text, F.lit("")).alias("spans"),
        F.when(F.col("ranges").isNotNull(), F.coalesce("least", "rep")).alias("first_id"),
        "seq_id",
    )
