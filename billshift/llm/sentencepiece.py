"""SentencePiece encoding and decoding with one forward pass per shared prefix.

The distinct marked words of a batch are sorted, which makes them the depth-first
traversal of their trie. The forward state of a prefix (the best last piece ending
there) depends on nothing behind it, so a word starts from the state that it shares
with the word before it.

For a unigram model the state is the Viterbi score. For a BPE model each prefix has
exactly one encoding: its last piece is the one that, beside the last piece of the
shorter prefix, stays unmerged. (A sequence of pieces is the encoding of a text just
when each piece encodes itself and no two neighbours, encoded alone, come out
otherwise: before a first merge across a border, both sides evolve as they do alone.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

from billshift.llm.arrays import ranges, text_slices, utf8

MARK = "▁"
#: Entries after which a task's tables of words and of piece pairs start anew. They
#: only save work.
CACHE = 650_000
#: What a unigram model subtracts from its lowest score for an unknown character.
UNKNOWN_PENALTY = 10.0
_TWO = (2,)


@dataclass
class Model:
    """The vocabulary of one model file; its size does not depend on any corpus."""

    pieces: list[str]
    scores: list[float]
    #: Pieces that texts may be split into.
    plain: list[bool]
    byte_ids: dict[int, int]
    unknown: int
    unigram: bool
    _ready: bool = field(default=False, repr=False)

    def prepare(self) -> None:
        """Lookup tables, built where they are used."""
        if self._ready:
            return
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.plain[i]}
        self.rank = {p: -self.scores[i] for p, i in self.ids.items()}
        self.never = np.inf
        # Lengths of the pieces that end with three given characters, longest first; behind
        # any other three only a piece of two can end.
        ending: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                ending.setdefault(p[-3:], {2} if p[-2:] in self.ids else set()).add(len(p))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ending.items()}
        self.lowest = min(self.scores[i] for i in self.ids.values())
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        breaks = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        # Word borders that no piece crosses: before marks, and around characters that
        # are in no piece.
        stop = re.escape(breaks)
        self.split = re.compile(
            "(?s).+" if inner else f"{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+" + (f"|[{stop}]" if stop else "")
        )
        #: Pieces, and whether each encodes itself once that has been asked.
        self.alone: dict[str, bool | None] = dict.fromkeys(self.ids)
        self.beside: dict[tuple[str, str], bool] = {}
        self._bytes = [self._text(i) for i in range(len(self.pieces))]
        sizes = np.array([len(b) for b in self._bytes], np.int64)
        self.byte_table = np.frombuffer(b"".join(self._bytes), np.uint8)
        self.words = _Words(self)
        self.byte_sizes, self.byte_starts = sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self._ready = True

    def _text(self, i: int) -> bytes:
        value = {v: k for k, v in self.byte_ids.items()}.get(i) if not self.plain[i] else None
        if value is not None:
            return bytes([value])
        if self.plain[i]:
            return self.pieces[i].replace(MARK, " ").encode()
        return " ⁇ ".encode() if i == self.unknown else b""

    def merges(self, text: str) -> list[str]:
        """The pieces that merging by score leaves of a short text."""
        parts, rank = list(text), self.rank.get
        never = self.never
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
        return parts

    def stays(self, piece: str) -> bool:
        """Whether the piece encodes itself."""
        if self.alone[piece] is None:
            self.alone[piece] = self.merges(piece) == [piece]
        return self.alone[piece]

    def apart(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are beside each other."""
        key = (left, right)
        if key not in self.beside:
            if len(self.beside) > CACHE:
                self.beside.clear()
            self.beside[key] = self.merges(left + right) == [left, right]
        return self.beside[key]

    def forward_unigram(self, word: str, start: int, last: list[int], score: list[float]) -> None:
        """Extend the forward state from ``word[:start]`` to the whole word."""
        for end in range(start + 1, len(word) + 1):
            best = self.lowest - UNKNOWN_PENALTY
            found = self.ids.get(word[end - 1])
            length, value = 1, score[end - 1] + (best if found is None else self.scores[found])
            for n in self.lengths.get(word[end - 3 : end], _TWO):
                found = self.ids.get(word[end - n : end]) if n <= end else None
                if found is not None and score[end - n] + self.scores[found] > value:
                    length, value = n, score[end - n] + self.scores[found]
            last.append(length)
            score.append(value)

    def forward_bpe(self, word: str, start: int, last: list[int], score: list[float]) -> None:
        """The same for merges, where just one last piece is possible; scores stay 0."""
        lengths, stays, beside = self.lengths, self.alone, self.beside
        for end in range(start + 1, len(word) + 1):
            length = 1
            for n in lengths.get(word[end - 3 : end], _TWO):
                at = end - n
                if at < 0:
                    continue
                piece = word[at:end]
                alone = stays.get(piece, False)
                if alone is False or alone is None and not self.stays(piece):
                    continue
                if at == 0:
                    length = n
                    break
                left = word[at - last[at] : at]
                apart = beside.get((left, piece))
                if self.apart(left, piece) if apart is None else apart:
                    length = n
                    break
            last.append(length)
            score.append(0.0)

    def fallback(self, char: str) -> tuple[int, ...]:
        """Ids of a character that is no piece."""
        if self.byte_ids:
            return tuple(self.byte_ids[b] for b in char.encode())
        return (self.unknown,)

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, in one depth-first pass over their trie."""
        self.prepare()
        forward = self.forward_unigram if self.unigram else self.forward_bpe
        out = {}
        # By prefix length: length of the last piece, score, ids (where a word has asked for them).
        path, last, score, ids = "", [0], [0.0], [()]
        for word in sorted(words):
            shared = len(path)
            while not word.startswith(path[:shared]):
                shared -= 1
            del last[shared + 1 :], score[shared + 1 :], ids[shared + 1 :]
            forward(word, shared, last, score)
            ids += [None] * (len(word) - shared)
            # Back along the last pieces to a prefix that has its ids, then forward again.
            ends, end = [], len(word)
            while ids[end] is None:
                ends.append(end)
                end -= last[end]
            for end in reversed(ends):
                start = end - last[end]
                found = self.ids.get(word[start:end])
                ids[end] = ids[start] + ((found,) if found is not None else self.fallback(word[start]))
            path = word
            out[word] = ids[-1]
        return out


def load(path: str) -> Model:
    """Read a model file, on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    bytes_ = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    # Merged pieces of a BPE model score the negative of their rank, whole numbers.
    scores = [sp.get_score(i) for i in range(n)]
    plain = [not s for s in special]
    unigram = any(s != int(s) for s, p in zip(scores, plain) if p)
    return Model(pieces, scores, plain, bytes_, sp.unk_id(), unigram)


class _Words:
    """Words met by a task, numbered, with their ids in one flat table."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and how many belong to each text."""
        if len(self.number) > CACHE:
            self.clear()
        split = self.model.split.findall
        per_text = [split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = list(chain.from_iterable(per_text))
        codes = list(map(self.number.get, words))
        fresh = {w for w, code in zip(words, codes) if code is None}
        if fresh:
            ids = self.model.encode_words(list(fresh))
            base = len(self.number)
            self.number.update(zip(ids, range(base, base + len(ids))))
            self.sizes = np.concatenate([self.sizes, [len(x) for x in ids.values()]]).astype(np.int64)
            new = np.fromiter(chain.from_iterable(ids.values()), np.int32)
            self.flat = np.concatenate([self.flat, new])
            codes = list(map(self.number.get, words))
        codes = np.array(codes, np.int64)
        starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        flat = self.flat[ranges(starts[codes], self.sizes[codes])]
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in per_text])
        counts = np.bincount(owner, weights=self.sizes[codes], minlength=len(texts)).astype(np.int64)
        return flat, counts


def decode_ids(model: Model, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, and the offsets of the texts in them.

    The mark at the start of a text, which encoding put there, is left out.
    """
    model.prepare()
    sizes = model.byte_sizes[flat]
    data = model.byte_table[ranges(model.byte_starts[flat], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    first = ends[:-1]
    held = first < ends[1:]
    dropped = first[held][data[first[held]] == 0x20]
    keep = np.ones(len(data), bool)
    keep[dropped] = False
    return data[keep], ends - np.searchsorted(dropped, ends)


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``exact`` in place of ``text``.

    ``exact``: decoding the ids gives the text back (U+2581 in a text comes back as a
    space). Null and empty texts have no ids. Columns of these names are replaced.
    """
    rest = docs.drop("text", "ids", "n_tokens", "exact")
    names = rest.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m.prepare()
        words = m.words  # a worker keeps them from task to task
        for batch in batches:
            for part in text_slices(batch):
                column = part.column("text")
                flat, counts = words.encode(column.to_pylist())
                data, offsets = decode_ids(m, flat, counts)
                original, at = utf8(column)
                exact = [
                    np.array_equal(data[a:b], original[c:d])
                    for a, b, c, d in zip(offsets[:-1], offsets[1:], at[:-1], at[1:])
                ]
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                    pa.array(flat, pa.int32()),
                )
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], ids, pa.array(counts), pa.array(exact, pa.bool_())],
                    names=[*names, "ids", "n_tokens", "exact"],
                )

    schema = (
        StructType([*rest.schema.fields])
        .add("ids", ArrayType(IntegerType()))
        .add("n_tokens", LongType())
        .add("exact", BooleanType())
    )
    return docs.select(*names, "text").mapInArrow(work, schema)


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` with ``text`` in place of ``ids``; bytes that are no UTF-8 become U+FFFD."""
    rest = encoded.drop("ids", "text")
    names = rest.columns
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            lists = batch.column("ids")
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            data, offsets = decode_ids(m, np.asarray(lists.flatten(), np.int64), counts)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "text"]
            )

    return encoded.select(*names, "ids").mapInArrow(
        work, StructType([*rest.schema.fields]).add("text", "string")
    )
