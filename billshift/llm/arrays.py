"""Arrow batches as flat numpy arrays, for the operators that work per batch.

Everything here handles one Arrow batch; Spark splits, ships and regroups the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes, so a batch of long texts
#: needs no more memory than one of short ones. A longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES, rows: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded text size and row number, null texts made empty."""
    index = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(index).cast(pa.string()), "")
    batch = batch.set_column(index, column, texts)
    if batch.num_rows == 0:
        return
    ends = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        stop = min(stop, start + rows)
        yield batch.slice(start, stop - start)
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and the offsets of its texts in them."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string array, and the offsets of its texts in them."""
    data, offsets = utf8(texts)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return chars, starts[offsets]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + n)``."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_PRIME = np.uint64(0x100000001B3)


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and the number of each text.

    The separators are ASCII, so UTF-8 bytes do as well as characters. ``lower``
    folds A-Z.
    """
    data, offsets = utf8(texts)
    space = _SPACE[data]
    begin = ~space
    begin[1:] &= space[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begin[heads] = ~space[heads]
    starts = np.flatnonzero(begin)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    letters = data[~space]
    if lower:
        letters = _LOWER[letters]
    # Places in the text without separators.
    firsts = starts - np.cumsum(space)[starts]
    lengths = np.diff(np.append(firsts, len(letters)))
    powers = np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))
    values = _BYTE[letters] * powers[np.arange(len(letters)) - np.repeat(firsts, lengths)]
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(np.add.reduceat(values, firsts)), counts
