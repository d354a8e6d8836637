"""Word and shingle hashes of many texts at once, with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed together; a longer text is hashed alone.
BLOCK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTOR = np.uint64(0xD1342543DE82EF95)


def powers(n: int, factor: np.uint64 = FACTOR, known: dict = {}) -> np.ndarray:  # noqa: B006
    """The first n powers of a factor; kept between calls up to the length of ordinary words and lines."""
    made = known.get(factor)
    if made is None or len(made) < n:
        made = np.full(max(n, 1024), factor)
        made[0] = 1
        np.multiply.accumulate(made, out=made)
        if n <= 1 << 16:
            known[factor] = made
    return made[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, one after the other, and where each text's words begin.

    Words are runs of bytes other than ASCII white space. The second array has one
    entry more than there are texts.
    """
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    inside = ~SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    summed = np.add.reduceat(BYTE[data[inside]] * powers(int(sizes.max()))[place], first)
    return mix(summed + sizes.astype(np.uint64)), bounds


def shingles_of(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words; of fewer words, one hash of all; of none, nothing."""
    k = min(k, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = mix(out * FACTOR + words[i : i + n])
    return out


def blocks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """The texts in their order, in lists of about BLOCK bytes."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > BLOCK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in their order, in batches with about BLOCK bytes of that text column.

    So what is made of the texts is small however many rows Spark sends at once.
    """
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // BLOCK
    cuts = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(sizes)]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def each_words(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for group in blocks(texts):
        hashes, bounds = word_hashes(group)
        for i in range(len(group)):
            yield hashes[bounds[i] : bounds[i + 1]]
