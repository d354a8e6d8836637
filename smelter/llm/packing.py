"""Packing documents into token sequences by dominance reduction and best fit.

Only 2048 different piece lengths exist, so the packing problem of any corpus is a
vector of 2048 counts. That is solved at once for all pieces of a length; the pieces
are then numbered within their length and look their place up.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from smelter.llm.common import durable, numbered, part_of

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
#: Ends each document.
END = 0
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: White space in the sense of the tokenizer's pattern, so many in a row that its depth matters.
LONG_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
#: Characters that are encoded at a time.
STRETCH = 1 << 19


def reduce_counts(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins that some best packing has, as (sizes, how many); they are taken off `counts`.

    Martello and Toth's criterion: a set of pieces with the largest piece j in it
    dominates all others if each of them could be swapped for parts of it. Found here:
    j alone if nothing fits beside it; j with a piece that fills the bin; j with the
    largest piece that fits, if no two fit or if three don't and no two are larger
    than that one.
    """
    bins = []
    sizes = [int(s) for s in np.flatnonzero(counts)]  # ascending; emptied ones are removed

    def fix(*pieces: int, times: int) -> None:
        bins.append((pieces, times))
        for p in pieces:
            counts[p] -= times
        for p in set(pieces):
            if not counts[p]:
                sizes.pop(bisect.bisect_left(sizes, p))

    def least(n: int) -> int:
        """The sum of the n smallest pieces."""
        total = 0
        for s in sizes:
            k = min(n, int(counts[s]))
            total, n = total + k * s, n - k
            if not n:
                return total
        return capacity + 1

    def best_pair(room: int) -> int:
        """The largest sum of two pieces that is at most `room`, else 0."""
        best, i, j = 0, 0, bisect.bisect_right(sizes, room) - 1
        while i <= j:
            total = sizes[i] + sizes[j]
            if total > room or (i == j and counts[sizes[i]] < 2):
                j -= 1
            else:
                best, i = max(best, total), i + 1
        return best

    fixed = -1
    while fixed != len(bins):
        fixed, at = len(bins), len(sizes) - 1
        while at >= 0:
            j = sizes[at]
            room = capacity - j
            counts[j] -= 1  # what may lie beside one piece of size j
            fitting = [s for s in sizes[: bisect.bisect_right(sizes, room)] if counts[s]]
            largest = fitting[-1] if fitting else 0
            # removing pieces keeps each of these true, so it holds for all pieces of both sizes
            paired = largest and (largest == room or least(2) > room or (least(3) > room and largest >= best_pair(room)))
            counts[j] += 1
            if not largest:
                fix(j, times=int(counts[j]))
            elif paired and largest == j:
                fix(j, j, times=int(counts[j]) // 2)
            elif paired:
                fix(j, largest, times=int(min(counts[j], counts[largest])))
            else:
                at -= 1
            at = min(at, len(sizes) - 1)
    return bins


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, largest pieces first: each goes where the least room is left that holds it."""
    open_bins: list[tuple[int, tuple[int, ...], int]] = []  # room, sizes, how many; by room
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = bisect.bisect_left(open_bins, (size,))
            if at == len(open_bins):
                per_bin = capacity // size
                for n, times in ((per_bin, left // per_bin), (left % per_bin, 1)):
                    if n and times:
                        bisect.insort(open_bins, (capacity - n * size, (size,) * n, times))
                break
            room, sizes, times = open_bins.pop(at)
            per_bin = room // size
            filled = min(times, left // per_bin)
            left -= filled * per_bin
            last = left if filled < times else 0
            left -= last
            for n, k in ((per_bin, filled), (last, int(last > 0)), (0, times - filled - int(last > 0))):
                if k:
                    bisect.insort(open_bins, (room - n * size, sizes + (size,) * n, k))
    return [(sizes, times) for _, sizes, times in open_bins]


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """All bins for so many pieces of each size, as (sizes, how many)."""
    counts = counts.copy()
    return reduce_counts(counts, capacity) + best_fit(counts, capacity)


def places(bins: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int]]:
    """size, first rank, first bin, offset: where the pieces of each size go, in the order of their ranks.

    From its first rank up to the next entry's, the pieces of an entry lie at one
    offset of consecutive bins.
    """
    out, used, first_bin = [], {}, 0
    for sizes, times in bins:
        offset = 0
        for size in sizes:
            out.append((size, used.get(size, 0), first_bin, offset))
            used[size] = used.get(size, 0) + times
            offset += size
        first_bin += times
    return sorted(out)


@lru_cache
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, in the library that is fastest with it.

    Joining the pair that was merged first is the same as joining the one with the
    smallest id, as long as ids follow the merges; that is checked.
    """
    model = json.loads(Path(path).read_text())["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab[a + b] for a, b in pairs]
    if ids != sorted(ids):
        raise ValueError(f"ids of {path} don't follow its merges")
    # bytes that print stand for themselves, the others for characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token)}
    special = {t["id"] for t in json.loads(Path(path).read_text())["added_tokens"]}
    ranks = {token: i for token, i in ranks.items() if i not in special}
    return tiktoken.Encoding(Path(path).stem, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache
def tokenizer_of(path: str) -> tuple[Tokenizer, dict[str, int], re.Pattern | None]:
    """The tokenizer itself, its added tokens, and a pattern that finds them in a text."""
    found = Tokenizer.from_file(path)
    added = {token.content: i for i, token in found.get_added_tokens_decoder().items()}
    longest_first = sorted(added, key=len, reverse=True)
    return found, added, re.compile("|".join(map(re.escape, longest_first))) if added else None


def encode(text: str, path: str) -> bytes:
    """A text's token ids as little-endian bytes; the strings of added tokens are these tokens."""
    _, added, pattern = tokenizer_of(path)
    out, start = [], 0
    for found in pattern.finditer(text) if pattern else ():
        out += ordinary(text[start : found.start()], path)
        out.append(added[found[0]].to_bytes(4, "little"))
        start = found.end()
    out += ordinary(text[start:], path)
    return b"".join(out)


def ordinary(text: str, path: str) -> Iterator[bytes]:
    """Token ids of a text without added tokens.

    A long run of white space goes to the tokenizer itself, since the faster library's
    pattern keeps a state for each of its characters. The pattern takes such a run for
    one piece, but for its last character where more text follows.
    """
    known, start = encoding(path), 0
    for run in LONG_WHITE.finditer(text):
        for part in stretches(text[start : run.start()]):
            yield known.encode_to_numpy(part).astype("<u4").tobytes()
        start = run.end() - (run.end() < len(text))
        yield np.array(tokenizer_of(path)[0].encode(text[run.start() : start], add_special_tokens=False).ids, "<u4").tobytes()
    for part in stretches(text[start:]):
        yield known.encode_to_numpy(part).astype("<u4").tobytes()


def stretches(text: str) -> Iterator[str]:
    """The text in stretches of about STRETCH characters. No token crosses from a word into the single space behind it."""
    start = 0
    while len(text) - start > STRETCH and (found := SINGLE.search(text, start + STRETCH)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int]]:
    """start, length and checksum of each piece; only the first may be shorter than the others."""
    n, start = len(ids) // 4, 0
    while start < n:
        length = (n - start) % capacity or capacity
        yield start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start += length


def piece_maker(path: str, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece, found in enumerate(cut(encode(text.as_py(), path) + END.to_bytes(4, "little"), capacity)):
                    for column, value in zip(rows, (doc_id, piece, *found)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return make


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's token ids and then 0; a null text counts as empty, so
    every document has at least one token. The strings of the tokenizer's added tokens
    are these tokens. Only documents longer than `capacity` are cut, so that just the
    first piece may be shorter. Repeated rows are packed each. Other columns are
    ignored; an empty table gives no rows. What the driver sees is how many pieces
    have each length.
    """
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = slim.mapInArrow(piece_maker(tokenizer, capacity), PIECE)
    pieces = durable(pieces.withColumn("part", part_of(F.col("doc_id"), F.col("piece"), F.col("ids_crc32"))))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most one row for each length
        counts[length] = n
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    return ranked.mapInPandas(finder(places(solve(counts, capacity))), f"{PIECE}, sequence_id long, offset long")


def finder(found: list[tuple[int, int, int, int]]):
    """Looks up sequence and offset of ranked pieces; `found` has a few entries for each length."""
    table = np.array(found, np.int64).reshape(-1, 4)
    columns = [field.split()[0] for field in PIECE.split(", ")]

    def look_up(batches):
        widest = int(table[:, 1].max(initial=0)) + 1
        for rows in batches:
            length, rank = rows["length"].to_numpy(), rows["rank"].to_numpy()
            at = np.searchsorted(table[:, 0] * widest + table[:, 1], length * widest + np.minimum(rank, widest - 1), side="right") - 1
            hit = table[at]
            yield rows[columns].assign(sequence_id=hit[:, 2] + rank - hit[:, 1], offset=hit[:, 3])

    return look_up
