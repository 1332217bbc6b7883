"""Words and word shingles of a batch of texts as 64-bit hashes, in numpy.

A batch is an Arrow string array; its bytes are hashed in place, block by block,
so what is held besides the batch is a few arrays over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15 | 1
_LANES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def byte_table(separators: bytes, fold_case: bool) -> np.ndarray:
    """One random 64-bit value per byte; 0 for separators; A-Z as a-z if folded."""
    table = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if fold_case:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


WHITE = bytes([0x20, *range(0x09, 0x0E)])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins and ends (n + 1 offsets)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch holding about ``limit`` text bytes each, one row at least."""
    _, at = buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def word_spans(raw: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and the first word of each text (n + 1 numbers)."""
    inside = table[raw] != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(raw)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One hash per word: its bytes' values weighted by powers of an odd base, scrambled."""
    out = np.empty(len(starts), np.uint64)
    powers = np.ones(1, np.uint64)
    done = 0
    while done < len(starts):
        upto = max(int(np.searchsorted(starts, starts[done] + BLOCK)), done + 1)
        stop = starts[upto] if upto < len(starts) else len(raw)
        begin = starts[done:upto] - starts[done]
        size = np.diff(np.append(begin, stop - starts[done]))
        if size.max() > len(powers):
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size.max(), _BASE, np.uint64)]), dtype=np.uint64)
        place = np.arange(int(stop - starts[done])) - np.repeat(begin, size)
        out[done:upto] = np.add.reduceat(table[raw[starts[done] : stop]] * powers[place], begin)
        done = upto
    return mix(out)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words make one shorter run, none make none."""
    width_here = min(width, len(words))
    if not width_here:
        return np.zeros(0, np.uint64)
    n = len(words) - width_here + 1
    total = np.full(n, width_here, np.uint64)
    for k in range(width_here):
        total += words[k : k + n] * _LANES[k]
    return mix(total)


def shingle_sets(texts: pa.Array, width: int, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per text the number of its words and its distinct shingles, ascending."""
    raw, at = buffers(texts)
    starts, first = word_spans(raw, at, table)
    hashes = word_hashes(raw, starts, table)
    for i in range(len(at) - 1):
        own = hashes[first[i] : first[i + 1]]
        yield len(own), np.unique(shingles(own, width))


def set_signature(values: np.ndarray) -> int:
    """A signed 64-bit digest of a set given in ascending order."""
    if not len(values):
        return 0
    place = mix(np.arange(1, len(values) + 1, dtype=np.uint64))
    return int(mix(np.array([np.add.reduce(mix(values ^ place))], np.uint64)).view(np.int64)[0])
