"""Repeated passages: sliding runs of sentences, joined over all documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm.hashing import mix, slices
from codespan.llm.store import by_row, keep, text_key

RUN = 3  # sentences hashed together
LONGEST = 12  # words; a longer sentence is cut into pieces of so many at most
LEAST = 20  # words that covered neighbours must have to be removed
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=\s|$)|\n|[.!?]|$)\s*")
# A character of a script written without spaces is a word of its own.
_OWN = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_WORDS = re.compile(rf"\s*(?:[{_OWN}]|[^\s{_OWN}]+)\s*")
_UNSPACED = re.compile(f"[{_OWN}]")


def n_words(piece: str) -> int:
    if piece.isascii() or not _UNSPACED.search(piece):
        return len(piece.split())
    return len(_WORDS.findall(piece))


def cuts(hashes: list[int]) -> list[int]:
    """Words after which a long sentence is cut: the last least hash of every LONGEST neighbours.

    Only the words around a cut decide about it, so a passage is cut alike wherever it
    stands, but for LONGEST words at its ends; and no piece is longer than LONGEST.
    """
    out, at = [], -1
    for i in range(len(hashes) - LONGEST + 1):
        end = i + LONGEST
        if at < i:
            window = hashes[i:end]
            at = end - 1 - window[::-1].index(min(window))
        elif hashes[end - 1] <= hashes[at]:
            at = end - 1
        else:
            continue
        out.append(at + 1)
    return out


def sentences(text: str) -> list[str]:
    """Pieces that make up the text again: sentences, long ones cut where their words decide."""
    out = []
    for found in _SENTENCE.findall(text):
        if n_words(found) <= LONGEST:
            if found:
                out.append(found)
            continue
        words = _WORDS.findall(found)
        edges = [0, *cuts([xxhash.xxh64_intdigest(w.strip()) for w in words]), len(words)]
        out.extend("".join(words[b:e]) for b, e in zip(edges, edges[1:]) if b < e)
    return out


def run_hashes(pieces: list[str]) -> np.ndarray:
    """One hash for every run of RUN neighbouring pieces, white space around them aside."""
    if len(pieces) < RUN:
        return np.zeros(0, np.int64)
    own = np.array([xxhash.xxh64_intdigest(p.strip()) for p in pieces], np.uint64)
    n = len(own) - RUN + 1
    total = np.zeros(n, np.uint64)
    for k in range(RUN):
        total = mix(total + own[k : k + n])
    return total.view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [run_hashes(sentences(t)) for t in part.column("text").to_pylist()]
            lengths = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *found]))
            yield pa.record_batch(
                [part.column("doc_id"), part.column("text_key"), pa.ListArray.from_arrays(lengths, flat)],
                names=["doc_id", "text_key", "runs"],
            )


def cut(text: str, starts: list[int]) -> tuple[str, int, int, int]:
    """The text without what the runs at ``starts`` cover; its pieces, how many went, how many LEAST kept."""
    pieces = sentences(text)
    covered = np.zeros(len(pieces) + 1, bool)
    for s in starts:
        covered[s : s + RUN] = True
    covered[-1] = False
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
    gone = np.zeros(len(pieces), bool)
    for b, e in zip(edges[::2], edges[1::2]):
        if sum(map(n_words, pieces[b:e])) >= LEAST:
            gone[b:e] = True
    return "".join(p for p, g in zip(pieces, gone) if not g), len(pieces), int(gone.sum()), int((covered[:-1] & ~gone).sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, total, removed, short = [], [], [], []
        for t, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
            if starts:
                t, n, gone, spared = cut(t, starts)
            else:
                n, gone, spared = len(sentences(t or "")), 0, 0
            text.append(t)
            total.append(n)
            removed.append(gone)
            short.append(spared)
        new = {"text": pa.array(text, pa.string()), "n_pieces": pa.array(total, pa.int64()),
               "n_removed": pa.array(removed, pa.int64()),
               "n_short": pa.array(short, pa.int64())}
        rest = [c for c in batch.schema.names if c not in (*new, "starts")]
        yield pa.record_batch(
            [*[batch.column(c) for c in rest], *new.values()], names=[*rest, *new]
        )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, at: every place of a run that stands elsewhere before it.

    Before: in a smaller doc_id (null first), then text key, then place.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kept = keep(rows.mapInArrow(_runs, "doc_id long, text_key long, runs array<long>"))
    places = kept.select("doc_id", "text_key", F.posexplode("runs").alias("at", "run"))
    often = places.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run")
    again = keep(places.join(often, "run"))
    first = again.groupBy("run").agg(F.min(F.struct("doc_id", "text_key", "at")).alias("first"))
    return again.join(first, "run").where(
        ~F.struct("doc_id", "text_key", "at").eqNullSafe(F.col("first"))
    ).select("doc_id", "text_key", "at")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` without repeated passages, n_pieces, n_removed and n_short of every row.

    A passage goes where it is not the first: neighbouring sentences that repeated
    runs cover, if they have LEAST words together; n_short counts the covered ones
    that stay for want of them.  60 equal words always hold a run, whatever stands
    around them; at most LONGEST words at each end of a passage stay.  Texts of fewer than RUN
    sentences have no runs.  Null texts stay null; rows that repeat both doc_id
    and text are cut alike.  Columns besides doc_id and text are left out.
    """
    gone = repeated_runs(docs).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("at")).alias("starts")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = by_row(rows, gone, "left", "starts")
    return joined.select("doc_id", "text", "starts").mapInArrow(
        _cut, "doc_id long, text string, n_pieces long, n_removed long, n_short long"
    )
