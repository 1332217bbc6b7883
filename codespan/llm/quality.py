"""Quality by votes of the nearest labelled documents in a latent semantic space.

Texts are counted by hashed runs of three bytes and by words that repeat the one
before, weighted by how rare each is over all documents, and projected on the main
directions of a labelled sample.
The sample's vectors go to every task, which takes the cosines of its documents
with all of them, block by block, and lets the nearest vote.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm.hashing import WHITE, buffers, byte_table, slices, word_hashes, word_spans
from codespan.llm.labelled import fold, labelled_sample

FEATURE_BITS = 12
REPEATS = 8  # features that hold how many words repeat the one before, so much that weighs
FEATURES = (1 << FEATURE_BITS) + REPEATS
RANK = 48
PER_CLASS = 2000  # labelled documents of each class that the model holds at most
NEIGHBOURS = 25
SHARPNESS = 8.0  # a neighbour's vote is its cosine to this power
BLOCK = 256  # documents whose cosines are held at a time
_DAMPED = np.log1p(np.arange(256)).astype(np.float32)
_WORD_BYTES = byte_table(WHITE, fold_case=True)


def counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of features per text: hashed byte-triple counts and repeats, damped logarithmically.

    Triples do not reach across texts; texts of fewer than three bytes have none.
    Counting goes megabyte by megabyte, so a very long text costs no more memory.
    """
    size, n = 1 << FEATURE_BITS, len(at) - 1
    total = np.zeros(n * size, np.int64)
    step = 1 << 20
    for begin in range(0, len(raw) - 2, step):
        end = min(begin + step, len(raw) - 2)
        b = raw[begin : end + 2].astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
        first = int(np.searchsorted(at, begin, "right")) - 1
        last = int(np.searchsorted(at, end - 1, "right")) - 1
        bounds = np.clip(at[first : last + 2], begin, end)
        row = np.repeat(np.arange(first, last + 1), np.diff(bounds))
        place = np.arange(begin, end)
        inside = place + 2 < at[row + 1]
        key = row[inside] * size + code[inside]
        low = first * size
        part = np.bincount(key - low, minlength=(last - first + 1) * size)
        total[low : low + len(part)] += part
    out = np.empty((n, FEATURES), np.float32)
    out[:, :size] = _DAMPED[np.minimum(total, 255)].reshape(n, size)
    out[:, size:] = _DAMPED[repeats(raw, at)][:, None]
    return out


def repeats(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of 255 words repeat the word before them, per text."""
    starts, first = word_spans(raw, at, _WORD_BYTES)
    if not len(starts):
        return np.zeros(len(at) - 1, np.int64)
    words = word_hashes(raw, starts, _WORD_BYTES)
    same = np.concatenate([[0], words[1:] == words[:-1]]).astype(np.int64)
    same[first[:-1][first[:-1] < len(same)]] = 0
    upto = np.concatenate([[0], np.cumsum(same)])
    return 255 * (upto[first[1:]] - upto[first[:-1]]) // np.maximum(np.diff(first), 1)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text", 4 << 20):
        for begin in range(0, part.num_rows, BLOCK):
            yield part.slice(begin, BLOCK)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for part in _blocks(batch):
            seen += np.count_nonzero(counts(*buffers(part.column("text"))), axis=0)
            n += part.num_rows
    yield pa.record_batch(
        [pa.array(np.append(np.arange(len(seen)), -1)), pa.array(np.append(seen, n))],
        names=["feature", "seen"],
    )


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _blocks(batch):
            rows = counts(*buffers(part.column("text")))
            yield pa.record_batch(
                [pa.array([r.tobytes() for r in rows], pa.binary()), part.column("label"), part.column("weight")],
                names=["features", "label", "weight"],
            )


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _directions(x: np.ndarray, rank: int) -> np.ndarray:
    """The main right singular directions of a bounded matrix, by a randomised range finder."""
    start = np.random.Generator(np.random.PCG64(3)).standard_normal((x.shape[1], rank + 12), np.float32)
    basis = x @ start
    for _ in range(4):
        basis = np.linalg.qr(x @ (x.T @ basis))[0]
    return np.linalg.svd(basis.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def fit(docs: DataFrame, sample: DataFrame) -> dict:
    """Feature weights from all documents; directions, vectors and votes from the sample."""
    seen = np.zeros(FEATURES, np.int64)
    total = 0
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    for feature, n in texts.mapInArrow(_document_counts, "feature long, seen long").groupBy("feature").agg(
        F.sum("seen")
    ).collect():  # a row per feature, whatever the number of documents
        if feature < 0:
            total = n
        else:
            seen[feature] = n
    rarity = np.log((total + 1) / (seen + 1)).astype(np.float32) + np.float32(0.1)
    rows = sample.select("text", "label", "weight").mapInArrow(
        _sample_counts, "features binary, label int, weight double"
    ).toArrow()
    model = {"rarity": rarity, "label": np.zeros(0, np.float32), "weight": np.zeros(0, np.float32)}
    if rows.num_rows:
        x = np.stack([np.frombuffer(f.as_py(), np.float32) for f in rows["features"]])
        x = _unit(x * rarity)
        rank = min(RANK, rows.num_rows)
        model["directions"] = _directions(x, rank)
        model["vectors"] = _unit(x @ model["directions"])
        model["label"] = rows["label"].to_numpy().astype(np.float32)
        model["weight"] = rows["weight"].to_numpy().astype(np.float32)
    return model


def votes(model: dict, features: np.ndarray) -> np.ndarray:
    """The score of each row of features: its nearest neighbours' labels, weighted by similarity."""
    labels = model["label"]
    if not len(labels):
        return np.full(len(features), 0.5)
    vectors = _unit(_unit(features * model["rarity"]) @ model["directions"])
    near = vectors @ model["vectors"].T
    k = min(NEIGHBOURS, len(labels))
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    power = np.maximum(np.take_along_axis(near, best, 1), 1e-6).astype(np.float64) ** SHARPNESS
    power *= model["weight"][best]
    score = (power * labels[best]).sum(1) / power.sum(1)
    return np.where(features.any(axis=1), score, 0.0)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                score = votes(model.value, counts(*buffers(part.column("text"))))
                yield pa.record_batch([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
                  per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text).

    The model learns from ``labels.quality`` of documents outside fold ``held``.
    Texts of fewer than three bytes, empty and null ones have no features and
    score 0; without any labels every other text scores 0.5.  A null doc_id is
    not held out.  Other columns are ignored; rows that repeat are all returned.
    """
    train = fold(folds) != held
    sample = labelled_sample(docs, labels, "quality", per_class, train)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
