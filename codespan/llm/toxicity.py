"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max index.

Every example and every text is a vector over all its words, hashed; the words that
labelled toxic documents hold far more often than others have further dimensions of
their own.  Examples are indexed by dimension, in blocks; the largest weight of a word in a
block bounds every cosine there from above, so blocks are opened from the highest
bound down until none can hold a nearer example.  What is skipped cannot matter:
the neighbours are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm import hashing as H
from codespan.llm.labelled import fold, labelled_sample
from codespan.llm.store import by_row, text_key

PER_CLASS = 4000  # labelled documents of each class that the model holds at most
HASHED = 2048  # dimensions that all words are hashed to
VOCABULARY = 512
MARKED = 4.0  # how much the vocabulary counts beside all words
LEAST_CONTEXTS = 5  # different words beside a word of the vocabulary in toxic examples
LEAST_CHI2 = 20.0
LEAST_LIFT = 12.0
NEIGHBOURS = 25
BLOCK = 64  # examples of an index block
SLAB = 16  # blocks that a batch of texts is held against at once
QUERIES = 128  # texts of such a batch
NEAREST = 1e-3  # least distance a vote is divided by
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_PATTERN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vocabulary(sample: DataFrame, size: int = VOCABULARY) -> list[str]:
    """Words that mark the toxic class in the sample, strongest first (at most ``size``).

    A word counts once for every different word it follows, or stands before if those
    are more, so that copies of one document, which repeat its words in place, are no
    evidence, and the outer words of a fixed phrase are.
    """
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = sample.select("label", F.array_remove(F.split(folded, _PATTERN, -1), "").alias("w"))
    pairs = words.select("label", F.explode(F.arrays_zip(
        F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("after"),
        F.slice(F.concat("w", F.array(F.lit(""))), 2, F.greatest(F.size("w"), F.lit(1))).alias("before"),
    )).alias("pair")).select("label", "pair.word", "pair.after", "pair.before").where("word is not null")
    sides = pairs.groupBy("label", "word").agg(
        F.greatest(F.count_distinct("after"), F.count_distinct("before")).alias("n")
    )
    n = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(n) < 2:
        return []
    n0, n1 = n[0], n[1]
    a, b = F.least("toxic", F.lit(float(n1))), F.least("clean", F.lit(float(n0)))
    c, d = F.lit(n1) - a, F.lit(n0) - b
    chi2 = (n0 + n1) * (a * d - b * c) ** 2 / ((a + b) * (c + d + 1e-9) * n0 * n1)
    lift = (a / n1) / ((b + 0.5) / n0)
    found = (
        sides.groupBy("word")
        .agg(F.sum(F.col("n") * F.col("label")).cast("double").alias("toxic"),
             F.sum(F.col("n") * (1 - F.col("label"))).cast("double").alias("clean"))
        .where(a >= LEAST_CONTEXTS).withColumn("chi2", chi2).where(lift >= LEAST_LIFT)
        .where(F.col("chi2") >= LEAST_CHI2)
        .orderBy(F.desc("chi2"), "word").limit(size)
    )
    return [r[0] for r in found.select("word").collect()]


def _hash_words(words: list[str], table: np.ndarray) -> np.ndarray:
    raw, at = H.buffers(pa.array(words, pa.large_string()))
    return H.word_hashes(raw, at[:-1], table) if len(words) else np.zeros(0, np.uint64)


def term_counts(texts: pa.Array, known: np.ndarray, order: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How often each text holds the words of each hash value, then each word of the vocabulary.

    The vocabulary is given by its hashes, sorted, with their order.
    """
    raw, at = H.buffers(texts)
    starts, first = H.word_spans(raw, at, table)
    n, width = len(at) - 1, HASHED + len(known)
    if not len(starts):
        return np.zeros((n, width), np.float32)
    hashes = H.word_hashes(raw, starts, table)
    row = np.repeat(np.arange(n), np.diff(first)) * width
    cells = [row + (hashes % np.uint64(HASHED)).astype(np.int64)]
    if len(known):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = np.flatnonzero(known[place] == hashes)
        cells.append(row[hit] + HASHED + order[place[hit]])
    return np.bincount(np.concatenate(cells), minlength=n * width).astype(np.float32).reshape(n, width)


def _document_counts(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order, table = words.value
        seen, n = np.zeros(HASHED + len(known), np.int64), 0
        for batch in batches:
            for part in H.slices(batch, "text", 2 << 20):
                seen += np.count_nonzero(term_counts(part.column("text"), known, order, table), axis=0)
                n += part.num_rows
        yield pa.record_batch(
            [pa.array(np.append(np.arange(len(seen)), -1)), pa.array(np.append(seen, n))],
            names=["word", "seen"],
        )

    return run


def _sample_counts(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order, table = words.value
        for batch in batches:
            for part in H.slices(batch, "text", 2 << 20):
                rows = term_counts(part.column("text"), known, order, table)
                yield pa.record_batch(
                    [part.column("doc_id"),
                     pa.array([np.flatnonzero(r).astype(np.int32).tobytes() for r in rows], pa.binary()),
                     pa.array([r[r > 0].tobytes() for r in rows], pa.binary()),
                     part.column("label"), part.column("weight")],
                    names=["doc_id", "places", "counts", "label", "weight"],
                )

    return run


def weigh(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times rarity; a text without known words is all zero."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * rarity
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def vectors(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Unit vectors over all words and, MARKED times as heavy, over the vocabulary."""
    x = np.hstack([weigh(counts[:, :HASHED], rarity[:HASHED]),
                   weigh(counts[:, HASHED:], rarity[HASHED:]) * np.float32(MARKED**0.5)])
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=x, where=size > 0)


class BlockMaxIndex:
    """Examples by word: ``weights[word]`` are its postings, ``most[word]`` their maxima by block."""

    def __init__(self, vectors: np.ndarray):
        # Alike examples together make tight bounds.
        heaviest = vectors.argmax(axis=1) if vectors.size else np.zeros(len(vectors), np.int64)
        self.ids = np.lexsort((heaviest, -np.count_nonzero(vectors, axis=1)))
        n = -(-len(vectors) // BLOCK) * BLOCK
        self.weights = np.zeros((vectors.shape[1], n), np.float32)
        for b in range(0, len(vectors), BLOCK):
            self.weights[:, b : b + BLOCK][:, : len(vectors) - b] = vectors[self.ids[b : b + BLOCK]].T
        self.size = len(vectors)
        self.most = self.weights.reshape(vectors.shape[1], n // BLOCK, BLOCK).max(axis=2)

    @classmethod
    def of(cls, parts: dict) -> BlockMaxIndex:
        """The index with these attributes: what travels to tasks is plain arrays, not this class."""
        index = cls.__new__(cls)
        vars(index).update(parts)
        return index

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine, ties by place in the index, and their cosines."""
        words = np.flatnonzero(query)
        own = query[words]
        bound = own @ self.most[words]
        k = min(k, self.size)
        best_at, best = np.zeros(0, np.int64), np.zeros(0, np.float32)
        for b in np.argsort(-bound, kind="stable"):
            if len(best) == k and bound[b] < best[-1] - 1e-6:
                break
            begin, end = b * BLOCK, min((b + 1) * BLOCK, self.size)
            score = own @ self.weights[words, begin:end]
            at = np.concatenate([best_at, np.arange(begin, end)])
            score = np.concatenate([best, score])
            top = np.lexsort((at, -score))[:k]
            best_at, best = at[top], score[top]
        return self.ids[best_at], best

    def nearest_each(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For every query the k examples of highest cosine and their cosines, nearest first."""
        k = min(k, self.size)
        bound = queries @ self.most
        at, best = np.zeros((len(queries), k), np.int64), np.full((len(queries), k), -1, np.float32)
        for b in range(0, bound.shape[1], SLAB):
            open_ = np.flatnonzero(bound[:, b : b + SLAB].max(axis=1) >= best.min(axis=1) - 1e-6)
            begin, end = b * BLOCK, min((b + SLAB) * BLOCK, self.size)
            score = np.hstack([best[open_], queries[open_] @ self.weights[:, begin:end]])
            place = np.hstack([at[open_], np.broadcast_to(np.arange(begin, end), (len(open_), end - begin))])
            top = np.argpartition(-score, k - 1, axis=1)[:, :k]
            at[open_], best[open_] = np.take_along_axis(place, top, 1), np.take_along_axis(score, top, 1)
        top = np.lexsort((at, -best), axis=1)
        return self.ids[np.take_along_axis(at, top, 1)], np.take_along_axis(best, top, 1)


def fit(docs: DataFrame, sample: DataFrame) -> dict:
    """Vocabulary and examples from the sample, rarity of all words from all documents."""
    table = H.byte_table(SEPARATORS, fold_case=True)
    sample = sample.persist()
    words = vocabulary(sample)
    hashes = _hash_words(words, table)
    order = np.argsort(hashes)
    sent = docs.sparkSession.sparkContext.broadcast((hashes[order], order, table))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    seen, total = np.zeros(HASHED + len(words), np.int64), 0
    for word, n in texts.mapInArrow(_document_counts(sent), "word long, seen long").groupBy("word").agg(
        F.sum("seen")
    ).collect():  # a row per dimension
        if word < 0:
            total = n
        else:
            seen[word] = n
    rarity = np.log((total + 1) / (seen + 1)).astype(np.float32) + np.float32(0.1)
    rows = sample.mapInArrow(
        _sample_counts(sent), "doc_id long, places binary, counts binary, label int, weight double"
    ).toArrow()
    sample.unpersist()
    label, weight = rows["label"].to_numpy(), rows["weight"].to_numpy()
    own = np.zeros((rows.num_rows, len(rarity)), np.float32)
    for x, places, counts in zip(own, rows["places"], rows["counts"]):
        x[np.frombuffer(places.as_py(), np.int32)] = np.frombuffer(counts.as_py(), np.float32)
    for b in range(0, len(own), 512):
        own[b : b + 512] = vectors(own[b : b + 512], rarity)
    plain = ~own.any(axis=1)
    toxic_plain = float((weight * label)[plain].sum())
    return {
        "words": words, "hashes": hashes[order], "order": order, "table": table, "rarity": rarity,
        "index": vars(BlockMaxIndex(own[~plain] if plain.any() else own)), "label": label[~plain], "weight": weight[~plain],
        "doc_id": rows["doc_id"].to_numpy()[~plain],
        # Texts without any word are as near to each other as can be: all of them vote.
        "plain": toxic_plain / float(weight[plain].sum()) if plain.any() else 0.0,
    }


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        index = BlockMaxIndex.of(m["index"])
        for batch in batches:
            for part in H.slices(batch, "text", 2 << 20):
                counts = term_counts(part.column("text"), m["hashes"], m["order"], m["table"])
                score = np.full(len(counts), m["plain"])
                words: list[list[str]] = [[] for _ in score]
                near: list[list[int]] = [[] for _ in score]
                full = np.flatnonzero(counts.any(axis=1)) if index.size else np.zeros(0, np.int64)
                for b in range(0, len(full), QUERIES):
                    own = full[b : b + QUERIES]
                    query = vectors(counts[own], m["rarity"])
                    ids, cosine = index.nearest_each(query, NEIGHBOURS)
                    cosine = np.clip(cosine.astype(np.float64), 1e-6, 1)
                    # An example that is the text itself outvotes all that are merely like it.
                    power = cosine**2 / (1 - cosine + NEAREST) * m["weight"][ids]
                    score[own] = (power * m["label"][ids]).sum(axis=1) / power.sum(axis=1)
                    top = np.argsort(-query[:, HASHED:], axis=1, kind="stable")[:, :5]
                    for i, q, t, n in zip(own, query[:, HASHED:], top, m["doc_id"][ids[:, :3]].tolist()):
                        words[i] = [m["words"][w] for w in t if q[w] > 0]
                        near[i] = n
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("text_key"), pa.array(score),
                     pa.array(words, pa.list_(pa.string())), pa.array(near, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "score", "evidence_words", "evidence_ids"],
                )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0,
                   per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence_words, evidence_ids, text_key of every row.

    The model learns from ``labels.toxic`` of documents outside fold ``held``; votes
    are weighted so that each example counts for the labelled rows it stands for.
    Every text with words is held against all examples; texts without any, empty and
    null ones among them, score the toxic share of labelled texts without any, 0 if
    there are none.  Evidence words are those of the vocabulary.  A
    null doc_id is not held out.  Other columns are ignored; rows that repeat are
    all returned.
    """
    sample = labelled_sample(docs, labels, "toxic", per_class, fold(folds) != held)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = ("doc_id long, text_key long, score double, evidence_words array<string>,"
              " evidence_ids array<long>")
    return rows.mapInArrow(_score(model), schema).select(
        "doc_id",
        F.coalesce(fold(folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence_words",
        "evidence_ids",
        "text_key",
    )


def remove_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    bad = score_toxicity(docs, labels, **options).where("predicted = 1")
    return by_row(docs, bad.select("doc_id", "text_key").distinct(), "left_anti").select(*docs.columns)
