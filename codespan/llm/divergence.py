"""How far sources differ in their words: divergences of term rates, priced over joint tables of counts.

Every kept term of a language is a row of indicators, one column per (group, count
level).  Blocks of such rows are multiplied by their own transpose; the products are
the joint tables of the levels of every two groups, and since the divergence of two
groups depends on the levels alone, each cell is priced once for all its terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codespan.llm.hashing import buffers, slices
from codespan.llm.store import keep
from codespan.operators.numbering import number_rows

LEAST_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
GROUPS = 64  # groups in a block of columns: a product holds the groups of two blocks
COLUMNS = 1024  # indicator columns in a product
ROWS = 8192  # terms in a product; far below 2**24, up to which float32 counts exactly

SLICE = 16 << 20  # bytes of text counted at a time
CELL = np.dtype([("source", "<i8"), ("n", "<i4")])  # a count of one such slice, packed

# Bytes of the letters: A-Z as a-z, a-z, and all of a character outside ASCII.
_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in order, and the text that each stands in."""
    raw, at = buffers(texts)
    folded = _FOLD[raw]
    inside = folded != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(raw)]  # a text's first letter begins a term
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    letters = folded[inside].tobytes()
    words = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters)]
    )
    return words, np.searchsorted(at, starts, "right") - 1


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cells that a column of packed cells holds, and how many each row has."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, CELL, (at[-1] - at[0]) // CELL.itemsize, at[0]), np.diff(at) // CELL.itemsize


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term, docs, cells: of some megabytes of texts, the documents with a term and its counts by source."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words, row = terms(part.column("text"))
            if not len(words):
                continue
            word, vocabulary = _codes(words)
            lang, langs = _codes(part.column("lang"))
            keys, source = np.unique(part.column("source").to_numpy(), return_inverse=True)
            # Occurrences per (term, row); then rows and occurrences per (term, lang, source).
            pairs, times = np.unique(word * part.num_rows + row, return_counts=True)
            word, row = np.divmod(pairs, part.num_rows)
            cell = (word * len(langs) + lang[row]) * len(keys) + source[row]
            order = np.argsort(cell, kind="stable")
            cell, times = cell[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            docs = np.diff(np.append(first, len(cell)))
            cell, times = cell[first], np.add.reduceat(times, first)
            pair, own = np.divmod(cell, len(keys))
            head = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            packed = np.empty(len(cell), CELL)
            packed["source"], packed["n"] = keys[own], times
            offsets = (np.append(head, len(cell)) * CELL.itemsize).astype(np.int32)
            here, tongue = np.divmod(pair[head], len(langs))
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(tongue)), vocabulary.take(pa.array(here)).cast(pa.string()),
                pa.array(np.add.reduceat(docs, head), pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed.tobytes())]),
            ], names=["lang", "term", "docs", "cells"])


def _kept(least_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, term, all_n, sources, counts of the terms in enough documents, from rows sorted by (lang, term).

    Rows of one term are added up batch by batch; what the last term of a batch has
    so far goes with the next one, so a task holds a batch and one term's sources.
    """

    def totals(lang: pa.Array, term: pa.Array, docs: np.ndarray, source: np.ndarray, n: np.ndarray, sizes: np.ndarray):
        """The rows of each term as one: its first row, documents, sources, counts, and number of sources."""
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        group = np.repeat(np.cumsum(np.concatenate([[True], ~same])) - 1, sizes)
        keys, code = np.unique(source, return_inverse=True)
        cell = group * len(keys) + code
        order = np.argsort(cell, kind="stable")
        cell, n = cell[order], n[order]
        head = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        group, code = np.divmod(cell[head], len(keys))
        return first, np.add.reduceat(docs, first), keys[code], np.add.reduceat(n, head), np.bincount(group, minlength=len(first))

    def shown(lang: pa.Array, term: pa.Array, docs: np.ndarray, source: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        enough = docs >= least_docs
        inside = np.repeat(enough, sizes)
        source, n = source[inside], n[inside]
        offsets = np.concatenate([[0], np.cumsum(sizes[enough])]).astype(np.int32)
        chosen = pa.array(np.flatnonzero(enough))
        total = np.add.reduceat(n, offsets[:-1]) if len(n) else n
        return pa.RecordBatch.from_arrays([
            lang.take(chosen), term.take(chosen), pa.array(total, pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(source, pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64())),
        ], names=["lang", "term", "all_n", "sources", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, sizes = _cells(batch.column("cells"))
            now = [batch.column("lang"), batch.column("term"), batch.column("docs").to_numpy(),
                   cells["source"], cells["n"].astype(np.int64), sizes]
            if held:
                now = [pa.concat_arrays([a, b]) if isinstance(b, pa.Array) else np.concatenate([a, b])
                       for a, b in zip(held, now, strict=True)]
            first, docs, source, n, sizes = totals(*now)
            rows = pa.array(first)
            whole = [now[0].take(rows), now[1].take(rows), docs, source, n, sizes]
            last = len(source) - sizes[-1]
            held = [whole[0][-1:], whole[1][-1:], docs[-1:], source[last:], n[last:], sizes[-1:]]
            yield shown(whole[0][:-1], whole[1][:-1], docs[:-1], source[:last], n[:last], sizes[:-1])
        if held:
            yield shown(*held)

    return run


def _prices(counts: np.ndarray, size: int, kept: int) -> np.ndarray:
    """p of each count in a group of ``size`` occurrences; whole numbers of any size on the way."""
    return np.array([1 + UNIT * (int(c) + 2) // (size + 2 * kept) for c in counts], np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q are below 2**31, so the square fits."""
    return (p - q) * (p - q) // (p + q)


def level_products(counts: np.ndarray, sizes: np.ndarray, kept: int) -> np.ndarray:
    """Groups x groups: the divergence of every two groups, summed over the terms (rows) of ``counts``.

    The rows are ordered by size, so that a block of them has few levels, and cut
    into blocks of at most COLUMNS levels of all groups together.
    """
    total = np.zeros((len(sizes), len(sizes)), np.int64)
    counts = counts[np.lexsort((counts.max(axis=1), counts.sum(axis=1)))]
    begin = 0
    while begin < len(counts):
        rows = min(ROWS, len(counts) - begin)
        while True:
            block = counts[begin : begin + rows]
            levels = [np.unique(c, return_inverse=True) for c in block.T]
            width = sum(len(v) for v, _ in levels)
            if width <= COLUMNS or rows == 1:
                break
            rows = max(1, min(rows // 2, rows * COLUMNS // width))
        at = np.concatenate([[0], np.cumsum([len(v) for v, _ in levels])])
        shown = np.zeros((rows, width), np.float32)
        for g, (_, inverse) in enumerate(levels):
            shown[np.arange(rows), at[g] + inverse] = 1
        joint = (shown.T @ shown).astype(np.int64)  # the joint table of every two groups' levels
        p = np.concatenate([_prices(v, int(sizes[g]), kept) for g, (v, _) in enumerate(levels)])
        cost = joint * divergence(p[:, None], p[None, :])
        total += np.add.reduceat(np.add.reduceat(cost, at[:-1], axis=0), at[:-1], axis=1)
        begin += rows
    return total


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, a, b, value, seen: the divergence of two groups over the terms of a batch.

    The row of a block's first two groups also says how many terms were seen.
    """
    for batch in batches:
        rows = batch.to_pandas()
        for (lang, low, high), part in rows.groupby(["lang", "low", "high"], sort=False):
            sizes = np.asarray(part["sizes"].iloc[0], np.int64)
            slots = part["slots"].to_numpy()
            lengths = [len(s) for s in slots]
            counts = np.zeros((len(part), len(sizes)), np.int64)
            counts[np.repeat(np.arange(len(part)), lengths), np.concatenate(slots)] = np.concatenate(part["counts"].to_numpy())
            value = level_products(counts, sizes, int(part["kept"].iloc[0]))
            a, b = (np.triu_indices(len(sizes), 1) if low == high else
                    tuple(x.ravel() for x in np.meshgrid(np.arange(GROUPS), np.arange(GROUPS, len(sizes)), indexing="ij")))
            number = lambda s: np.where(s < GROUPS, low * GROUPS + s, high * GROUPS + s - GROUPS)
            if not len(a):
                continue
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "lang": lang, "a": number(a), "b": number(b), "value": value[a, b], "seen": len(part),
            }), preserve_index=False)


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how each (lang, source) group differs from others.

    Terms are runs of letters and of characters outside ASCII, A-Z lower-cased.  A
    language keeps those in ``least_docs`` of its documents, V of them.  A group
    with N occurrences of kept terms gives each the rate p = 1 + floor(10^9 *
    (count + 2) / (N + 2V)); two rates differ by f = floor((p - q)^2 / (p + q)).
    Part ``pair`` has every other source of the language, valued by f summed over
    all kept terms; part ``term`` the ``top`` kept terms of the group whose rate
    exceeds that of the whole language, valued by f.  Ranks go by value
    descending, then item in byte order, so that they have no ties.

    Null text, lang and source count as empty; every occurring group is listed
    (without kept terms its pairs are 0), repeated rows count each, no rows give
    no rows.  Texts of any length are counted some megabytes at a time, a longer
    one alone.  Only counts leave the task that read a text, one row per term.  Other columns are ignored whatever their names.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    names = keep(rows.select("lang", "source").distinct())
    key = source_key(names)
    parts = rows.withColumn("source", key).mapInArrow(_counted, "lang string, term string, docs long, cells binary")
    vectors = keep(
        parts.repartition("lang", "term").sortWithinPartitions("lang", "term")
        .mapInArrow(_kept(least_docs), "lang string, term string, all_n long, sources array<long>, counts array<long>")
    )
    langs = vectors.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all_n").alias("lang_size"))
    held = vectors.select("lang", "term", "all_n", F.inline(F.arrays_zip(F.col("sources").alias("key"), F.col("counts").alias("n"))))
    sizes = held.groupBy("lang", "key").agg(F.sum("n").alias("size"))
    groups = keep(number_rows(
        names.withColumn("key", key).join(sizes, ["lang", "key"], "left").join(langs, "lang", "left").select(
            "lang", "source", "key", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "kept", "lang_size")]),
        ["source"], "number", group=["lang"], start=0,
    ))
    pairs = _pair_values(held, groups)
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    both = pairs.union(pairs.select("lang", "b", "a", "value"))
    pair = (
        both.join(groups.select("lang", F.col("number").alias("a"), "source"), ["lang", "a"])
        .join(other, ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    rated = held.join(groups, ["lang", "key"]).select(
        "lang", "source", F.col("term").alias("item"), _rate("n", "size").alias("p"), _rate("all_n", "lang_size").alias("q"),
    ).where("p > q")
    term = rated.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.withColumn("rank", F.row_number().over(order)).union(ranked)


def source_key(names: DataFrame) -> Column:
    """64 bits of ``source`` that are different for all sources of ``names``."""
    seed = 0
    while True:
        key = F.xxhash64(F.lit(seed), "source")
        if names.select("source").distinct().groupBy(key).count().where("count > 1").isEmpty():
            return key
        seed += 1


def _rate(n: str, size: str) -> Column:
    """1 + floor(10^9 (n + 2) / (size + 2 kept)), in wider numbers only where a long would overflow."""
    plain = f"{UNIT} * ({n} + 2) div ({size} + 2 * kept)"
    wide = f"{UNIT} * cast({n} + 2 as decimal(28,0)) div cast({size} + 2 * kept as decimal(28,0))"
    return F.expr(f"1 + case when {n} < 9000000000 then {plain} else {wide} end")


def _pair_values(held: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value: the divergence of all groups a, b (numbers, each pair once) of a language.

    The groups of a language lie in blocks of GROUPS; a term goes to every two
    blocks of which one has it, as the counts of those two alone.  Terms that
    neither block has cost f of the two empty rates and are added at the end.
    """
    block = F.floor(F.col("number") / GROUPS).cast("int")
    placed = groups.withColumn("block", block).withColumn("slot", (F.col("number") % GROUPS).cast("int"))
    blocks = placed.groupBy("lang").agg(F.max("block").alias("last"))
    # Of every block pair that holds a block: its own place there is first (low) or second (high).
    spread = F.explode(F.transform(F.sequence(F.lit(0), F.col("last")), lambda o: F.struct(
        F.least(o, F.col("block")).alias("low"), F.greatest(o, F.col("block")).alias("high"),
        F.when(F.col("block") <= o, F.col("slot")).otherwise(F.col("slot") + GROUPS).alias("slot"))))
    dealt = placed.join(blocks, "lang").select("lang", "key", "size", "kept", spread.alias("s")).select(
        "lang", "key", "size", "kept", "s.low", "s.high", "s.slot")
    shape = dealt.groupBy("lang", "low", "high").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "size"))), lambda s: s["size"]).alias("sizes"),
        F.first("kept").alias("kept"),
    )
    vectors = (
        held.join(dealt.select("lang", "key", "low", "high", "slot"), ["lang", "key"])
        .groupBy("lang", "term", "low", "high")
        .agg(F.collect_list(F.struct("slot", "n")).alias("cells"))
        .select("lang", "low", "high", F.col("cells.slot").alias("slots"), F.col("cells.n").alias("counts"))
        .join(shape, ["lang", "low", "high"])
        .select("lang", "low", "high", "slots", "counts", "sizes", "kept")
    )
    priced = vectors.mapInArrow(_priced, "lang string, a long, b long, value long, seen long")
    seen = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    left = groups.select("lang", F.col("number").alias("a"), F.col("size").alias("a_size"), "kept")
    right = groups.select(F.col("lang").alias("b_lang"), F.col("number").alias("b"), F.col("size").alias("b_size"))
    every = left.join(right, (F.col("lang") == F.col("b_lang")) & (F.col("a") < F.col("b"))).drop("b_lang")
    empty = lambda size: F.expr(f"case when kept > 0 then 1 + {2 * UNIT} div ({size} + 2 * kept) end")
    p, q = empty("a_size"), empty("b_size")
    rest = every.join(seen, ["lang", "a", "b"], "left").withColumn("p", p).withColumn("q", q)
    return rest.select("lang", "a", "b", F.expr(
        "coalesce(value, 0) + coalesce((kept - coalesce(seen, 0)) * ((p - q) * (p - q) div (p + q)), 0)"
    ).alias("value"))
