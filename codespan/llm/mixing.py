"""Sources interleaved to target weights by proportionate fair scheduling.

A source's rows come in blocks.  In a fluid that serves all sources at once, each
by its exact weight, its j-th block runs from (j-1)/w to j/w of the fluid's clock;
the clock goes the faster the fewer sources are left, so the shares of the others
are scaled up when one runs out.  Every slot takes, of the blocks that the fluid
has begun by then, the one that it ends first.  At any slot a source has then had
what the fluid gave it to within one block.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codespan.llm.store import text_key

BLOCK_ROWS = 32
QUOTAS = 1000  # slots of a period
BUCKET_ROWS = 512
CHUNK = 256  # blocks whose slots go in one row of the plan


def fluid(blocks: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The clock at which each source runs out, ascending from 0, and the slots passed by then."""
    ends = blocks / weights
    order = np.argsort(ends, kind="stable")
    ends = ends[order]
    left = np.append(np.cumsum(weights[order][::-1])[::-1], 0.0)  # weight of those not yet out
    done = np.append(0, np.cumsum(blocks[order]))
    return np.append(0.0, ends), np.append(0.0, done[1:] + ends * left[1:])


def schedule(blocks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Which source each slot takes, earliest deadline first; every block gets one slot."""
    blocks, weights = np.asarray(blocks, np.int64), np.asarray(weights, np.float64)
    total = int(blocks.sum())
    if not total:
        return np.zeros(0, np.int32)
    source = np.repeat(np.arange(len(blocks), dtype=np.int32), blocks)
    j = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    clock, passed = fluid(blocks, weights)
    begun = np.interp(j / weights[source], clock, passed)
    # What rounding of floats moves off a whole slot is moved back.
    release = np.floor(begun + 1e-6).astype(np.int64)
    due = (j + 1) / weights[source]
    order = np.lexsort((source, due, release))
    release, due, source = release[order].tolist(), due[order].tolist(), source[order].tolist()
    out = np.empty(total, np.int32)
    ready: list[tuple[float, int]] = []
    at = 0
    for slot in range(total):
        while at < total and (release[at] <= slot or not ready):
            heapq.heappush(ready, (due[at], source[at]))
            at += 1
        out[slot] = heapq.heappop(ready)[1]
    return out


def period(quotas: dict[str, int]) -> list[str]:
    """Which source each slot of one period of whole quotas takes."""
    names = sorted(quotas)
    own = np.array([quotas[s] for s in names], np.int64)
    return [names[i] for i in schedule(own, own)]


def quotas(weights: dict[str, float], total: int = QUOTAS) -> dict[str, int]:
    """Whole quotas of at least 1 in proportion to the weights, by largest remainder."""
    weights = {s: w for s, w in weights.items() if w > 0}
    if not weights:
        return {}
    scale = total / sum(weights.values())
    out = {s: max(1, int(w * scale)) for s, w in weights.items()}
    for s in sorted(weights, key=lambda s: (int(weights[s] * scale) - weights[s] * scale, s)):
        if sum(out.values()) >= total:
            break
        out[s] += 1
    return out


def plan(rows_of: pa.Table, share: np.ndarray, block_rows: int) -> pa.Table:
    """p_lane, p_chunk, p_slots: the slots of every CHUNK blocks of every lane."""
    blocks = -(-rows_of["n"].to_numpy() // block_rows)
    taken = schedule(blocks, share)
    slots = np.argsort(taken, kind="stable")  # by lane, in order
    chunks = -(-blocks // CHUNK)
    lane = np.repeat(np.arange(len(blocks)), chunks)
    chunk = np.arange(len(lane)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    size = np.minimum(blocks[lane] - chunk * CHUNK, CHUNK)
    return pa.table({
        "p_lane": rows_of["lane"].combine_chunks().take(pa.array(lane)),
        "p_chunk": pa.array(chunk, pa.int64()),
        "p_slots": pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(slots, pa.int64())),
    })


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
        block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """``docs`` with mix_slot and mix_position added: the order of training.

    Inside a source the order is that of a hash of the row.  Without ``weights``
    a source's is its number of rows to the power ``temperature``.  Every source is
    scheduled by itself; only those that ``weights`` leaves out share one lane, whose
    weight is that under the empty name, else the least of all.  A null source is
    the one with the empty name.  Every row gets exactly one place; rows that
    repeat get one each.  The driver holds a few numbers for each block.
    """
    added = {"mix_slot", "mix_position"}
    columns = [c for c in docs.columns if c.lower() not in added]
    spark = docs.sparkSession
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    h = F.xxhash64(F.lit(seed), "doc_id", text_key())
    lane = name if weights is None else F.when(name.isin(list(weights)), name).otherwise(F.lit(""))
    laned = docs.select(*columns, lane.alias("_lane"), h.alias("_h"))
    rows_of = laned.groupBy(F.col("_lane").alias("lane")).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("lane")
    n = rows_of["n"].to_numpy()
    if weights is None:
        share = n.astype(np.float64) ** temperature
    else:
        least = min(weights.values(), default=1.0)
        share = np.array([weights.get(s, least) for s in rows_of["lane"].to_pylist()], np.float64)
    lanes = spark.createDataFrame(
        plan(rows_of, np.maximum(share, 1e-9), block_rows), "p_lane string, p_chunk long, p_slots array<long>"
    )

    bits = max(0, min(40, (int(n.max(initial=1)) // BUCKET_ROWS).bit_length()))
    bucket = F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long")
    laned = laned.withColumn("_bucket", bucket)
    before = Window.partitionBy("_lane").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laned.groupBy("_lane", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_lane", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_lane", "_bucket").orderBy("_h", F.col("doc_id"))
    placed = laned.withColumn("_in", F.row_number().over(inside)).join(offsets, ["_lane", "_bucket"])
    number = F.col("_before") + F.col("_in") - 1
    placed = placed.withColumn("_block", F.floor(number / block_rows).cast("long")).withColumn(
        "_rest", number % block_rows
    )
    slotted = placed.join(
        lanes,
        (F.col("_lane") == F.col("p_lane")) & (F.floor(F.col("_block") / CHUNK) == F.col("p_chunk")),
    )
    slot = F.get("p_slots", (F.col("_block") % CHUNK).cast("int"))
    return slotted.select(
        *columns, slot.cast("long").alias("mix_slot"), (slot * block_rows + F.col("_rest")).cast("long").alias("mix_position")
    )
