"""Packing documents into fixed windows by non-negative least squares.

1. Every document is encoded once (``tokenizers`` file, end id after it) and
   cut into whole windows and one rest. The pieces are written with their ids,
   the task's number and their rank among the task's pieces of that length.
2. The histogram of lengths (at most ``window`` numbers) goes to the driver.
   All combinations of one, two or three lengths that fill the window exactly
   are columns of a matrix; how often each is used is the solution of a
   non-negative least-squares problem against the histogram, by accelerated
   projected gradients. Counts are rounded and never exceed what is there;
   what is left is packed greedily, longest first, each gap taking the
   longest length that fits.
3. The result is a short list of patterns (lengths, repeats). A piece's global
   rank among those of its length names the pattern, sequence and offset, so
   pieces are placed without moving any of them. Ranks come from one count per
   task and length.

Null texts are empty texts and hold the end id only. A null doc_id is carried
along; repeated rows are packed each. Other columns are ignored. An empty
table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe_ids import encoder, with_end
from .coded import slices
from .common import staged

WINDOW = 1024
STEPS = 400  # of the least-squares solver

PIECES = (
    "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, rank long, token_ids array<int>"
)


def _cut(path: str, end_id: int, window: int):
    def run(batches):
        coder = encoder(path)
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in (part for whole in batches for part in slices(whole)):
            ids, counts = with_end(*coder.encode(batch.column("text").to_pylist()), end_id)
            rows, data, base = [], memoryview(ids.tobytes()), 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                for start in range(0, n, window):
                    length = min(window, n - start)
                    crc = zlib.crc32(data[(base + start) * 4 : (base + start + length) * 4])
                    rows.append((doc_id, start, length, crc, n, task, seen[length]))
                    seen[length] += 1
                base += n
            lengths = np.array([r[2] for r in rows], dtype=np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank", "token_ids"],
            )

    return run


def combinations_filling(lengths: np.ndarray, window: int) -> np.ndarray:
    """All multisets of up to three of ``lengths`` that add up to ``window``, as rows padded with 0."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    found = [np.array([[window, 0, 0]])] if there[window] else []
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    two = (a >= b) & (a + b == window)
    found.append(np.stack([a[two], b[two], np.zeros(two.sum(), dtype=int)], 1))
    rest = window - a - b
    three = (a >= b) & (rest > 0) & (rest <= b)
    three &= there[np.clip(rest, 0, window)]
    found.append(np.stack([a[three], b[three], rest[three]], 1))
    return np.concatenate(found).astype(np.int64)


def solve(columns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that makes the lengths used by ``columns`` nearest to ``histogram``, longer lengths weighing more."""
    window = len(histogram) - 1
    weight = np.sqrt(np.arange(window + 1) / window)
    weight[0] = 0.0
    scale = max(histogram.max(), 1)
    target = weight * histogram / scale

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(columns[:, i], x, window + 1) for i in range(columns.shape[1]))
        return weight * total

    def back(r: np.ndarray) -> np.ndarray:
        wr = weight * r
        return sum(wr[columns[:, i]] for i in range(columns.shape[1]))

    probe = np.ones(len(columns))  # power iteration for the step size
    for _ in range(12):
        probe = back(used(probe))
        norm = np.linalg.norm(probe)
        probe /= max(norm, 1e-300)
    x = moved = np.zeros(len(columns))
    t = 1.0
    for _ in range(steps):
        following = np.maximum(0.0, moved - back(used(moved) - target) / (1.05 * norm))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        moved = following + (t - 1) / t_next * (following - x)
        x, t = following, t_next
    return x * scale


def patterns(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that together hold every piece of the histogram exactly once."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    made: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        made.append(((window,), int(left[window])))
        left[window] = 0
    lengths = np.flatnonzero(left)
    if len(lengths):
        columns = combinations_filling(lengths, window)
        if len(columns):
            x = solve(columns, left.astype(float))
            for i in np.argsort(-x, kind="stable"):
                repeats = int(round(x[i]))
                if not repeats:
                    break
                need = Counter(int(v) for v in columns[i] if v)
                repeats = min([repeats, *(int(left[v]) // k for v, k in need.items())])
                if repeats:
                    made.append((tuple(sorted(need.elements(), reverse=True)), repeats))
                    for v, k in need.items():
                        left[v] -= k * repeats
    while (lengths := np.flatnonzero(left)).size:
        # Longest first; each gap takes the longest length that fits, as often as all of the pattern are there.
        need: Counter[int] = Counter()
        room = window
        while room and (fits := lengths[: np.searchsorted(lengths, room, side="right")]).size:
            free = [int(v) for v in fits[::-1][:64] if left[v] > need[int(v)]] or [int(v) for v in fits[::-1] if left[v] > need[int(v)]]
            if not free:
                break
            need[free[0]] += 1
            room -= free[0]
        repeats = min(int(left[v]) // k for v, k in need.items())
        made.append((tuple(sorted(need.elements(), reverse=True)), repeats))
        for v, k in need.items():
            left[v] -= k * repeats
    return made


def _slots(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first, offset) of every place in a pattern."""
    taken: Counter[int] = Counter()
    out, sequence = [], 0
    for lengths, repeats in made:
        offset = 0
        for v in lengths:
            out.append((v, taken[v], taken[v] + repeats - 1, sequence, offset))
            taken[v] += repeats
            offset += v
        sequence += repeats
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with ids, sequence_id and offset."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = staged(spark, docs.mapInArrow(_cut(tokenizer, end_id, window), PIECES), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = staged(spark, counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("first"))
    # Patterns come from at most `window` lengths, so their places are few whatever the input.
    slots = spark.createDataFrame(_slots(patterns(histogram, window)), "v int, low long, high long, sequence long, offset long")
    placed = ranked.join(F.broadcast(slots), F.expr("length = v and rank between low and high"))
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset", "token_ids",
    )
