"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the ``k`` smallest distinct 64-bit hashes of a text's
shingles of five words (A-Z lower-cased, ASCII white space between words), as
lowercase hex, 16 digits a hash, ascending. Fewer hashes than ``k`` mean that
the sketch holds the whole set. The sketch of a whole is the merge of those of
its parts, so parts can be fingerprinted apart.

``fingerprint_edits`` gives each document its fingerprint, that of the text
with its last quarter replaced by the beginning of the next document, and the
likeness to that and to the next document. Null texts are empty and have the
empty fingerprint; two empty ones have likeness 1, one empty one 0. Rows with
a null doc_id come before all others; rows of one doc_id are ordered by text.
A lone document is its own next one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .coded import slices
from .common import range_of, ranges
from .shingles import shingle_set, shingle_sets

K = 128
WIDTH = 5
LEAST = -(1 << 63)
TEXT_PER_RANGE = 16 << 20

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def sketch(text: str | None, k: int = K, width: int = WIDTH) -> np.ndarray:
    return shingle_set(text, width)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two texts' shingles."""
    return np.union1d(a, b)[:k]


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    both = merge(a, b, k)
    return len(np.intersect1d(both, np.intersect1d(a, b, True), True)), len(both)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness, exact when both sketches hold whole sets."""
    common, both = _shared(a, b, k)
    return common / both if both else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / float(a[k - 1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_hex(a: np.ndarray) -> str:
    return a.astype(">u8").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def merged_fingerprints(df: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """One fingerprint per key from those of its parts (column ``fingerprint``).

    Only the k smallest hashes of a key leave each task, so a key with any
    number of parts is merged in bounded space.
    """
    n = F.length("fingerprint") / F.lit(16)
    starts = F.sequence(F.lit(0), (n - 1).cast("int"))
    hashes = F.when(n > 0, F.transform(starts, lambda i: F.substring(F.col("fingerprint"), i * 16 + 1, F.lit(16))))
    parts = df.select(*keys, F.explode_outer(hashes).alias("hash")).distinct()
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("hash"))))
    lists = ranked.where(F.col("rank") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    return lists.select(*keys, F.array_join("hashes", "").alias("fingerprint"))


def _edited(k: int, width: int):
    """Rows come as (range, next, doc_id, text) in order; each is paired with the one after it."""

    def run(batches):
        held = None  # (range, doc_id, text, sketch)
        for batch in (part for whole in batches for part in slices(whole)):
            pairs = []  # (held, next row)
            for r, is_next, doc_id, text, own in zip(
                *(batch.column(c).to_pylist() for c in ("range", "next", "doc_id", "text")), shingle_sets(batch.column("text"), width)
            ):
                row = (r, doc_id, text or "", own[:k])
                if held is not None and held[0] == r:
                    pairs.append((held, row))
                    held = None if is_next else row
                else:  # after the row that opens the next range, its equals are not needed
                    held = None if is_next else row
            cuts = [len(a[2]) // 4 for a, _ in pairs]
            edited = [a[2][: len(a[2]) - c] + b[2][:c] for (a, b), c in zip(pairs, cuts)]
            changed = shingle_sets(pa.array(edited, pa.large_string()), width)
            rows = [_row(a, b, text, new[:k], k) for (a, b), text, new in zip(pairs, edited, changed)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return run


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(x, pa.string()) for x in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(x, pa.float64()) for x in ("near_edited", "near_next")]
)


def _row(held, after, edited: str, changed: np.ndarray, k: int) -> tuple:
    _, doc_id, text, own = held
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_hex(own), to_hex(changed),
        resemblance(own, changed, k), resemblance(own, after[3], k),
    )


def fingerprint_edits(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of their edited texts; columns as in ``RESULT``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("k"))
    bounds = ranges(docs.select("k", F.length("text").alias("n")), "k", "n", TEXT_PER_RANGE)
    docs = docs.withColumn("range", range_of(F.col("k"), bounds))
    # The first document of a range also goes to the range before it (that of the first to the last one): one row a range.
    first = sorted(docs.groupBy("range").agg(F.min("k").alias("k")).collect())
    to = [(r["k"], first[i - 1]["range"]) for i, r in enumerate(first)]
    opens = F.broadcast(spark.createDataFrame(to, "k long, before int"))
    places = F.filter(
        F.array(F.struct(F.col("range"), F.lit(0).alias("next")), F.struct(F.col("before").alias("range"), F.lit(1).alias("next"))),
        lambda x: x["range"].isNotNull(),
    )
    rows = docs.join(opens, "k", "left").select("doc_id", "text", "k", F.explode(places).alias("place"))
    rows = rows.select("place.range", "place.next", "doc_id", "text", "k").repartitionById(len(bounds) + 1, F.col("range"))
    rows = rows.sortWithinPartitions("range", "next", "k", "text").select("range", "next", "doc_id", "text")
    return rows.mapInArrow(_edited(k, width), RESULT)
