"""Token ids as ORC files: ordered by document, prunable and readable by stripe.

``write_tokens`` encodes texts and writes one ORC file for each range of
doc_id, in ascending order: integers are run-length encoded, every stripe has
row indexes, and Bloom filters on ``doc_id`` let a reader skip stripes and row
groups that a document is not in. ``read_tokens`` is the ordinary ORC reader,
so files are read in parallel by stripe. ``token_digest`` adds each document's
place in the whole id stream, from the files alone.

Null texts are empty texts and hold the end id only; rows with a null doc_id
come first; repeated doc_ids keep all their rows, ordered by text. Other
columns are ignored. An empty table gives no files' rows and an empty digest.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelstar.session import checkpoint_dir

from .bpe_ids import encoder, with_end
from .coded import slices
from .common import range_of, ranges

SCHEMA = "range int, pos long, doc_id long, n_tokens int, token_ids array<int>"
LEAST = -(1 << 63)
TEXT_PER_FILE = 32 << 20  # characters; a file holds about half as many bytes
ORC = {
    "orc.compress": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _encoded(path: str, end_id: int):
    def run(batches):
        coder, pos, at = encoder(path), 0, None
        for batch in (part for whole in batches for part in slices(whole)):
            ids, counts = with_end(*coder.encode(batch.column("text").to_pylist()), end_id)
            places = []
            for r in batch.column("range").to_pylist():
                pos = pos + 1 if r == at else 0
                at = r
                places.append(pos)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("range"), pa.array(places, pa.int64()), batch.column("doc_id"), pa.array(counts.astype(np.int32)), lists],
                names=["range", "pos", "doc_id", "n_tokens", "token_ids"],
            )

    return run


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Write the ids of ``docs`` (doc_id, text) with ``end_id`` after each document to ORC files under ``path``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = ranges(docs.select("doc_id", F.length("text").alias("n")), "doc_id", "n", TEXT_PER_FILE)
    dealt = docs.withColumn("range", range_of(F.col("doc_id"), bounds)).repartitionById(len(bounds) + 1, F.col("range"))
    rows = dealt.sortWithinPartitions("range", F.coalesce("doc_id", F.lit(LEAST)), "text")
    rows.select("range", "doc_id", "text").mapInArrow(_encoded(tokenizer, end_id), SCHEMA).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def _checksums(batches):
    for batch in batches:
        lists = batch.column("token_ids")
        ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        offsets = lists.offsets.to_numpy()
        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("range"), batch.column("pos"), batch.column("doc_id"), batch.column("n_tokens").cast(pa.int64()), pa.array(sums, pa.int64())],
            names=["range", "pos", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    files = read_tokens(spark, path)
    rows = files.mapInArrow(_checksums, "range int, pos long, doc_id long, n_tokens long, ids_crc32 long")
    # One total a range: at most MAX_RANGES rows, whatever the input.
    totals = sorted(files.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect())
    first, base = 0, []
    for r in totals:
        base.append((r["range"], first))
        first += r["n"]
    bases = F.broadcast(spark.createDataFrame(base, "range int, base long"))
    own = Window.partitionBy("range").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(own), F.lit(0))
    return rows.withColumn("own", before).join(bases, "range").select(
        "doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to files in the shared folder and give the digest read back from them."""
    path = f"{checkpoint_dir(spark)}/reelstar-llm/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, end_id, path)
    return token_digest(spark, path)
