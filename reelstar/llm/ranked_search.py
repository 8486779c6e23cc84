"""Ranked lexical search over posting lists with range-maximum sparse tables.

The documents are read once: each slice of texts leaves a row of postings (for
the terms of the queries in hand) with its documents' ids and lengths. Document
frequencies and lengths are summed over all rows. Then every shard of postings
turns into impacts, each list gets a sparse table of range maxima, and a query
is answered best first: an interval of documents is bounded by the sum of its
lists' range maxima, the interval of the greatest bound is split at the
document of the largest single impact, that document is scored exactly, and
both sides go back with their own bounds. A shard ends when no bound reaches
the query's tenth best score so far. Intervals are taken in batches, so that
numpy handles many of them at a time; this changes their order, not the result.

Queries are held in blocks of bounded size, each block searched in all
documents. Results of the shards meet in a window that keeps ten a query before
the shuffle.

Odd rows: a null or empty text, or one without terms, has no term, is not
counted in N and is never found; a query without terms finds nothing. Rows of a
repeated document id are documents of their own; a null id stands last among
equal scores. Rows of a repeated item id are one query of all their terms; a
null item id is a query too. Texts of any length are read whole (a long text is
a slice of its own). An empty table gives an empty result. Only ids and texts
are read, so other columns have no effect.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .coded import slices, split_codes
from .common import staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_PAIRS = 200_000  # (query, term) pairs held at a time
SHARD_DOCS = 8192  # documents of a shard, and its postings; a single larger slice is a shard of its own
SHARD_POSTINGS = 1_500_000
BATCH = 128  # intervals split at a time

#: A-Z to lower case, ASCII other than letters and digits to spaces; bytes beyond ASCII stay
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))

POSTINGS = "docs binary, absent binary, lengths binary, terms binary, starts binary, places binary, counts binary, n_docs long, n_terms long"


def plain_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """Codes of all terms of the texts, each text's end among them, and the distinct terms (bytes)."""
    plain = [t.encode().translate(_PLAIN) if t else b"" for t in texts.to_pylist()]
    codes, offsets, words = split_codes(pc.split_pattern(pa.array(plain, pa.large_binary()), b" "))
    real = np.array([len(w) > 0 for w in words], dtype=bool)[codes] if len(words) else np.zeros(0, dtype=bool)
    return codes[real], np.concatenate([[0], np.cumsum(real)])[offsets], words


def posting_writer(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                codes, ends, words = plain_terms(part.column("text"))
                lengths = np.diff(ends)
                used = lengths > 0  # a document without a term takes no part
                place = np.repeat(np.cumsum(used) - 1, lengths)
                known = np.array([vocabulary.get(w, -1) for w in words], dtype=np.int64)
                term = known[codes] if len(words) else np.zeros(0, dtype=np.int64)
                hit = term >= 0
                width = max(1, int(used.sum()))
                keys, counts = np.unique(term[hit] * width + place[hit], return_counts=True)
                terms, starts = np.unique(keys // width, return_index=True)
                ids = part.column("doc_id").filter(pa.array(used))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[
                            pa.array([np.ascontiguousarray(x).astype(t).tobytes()], pa.binary())
                            for x, t in (
                                (pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), "<i8"),
                                (ids.is_null().to_numpy(zero_copy_only=False), "?"),
                                (lengths[used], "<i8"),
                                (terms, "<i4"),
                                (np.append(starts, len(keys)), "<i8"),
                                (keys % width, "<i4"),
                                (counts, "<i4"),
                            )
                        ],
                        pa.array([int(used.sum())], pa.int64()),
                        pa.array([int(lengths.sum())], pa.int64()),
                    ],
                    names=["docs", "absent", "lengths", "terms", "starts", "places", "counts", "n_docs", "n_terms"],
                )

    return write


def document_counter(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """In how many documents of a task each term stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist()):
                df[np.frombuffer(terms, "<i4")] += np.diff(np.frombuffer(starts, "<i8"))
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], names=["term", "df"])

    return count


class Shard:
    """Posting lists of some documents with impacts and range-maximum tables, made for a list when a query needs it."""

    def __init__(self, parts: list[dict], weights: np.ndarray, n: int, total: int):
        sizes = [p["n_docs"] for p in parts]
        read = lambda name, kind: [np.frombuffer(p[name], kind) for p in parts]
        self.docs, self.absent = np.concatenate(read("docs", "<i8")), np.concatenate(read("absent", "?"))
        length = 10 + (90 * np.concatenate(read("lengths", "<i8")) * n) // total
        starts = read("starts", "<i8")
        terms = np.concatenate([np.repeat(t, np.diff(s)) for t, s in zip(read("terms", "<i4"), starts)])
        places = np.concatenate([p.astype(np.int64) + base for p, base in zip(read("places", "<i4"), np.cumsum([0, *sizes[:-1]]))])
        tf = np.concatenate(read("counts", "<i4")).astype(np.int64)
        order = np.argsort(terms, kind="stable")  # parts follow one another, so places stay ascending within a term
        terms, self.places, tf = terms[order], places[order], tf[order]
        self.impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[self.places]))
        own, at = np.unique(terms, return_index=True)
        self.lists = dict(zip(own.tolist(), zip(at.tolist(), np.append(at[1:], len(terms)).tolist())))
        self._tables: dict[int, np.ndarray] = {}

    def table(self, term: int) -> np.ndarray:
        """Row k, column i: where the largest impact of the 2**k postings from i on is."""
        if term not in self._tables:
            a, b = self.lists[term]
            impact, rows = self.impact[a:b], [np.arange(b - a, dtype=np.int32)]
            while 2 ** len(rows) <= b - a:
                half, low = 2 ** (len(rows) - 1), rows[-1]
                left, right = low[: b - a - 2 * half + 1], low[half : b - a - half + 1]
                best = np.arange(b - a, dtype=np.int32)
                best[: len(left)] = np.where(impact[left] >= impact[right], left, right)
                rows.append(best)
            self._tables[term] = np.stack(rows)
        return self._tables[term]

    def search(self, terms: list[int], best: list[tuple], most: int) -> None:
        """Puts the shard's documents into ``best``, a heap of the ``most`` highest (score, minus id) so far."""
        lists = [(self.places[a:b], self.impact[a:b], self.table(t)) for t in terms if t in self.lists for a, b in [self.lists[t]]]
        if not lists:
            return
        width = len(lists)

        def bounded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Sum of range maxima for rows of posting ranges [first, last), and the document of the largest."""
            total, top, where = (np.zeros(len(first), dtype=np.int64) for _ in range(3))
            for t, (places, impact, table) in enumerate(lists):
                a, b = first[:, t], last[:, t]
                some = np.flatnonzero(b > a)
                if not len(some):
                    continue
                a, b = a[some], b[some]
                k = np.frexp((b - a).astype(np.float64))[1] - 1
                x, y = table[k, a], table[k, b - (1 << k)]
                at = np.where(impact[x] >= impact[y], x, y)
                value = impact[at]
                total[some] += value
                more = value > top[some]
                top[some[more]], where[some[more]] = value[more], places[at[more]]
            return total, where

        first = np.zeros((1, width), dtype=np.int64)
        last = np.array([[len(places) for places, _, _ in lists]], dtype=np.int64)
        bound, split = bounded(first, last)
        while True:
            floor = best[0][0] if len(best) == most else 1
            alive = np.flatnonzero(bound >= max(floor, 1))
            if not len(alive):
                return
            if len(alive) > BATCH:
                alive = alive[np.argpartition(-bound[alive], BATCH)]
            now, rest = alive[:BATCH], alive[BATCH:]
            a, b, doc = first[now], last[now], split[now]
            low, high, score = np.empty_like(a), np.empty_like(b), np.zeros(len(now), dtype=np.int64)
            for t, (places, impact, _) in enumerate(lists):
                at = np.searchsorted(places, doc)
                held = np.flatnonzero((at < b[:, t]) & (places[np.minimum(at, len(places) - 1)] == doc))
                score[held] += impact[at[held]]
                low[:, t] = high[:, t] = at
                high[held, t] += 1
            for s, d in zip(score.tolist(), doc.tolist()):
                offer(best, s, None if self.absent[d] else int(self.docs[d]), most)
            more_first, more_last = np.concatenate([a, np.maximum(high, a)]), np.concatenate([np.minimum(low, b), b])
            more_bound, more_split = bounded(more_first, more_last)
            first, last = np.concatenate([first[rest], more_first]), np.concatenate([last[rest], more_last])
            bound, split = np.concatenate([bound[rest], more_bound]), np.concatenate([split[rest], more_split])


def offer(best: list[tuple], score: int, doc: int | None, most: int) -> None:
    # a heap of (score, place among equals): the smaller id is the greater entry, a null id the least
    entry = (score, -math.inf if doc is None else -doc, doc)
    if score > 0:
        if len(best) < most:
            heapq.heappush(best, entry)
        elif entry[:2] > best[0][:2]:
            heapq.heapreplace(best, entry)


def searcher(queries: list[list[int]], weights: np.ndarray, n: int, total: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries]
        held: list[dict] = []

        def flush() -> None:
            if held:
                shard = Shard(held, weights, n, total)
                held.clear()
                for terms, own in zip(queries, best):
                    shard.search(terms, own, most)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                size = len(row["places"]) // 4
                if held and (sum(p["n_docs"] for p in held) + row["n_docs"] > SHARD_DOCS or sum(len(p["places"]) // 4 for p in held) + size > SHARD_POSTINGS):
                    flush()
                if row["n_docs"]:
                    held.append(row)
        flush()
        found = [(q, doc, score) for q, own in enumerate(best) for score, _, doc in own]
        columns = list(zip(*found)) if found else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    return search


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` highest-scoring documents of each item: item_id, rank, doc_id, score."""
    pairs = staged(
        spark,
        items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))).alias("term")).distinct(),
        "ranked-pairs",
    )
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found: DataFrame | None = None
    for block in range(blocks):
        own: dict[int | None, list[str]] = {}
        for item, term in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            own.setdefault(item, []).append(term)
        vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for terms in own.values() for t in terms}))}
        ids = list(own)
        queries = [sorted(vocabulary[t.encode()] for t in own[i]) for i in ids]
        postings = staged(spark, texts.mapInArrow(posting_writer(vocabulary), POSTINGS), "ranked-postings")
        n, total = postings.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        counted = postings.select("terms", "starts").mapInArrow(document_counter(len(vocabulary)), "term long, df long")
        weights = np.zeros(max(1, len(vocabulary)), dtype=np.int64)
        for term, df in counted.groupBy("term").agg(F.sum("df")).toLocalIterator():  # one row a term of the block
            weights[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        hits = postings.mapInArrow(searcher(queries, weights, n, max(1, total), most), "query long, doc_id long, score long")
        names = spark.createDataFrame([(q, i) for q, i in enumerate(ids)], "query long, item_id long")
        hits = staged(spark, hits.join(names, "query").select("item_id", "doc_id", "score"), "ranked-hits")
        found = hits if found is None else found.union(hits)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("item_id", "rank", "doc_id", "score")


SQL = rf"""
WITH terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
),
lengths AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY r),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
queries AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
),
counts AS (SELECT r, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM queries) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
scores AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM queries JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals
  GROUP BY item_id, r
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN lengths USING (r) WHERE score > 0
) WHERE rank <= 10
"""
