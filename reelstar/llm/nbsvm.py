"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams, hashed to ``BUCKETS`` places: words, pairs
of words, and one to three consecutive word shapes (letters by case, digits,
other characters as they are, and a sign for a word that repeats the one
before it). The log-count ratio of a place comes from the counts of *all*
labelled training texts. An indicator is scaled by its ratio, a text's vector
is brought to length one, and a linear hinge-loss model is fitted by dual
coordinate descent on a bounded sample of training texts (``fit_rows``). Out
of fold margins of that sample give the logistic curve that turns margins into
scores between 0 and 1.

Null and empty texts have no indicator and get the score of the bias alone.
Without labels of both classes every score is the share of label 1 (0.5
without any label). Labels that are null are no labels; of several labels of a
doc_id the largest counts. Rows with a null doc_id are scored, never learned
from. Repeated rows are each scored. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .coded import slices, split_codes
from .common import staged

BUCKETS = 1 << 17
FIT_ROWS = 4000
FOLDS = 3
ROUNDS = 12
COST = 1.0  # of a margin violation
SMOOTH = 1.0
_LOWER, _UPPER, _DIGIT = regex.compile(r"\p{Ll}+"), regex.compile(r"\p{Lu}+"), regex.compile(r"\p{N}+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 17)
_RESULT = "doc_id long, held_out boolean, score double, predicted int"


def _shape(word: str) -> str:
    return _DIGIT.sub("9", _UPPER.sub("A", _LOWER.sub("a", word)))


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x)


def features(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct feature places of each text."""
    plain = [" ".join(t.split()) if t else "" for t in texts.to_pylist()]
    codes, offsets, words = split_codes(pc.split_pattern(pa.array(plain, pa.large_string()), " "))
    if not len(words):
        return [np.zeros(0, dtype=np.int64) for _ in plain]
    word = np.array([_hash(w) for w in words], dtype=np.uint64)[codes]
    shapes = np.array([_hash(_shape(w)) for w in words], dtype=np.uint64)[codes]
    shapes[1:][codes[1:] == codes[:-1]] = np.uint64(_hash("="))
    with np.errstate(over="ignore"):
        pairs = (word[:-1] * np.uint64(3) + word[1:]) * _MUL
        two = (shapes[:-1] * np.uint64(5) + shapes[1:]) * _MUL
        three = (two[:-1] * np.uint64(7) + shapes[2:]) * _MUL
        one = (shapes * np.uint64(11)) * _MUL
        word = word * _MUL
    streams = [(x >> _SHIFT).astype(np.int64) for x in (word, one, pairs, two, three)]
    short = [0, 0, 1, 1, 2]
    out = []
    for text, a, b in zip(plain, offsets[:-1].tolist(), offsets[1:].tolist()):
        out.append(np.unique(np.concatenate([s[a : max(a, b - k)] for s, k in zip(streams, short)])) if text else np.zeros(0, dtype=np.int64))
    return out


def _learned(sample_limit: int):
    """Counts of the places by label; and the places of the texts drawn for the fit."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        texts = [0, 0]
        for batch in (part for whole in batches for part in slices(whole)):
            labels = batch.column("quality").to_pylist()
            kept = []
            for places, label, draw in zip(features(batch.column("text")), labels, batch.column("draw").to_pylist()):
                counts[label, places] += 1
                texts[label] += 1
                if draw < sample_limit:
                    kept.append((label, places))
            yield _rows([-2] * len(kept), [y for y, _ in kept], [0] * len(kept), [p for _, p in kept])
        used = np.flatnonzero(counts.sum(0))
        yield _rows(np.append(used, -1), np.append(counts[0, used], texts[0]), np.append(counts[1, used], texts[1]), [None] * (len(used) + 1))

    return run


def _rows(place, zero, one, places) -> pa.RecordBatch:
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(place, long), pa.array(zero, long), pa.array(one, long), pa.array(places, pa.list_(long))],
        names=["place", "zero", "one", "places"],
    )


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def scores(self, texts: pa.Array, ratios: np.ndarray) -> np.ndarray:
        margins = np.array([self.margin(p, ratios) for p in features(texts)])
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -35, 35)))

    def margin(self, places: np.ndarray, ratios: np.ndarray) -> float:
        r = ratios[places]
        size = float(np.sqrt(r @ r))
        return (float(self.weights[places] @ r) / size if size else 0.0) + self.bias


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float, rounds: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model, by its dual, one text at a time."""
    rng = np.random.default_rng(seed)
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of label 1 over margins, by Newton steps."""
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y <= 0).sum() + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (b - [1.0, 0.0]))
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 1e-3), float(b[1])


def fit(places: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> Model:
    values = []
    for p in places:
        r = ratios[p]
        values.append(r / max(float(np.sqrt(r @ r)), 1e-12))
    y = np.where(labels == 1, 1.0, -1.0)
    fold = np.arange(len(y)) % FOLDS
    margins = np.zeros(len(y))
    for f in range(FOLDS):
        own, other = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        w, bias = coordinate_descent([places[i] for i in own], [values[i] for i in own], y[own], COST, ROUNDS, f)
        margins[other] = [w[places[i]] @ values[i] + bias for i in other]
    w, bias = coordinate_descent(places, values, y, COST, ROUNDS, FOLDS)
    return Model(w, bias, *_curve(margins, y))


def _scored(model, ratios, constant: float):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            if model is None:
                scores = np.full(batch.num_rows, constant)
            else:
                scores = model.value.scores(batch.column("text"), ratios.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.3).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, quality)."""
    spark: SparkSession = docs.sparkSession
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max("quality").cast("int").alias("quality")).where(~held)
    n = known.count()
    limit = 1 << 30
    drawn = int(limit * min(1.0, fit_rows / n)) if n else 0
    # One plan at every size: both sides shuffled, texts moved once.
    train = docs.where(~F.col("held_out")).hint("merge").join(known.hint("merge"), "doc_id")
    train = train.select("text", "quality", F.pmod(F.xxhash64("doc_id"), F.lit(limit)).alias("draw"))
    found = staged(spark, train.mapInArrow(_learned(drawn), "place long, zero long, one long, places array<long>"), "quality-counts")
    sums = found.where("place >= -1").groupBy("place").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    counts, texts = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in sums.toLocalIterator():  # BUCKETS rows at most, whatever the input
        if r["place"] < 0:
            texts[:] = r["zero"], r["one"]
        else:
            counts[:, r["place"]] = r["zero"], r["one"]
    fitted = found.where("place = -2").select("zero", "places").collect()
    model = ratios = None
    constant = float(texts[1] / texts.sum()) if texts.sum() else 0.5
    ys = np.array([r["zero"] for r in fitted], dtype=np.int64)
    if len(set(ys.tolist())) == 2:
        share = (counts + SMOOTH) / (texts[:, None] + 2 * SMOOTH)
        ratio = np.log(share[1] / share[0])
        places = [np.array(r["places"], dtype=np.int64) for r in fitted]
        model = spark.sparkContext.broadcast(fit(places, ys, ratio))
        ratios = spark.sparkContext.broadcast(ratio)
    return docs.select("doc_id", "text", "held_out").mapInArrow(_scored(model, ratios, constant), _RESULT)
