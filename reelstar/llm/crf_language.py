"""Language identification of words by a linear-chain conditional random field.

A text is the sequence of its letter runs in lower case. A word's features are
its prefixes and suffixes of up to three letters, its letter pairs and
triples, the word itself, and a lexicon entry: the language that the word's
hash place was mostly seen with and how strongly, counted over *all* labelled
training texts. Feature weights and label transitions are learned together on
a bounded sample (``fit_texts`` per language), cut into stretches and joined
across languages, so that transitions also see switches. Forward-backward
gives each word's label probabilities over the whole text; a document's
language is the one of largest mean probability, which is its score.

Texts that are null or have no letter get ``und`` with score 0; so does every
text when nothing can be learned. Words longer than 24 letters are seen by
their first 24 and their last three letters. Rows with a null doc_id are
labelled, never learned from; labels that are null are no labels. Repeated
rows are each labelled, other columns ignored, ties go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .coded import gather, slices, split_codes
from .common import staged

FIT_TEXTS = 300  # per language
STRETCH = 24  # words of one language in a training sequence
STRETCHES = 3
PLACES = 1 << 16  # hashed features
LEXICON = 1 << 16  # hashed words
STEPS = 40
RATE = 0.25
PENALTY = 1e-4
LETTERS = 24
BINS = 4  # of the lexicon's strength
_AREA = 600_000  # words of the texts that are run through the chain together
_BLOCK = 4096  # distinct words whose features are held at a time
_SLICE = 12 << 20  # bytes of text handled at a time
_KEPT = 300_000  # words whose emissions a worker keeps; cleared beyond
_RUNS = regex.compile(r"\p{L}+")
_EXTRA = "held_out boolean, lang_pred string, score double, runs array<struct<lang:string,words:int>>"
_RUN = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word codes of all texts in order, and how many each text has."""
    plain = [" ".join(t.split()) if t else "" for t in texts.to_pylist()]
    codes, offsets, pieces = split_codes(pc.split_pattern(pa.array(plain, pa.large_string()), " "))
    index: dict[str, int] = {}
    found = []
    for piece in pieces:
        piece = piece.lower()
        runs = [piece] if piece.isalpha() else _RUNS.findall(piece)
        if len(piece) > LETTERS:
            runs = [r[i : i + LETTERS] for r in runs for i in range(0, len(r), LETTERS)]
        found.append([index.setdefault(w, len(index)) for w in runs])
    sizes = np.array([len(x) for x in found], dtype=np.int64)
    flat = np.array([i for x in found for i in x], dtype=np.int64)
    lengths = sizes[codes]
    words = gather(flat, (np.cumsum(sizes) - sizes)[codes], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    return list(index), words, np.diff(ends)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of words (of LETTERS at most), their last three, and their sizes."""
    n = len(words)
    letters = np.array(words, dtype=f"U{LETTERS}").reshape(n, 1).view(np.uint32).reshape(n, LETTERS)
    ends = np.array([w[-3:].rjust(3, "\0") for w in words], dtype="U3").reshape(n, 1).view(np.uint32).reshape(n, 3)
    return letters, ends, np.array([len(w) for w in words])


def _hashed(kind: int, parts: list[np.ndarray], n: int) -> np.ndarray:
    h = np.full(n, kind, dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def _whole(letters: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _hashed(1, [letters[:, i] for i in range(LETTERS)] + [ends[:, i] for i in range(3)], len(letters))


def _blocks(words: list[str]) -> Iterator[list[str]]:
    for i in range(0, len(words), _BLOCK):
        yield words[i : i + _BLOCK]


def _lexicon(words: list[str]) -> np.ndarray:
    """Lexicon place of each word."""
    found = [(_whole(*_letters(block)[:2]) % np.uint64(LEXICON)).astype(np.int32) for block in _blocks(words)]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int32)


def _places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of each word, one row a word (0: none), and its lexicon place."""
    n = len(words)
    letters, ends, size = _letters(words)
    longest = int(size.max()) if n else 0
    pairs = max(longest - 1, 0)
    out = np.zeros((n, 7 + pairs + max(longest - 2, 0)), dtype=np.int32)
    column = 0

    def add(h: np.ndarray, there: np.ndarray | bool = True) -> None:
        nonlocal column
        out[:, column] = np.where(there, (h % np.uint64(PLACES - 1)).astype(np.int32) + 1, 0)
        column += 1

    whole = _whole(letters, ends)
    add(whole)
    for k in (1, 2, 3):
        add(_hashed(1 + k, [letters[:, i] for i in range(k)], n), size >= k)
        add(_hashed(4 + k, [ends[:, 3 - i] for i in range(1, k + 1)], n), size >= k)
    for i in range(pairs):
        add(_hashed(8, [letters[:, i], letters[:, i + 1]], n), size >= i + 2)
        if i + 2 < longest:
            add(_hashed(9, [letters[:, i], letters[:, i + 1], letters[:, i + 2]], n), size >= i + 3)
    return out, (whole % np.uint64(LEXICON)).astype(np.int32)


def _potentials(e: np.ndarray) -> np.ndarray:
    found = e - e.max(-1, keepdims=True)
    return np.exp(found, out=found)


class _Gathered:
    """Potentials of each step of sequences of word codes, looked up when they are needed."""

    def __init__(self, emissions: np.ndarray, words: np.ndarray):
        self.table, self.words = _potentials(emissions), words

    def __getitem__(self, i: int) -> np.ndarray:
        return self.table[self.words[i]]


class Chain:
    """Weights of places (PLACES, L), of lexicon entries (L, BINS, L) and of transitions (L, L); the lexicon's counts."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        k = len(langs)
        self.weights, self.entries, self.steps = np.zeros((PLACES, k)), np.zeros((k * BINS + 1, k)), np.zeros((k, k))
        share = (counts + 0.5) / (counts + 0.5).sum(0)  # places by language, as shares of the language
        share = share / share.sum(1, keepdims=True)
        top = share.max(1)
        strength = np.minimum(((top - 1 / k) / (1 - 1 / k + 1e-9) * BINS).astype(np.int64), BINS - 1)
        self.entry = np.where(counts.sum(1) > 0, share.argmax(1) * BINS + strength + 1, 0)

    def emissions(self, places: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
        out = self.entries[self.entry[lexicon]].copy()
        for j in range(places.shape[1]):
            out += self.weights[places[:, j]]
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        """Emissions of each word; the features of one block of words are held at a time."""
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        for i, block in enumerate(_blocks(words)):
            out[i * _BLOCK : i * _BLOCK + len(block)] = self.emissions(*_places(block))
        return out

    def kept(self, words: list[str]) -> np.ndarray:
        """The same, with the emissions of earlier calls at hand."""
        if not hasattr(self, "_index") or len(self._index) > _KEPT:
            self._index, self._rows = {}, np.zeros((0, len(self.langs)), dtype=np.float32)
        index = self._index
        fresh = [w for w in words if w not in index]
        if fresh:
            index.update(zip(fresh, range(len(index), len(index) + len(fresh))))
            self._rows = np.concatenate([self._rows, self.of_words(fresh)])
        return self._rows[[index[w] for w in words]]

    def marginals(self, e: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of padded sequences, e[t, b] = log potentials, and expected transitions of each step's sum."""
        return self.passes(_potentials(e), e.shape[0], lengths)

    def passes(self, e: np.ndarray | _Gathered, steps: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, given the potentials of each step; the probabilities take the place of the forward ones."""
        rows, k = e[0].shape
        t = np.exp(self.steps - self.steps.max())
        alpha = np.empty((steps, rows, k), dtype=e[0].dtype)
        first = e[0]
        alpha[0] = first / first.sum(1, keepdims=True)
        for i in range(1, steps):
            a = (alpha[i - 1] @ t) * e[i]
            alpha[i] = a / a.sum(1, keepdims=True)
        beta = np.ones((rows, k))
        pairs = np.zeros((k, k))
        for i in range(steps - 1, -1, -1):
            live = i < lengths
            g = alpha[i] * beta
            alpha[i] = g / g.sum(1, keepdims=True)
            if i:
                step = beta * e[i]
                both = alpha[i - 1][live].T @ (step[live] / np.maximum(((alpha[i - 1] @ t) * step).sum(1, keepdims=True)[live], 1e-300))
                pairs += both * t
                step = step @ t.T
                beta = np.where(live[:, None], step / step.sum(1, keepdims=True), beta)
        return alpha, pairs


def fit(chain: Chain, texts: list[tuple[np.ndarray, int]], places: np.ndarray, lexicon: np.ndarray, seed: int = 11) -> None:
    """Learn the weights from (word codes, language) of training texts, by Adam on the whole likelihood."""
    rng = np.random.default_rng(seed)
    pieces = [(w[i : i + STRETCH], y) for w, y in texts for i in range(0, len(w), STRETCH)]
    order = rng.permutation(len(pieces))
    length, rows, k = STRETCH * STRETCHES, -(-len(pieces) // STRETCHES), len(chain.langs)
    words, truth = np.zeros((length, rows), dtype=np.int32), np.zeros((length, rows), dtype=np.int32)
    sizes = np.zeros(rows, dtype=np.int64)
    for at, i in enumerate(order):
        w, y = pieces[i]
        row, start = at // STRETCHES, sizes[at // STRETCHES]
        words[start : start + len(w), row], truth[start : start + len(w), row] = w, y
        sizes[row] += len(w)
    live = np.arange(length)[:, None] < sizes
    tokens, there, gold = words.reshape(-1), np.flatnonzero(live), truth[live]
    moves = np.zeros((k, k))
    np.add.at(moves, (truth[:-1][live[1:]], truth[1:][live[1:]]), 1.0)
    del truth, pieces
    parameters = [chain.weights, chain.entries, chain.steps]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for turn in range(1, STEPS + 1):
        found, pairs = chain.passes(_Gathered(chain.emissions(places, lexicon), words), length, sizes)
        found[~live] = 0.0
        surplus = np.negative(found, out=found).reshape(-1, k)
        surplus[there, gold] += 1.0
        by_word = np.stack([np.bincount(tokens, surplus[:, j], len(places)) for j in range(k)], 1)
        grad = [np.zeros_like(p) for p in parameters]
        for j in range(k):
            for column in places.T:
                grad[0][:, j] += np.bincount(column, by_word[:, j], PLACES)
            grad[1][:, j] = np.bincount(chain.entry[lexicon], by_word[:, j], len(chain.entries))
        grad[2][:] = moves - pairs
        grad[0][0] = 0.0
        for p, g, m, v in zip(parameters, grad, first, second):
            g = g / len(there) - PENALTY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)


def label(chain: Chain, texts: pa.Array) -> list[tuple[str, float, list[dict]]]:
    """Language, score and runs of word labels of each text."""
    distinct, words, sizes = _words(texts)
    out: list = [("und", 0.0, [])] * len(sizes)
    if not len(words):
        return out
    emissions = chain.kept(distinct)
    starts = np.cumsum(sizes) - sizes
    order = [i for i in np.argsort(sizes, kind="stable").tolist() if sizes[i]]
    while order:
        longest = sizes[order[-1]]
        group = order[-max(1, int(_AREA // longest)) :]
        del order[-len(group) :]
        e = np.zeros((longest, len(group), len(chain.langs)), dtype=np.float32)
        for b, i in enumerate(group):
            e[: sizes[i], b] = emissions[words[starts[i] : starts[i] + sizes[i]]]
        found, _ = chain.marginals(e, sizes[group])
        best = found.argmax(2)
        for b, i in enumerate(group):
            mean = found[: sizes[i], b].mean(0, dtype=np.float64)
            top = int(mean.argmax())
            path = best[: sizes[i], b]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [sizes[i]]])
            runs = [{"lang": chain.langs[path[c]], "words": int(d - c)} for c, d in zip(cuts[:-1], cuts[1:])]
            out[i] = (chain.langs[top], min(1.0, float(mean[top])), runs)
    return out


def _learned(langs: list[str]):
    """Lexicon counts by language, and the texts drawn for the fit."""
    index = {x: i for i, x in enumerate(langs)}

    def run(batches):
        counts = np.zeros((LEXICON, len(langs)), dtype=np.int64)
        for batch in (part for whole in batches for part in slices(whole, size=_SLICE)):
            names, drawn = batch.column("lang").to_pylist(), batch.column("drawn").to_pylist()
            distinct, words, sizes = _words(batch.column("text"))
            if len(words):
                lexicon = _lexicon(distinct)
                label_of = np.repeat([index[x] for x in names], sizes)
                counts += np.bincount(lexicon[words] * np.int64(len(langs)) + label_of, minlength=counts.size).reshape(counts.shape)
            kept = [(n, t) for n, t, d in zip(names, batch.column("text").to_pylist(), drawn) if d]
            yield _rows([-1] * len(kept), [0] * len(kept), [n for n, _ in kept], [t for _, t in kept])
        place, lang = np.nonzero(counts)
        yield _rows(place, counts[place, lang], [langs[i] for i in lang], [None] * len(place))

    return run


def _rows(place, n, lang, text) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(lang, pa.string()), pa.array(text, pa.string())],
        names=["place", "n", "lang", "text"],
    )


def _labelled(chain, carry: list[str]):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text_", _SLICE)):
            texts = batch.column("text_")
            found = label(chain.value, texts) if chain else [("und", 0.0, [])] * batch.num_rows
            names, scores, runs = zip(*found)
            made = [pa.array(names), pa.array(scores), pa.array(runs, _RUN)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in [*carry, "held_out"]] + made, names=[*carry, "held_out", "lang_pred", "score", "runs"]
            )

    return run


def train(docs: DataFrame, fit_texts: int = FIT_TEXTS) -> Chain | None:
    """Learn a chain from ``docs`` (doc_id, text, lang) outside the held-out fold; None without labels."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        "doc_id is not null and lang is not null and text is not null"
    )
    rows = rows.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return None
    limit = 1 << 30
    bound = F.element_at(F.create_map(*[F.lit(v) for x in langs for v in (x, int(limit * min(1.0, fit_texts / sizes[x])))]), F.col("lang"))
    drawn = rows.select("text", "lang", (F.pmod(F.xxhash64("doc_id"), F.lit(limit)) < bound).alias("drawn"))
    found = staged(spark, drawn.mapInArrow(_learned(langs), "place long, n long, lang string, text string"), "language-counts")
    counts = np.zeros((LEXICON, len(langs)))
    sums = found.where("place >= 0").groupBy("place", "lang").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # LEXICON rows a language at most, whatever the input
    if table.num_rows:
        column = pc.index_in(table.column("lang"), pa.array(langs, table.schema.field("lang").type)).to_numpy()
        counts[table.column("place").to_numpy(), column] = table.column("n").to_numpy()
    chain = Chain(langs, counts)
    texts = found.where("place = -1").select("text", "lang").collect()
    names = [r["lang"] for r in texts]
    distinct, words, lengths = _words(pa.array([r["text"] for r in texts], pa.string()))
    del texts, table
    if len(words):
        ends = np.cumsum(lengths)
        stretches = [(words[b - n : b], langs.index(x)) for x, b, n in zip(names, ends, lengths) if n]
        fit(chain, stretches, *_places(distinct))
    return chain


def identify(docs: DataFrame, fit_texts: int = FIT_TEXTS, carry: list[str] | None = None) -> DataFrame:
    """``doc_id`` (or the columns of ``carry``), ``held_out, lang_pred, score, runs`` of each row of ``docs`` (doc_id, text, lang)."""
    spark: SparkSession = docs.sparkSession
    chain = train(docs, fit_texts)
    shared = spark.sparkContext.broadcast(chain) if chain else None
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    kept = docs.select(*carry) if carry else docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    names = kept.columns
    rows = docs.select(*(carry or [F.col("doc_id").cast("long").alias("doc_id")]), held.alias("held_out"), F.col("text").alias("text_"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return rows.mapInArrow(_labelled(shared, names), f"{kind}, {_EXTRA}")
