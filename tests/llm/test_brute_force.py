"""Learned models, likeness and the pipeline's rules against plain forms on small input."""

from __future__ import annotations

import itertools
import math
import os
import re
import time
import tracemalloc
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from reelstar.llm import common as common_module
from reelstar.llm import crf_language, fuzzy_lines, nbsvm
from reelstar.llm.bottom_k import fingerprint_edits
from reelstar.llm.fuzzy_lines import BLOCKS, dedup_lines, hashed_lines, normalised, _lines
from reelstar.session import checkpoint_dir

SF = "/root/testdata/sf0.01"


# --- op3


def _sample(n=40, seed=4):
    rng = random.Random(seed)
    word = lambda kind: "".join(rng.choice("etaoin" if kind else "xqzjk#") for _ in range(rng.randrange(1, 5)))
    labels = [i % 2 for i in range(n)]
    return [" ".join(word(y if rng.random() < 0.8 else 1 - y) for _ in range(rng.randrange(3, 25))) for y in labels], np.array(labels)


def test_dual_coordinate_descent_reaches_the_optimum_of_the_dual():
    texts, labels = _sample()
    rows = nbsvm.features(pa.array(texts))
    values = [np.ones(len(r)) / math.sqrt(len(r)) for r in rows]
    y = np.where(labels == 1, 1.0, -1.0)
    w, bias = nbsvm.coordinate_descent(rows, values, y, 1.0, 400, 1)
    places = sorted({int(p) for r in rows for p in r})
    at = {p: i for i, p in enumerate(places)}
    x = np.zeros((len(rows), len(places) + 1))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, [at[int(p)] for p in r]] = v
        x[i, -1] = 1.0  # the bias is one more indicator

    def objective(u):
        return 0.5 * u @ u + np.maximum(0.0, 1.0 - y * (x @ u)).sum()

    # a slow reference: projected gradient on the dual
    q, alpha = (y[:, None] * x) @ (y[:, None] * x).T, np.zeros(len(y))
    for _ in range(60_000):
        alpha = np.clip(alpha - (q @ alpha - 1.0) / np.linalg.norm(q, 2), 0.0, 1.0)
    best = objective(x.T @ (alpha * y))
    own = objective(np.append([w[p] for p in places], bias))
    assert abs(own - best) < 1e-3 * best


def test_counts_and_ratios_equal_plain_loops(spark):
    texts, labels = _sample(60, 9)
    rows = [(i, t, int(y), i % (1 << 30)) for i, (t, y) in enumerate(zip(texts, labels))]
    frame = spark.createDataFrame(rows, "id long, text string, quality int, draw long").repartition(5)
    got = frame.select("text", "quality", "draw").mapInArrow(nbsvm._learned(10), "place long, zero long, one long, places array<long>").collect()
    counts, seen = np.zeros((2, nbsvm.BUCKETS), dtype=int), [0, 0]
    for t, y in zip(texts, labels):
        seen[y] += 1
        for p in {int(p) for p in nbsvm.features(pa.array([t]))[0]}:
            counts[y, p] += 1
    found, held = np.zeros((2, nbsvm.BUCKETS), dtype=int), [0, 0]
    for r in got:
        if r.place >= 0:
            found[:, r.place] += (r.zero, r.one)
        elif r.place == -1:
            held[0] += r.zero
            held[1] += r.one
    assert (found == counts).all() and held == seen and sum(r.place == -2 for r in got) == 10


def test_one_join_plan_for_the_labels_at_every_size(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert nbsvm.quality_scores(docs, labels).count() == docs.count()
    train = docs.hint("merge").join(labels.hint("merge"), "doc_id")
    assert "SortMergeJoin" in train._jdf.queryExecution().executedPlan().toString()


# --- op7


def _chain(k=3, seed=1):
    rng = np.random.default_rng(seed)
    chain = crf_language.Chain([f"l{i}" for i in range(k)], rng.integers(0, 5, (crf_language.LEXICON, k)).astype(float))
    chain.weights[:] = rng.normal(size=chain.weights.shape)
    chain.weights[0] = 0.0
    chain.entries[:], chain.steps[:] = rng.normal(size=chain.entries.shape), rng.normal(size=chain.steps.shape)
    return chain


def test_forward_backward_equals_all_label_paths():
    chain, words = _chain(), ["der", "house", "große", "que", "the"]
    e = chain.emissions(*crf_language._places(words))
    k, weight = len(chain.langs), {}
    for path in itertools.product(range(k), repeat=len(words)):
        weight[path] = math.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(chain.steps[a, b] for a, b in zip(path, path[1:])))
    total = sum(weight.values())
    expected = [[sum(w for p, w in weight.items() if p[i] == y) / total for y in range(k)] for i in range(len(words))]
    pairs = [[sum(w * sum((a, b) == (x, y) for x, y in zip(p, p[1:])) for p, w in weight.items()) / total for b in range(k)] for a in range(k)]
    padded = np.concatenate([e[:, None, :], np.zeros((2, 1, k))])
    found, moves = chain.marginals(padded, np.array([5]))
    assert np.allclose(found[:5, 0], expected) and np.allclose(moves, pairs)


def test_blocks_of_words_give_the_same_emissions_and_every_letter_is_read(monkeypatch):
    chain = _chain()
    words = ["a", "ab", "straße", "x" * 24, "ÿ", "日本語"] * 3
    whole = chain.of_words(words)
    monkeypatch.setattr(crf_language, "_BLOCK", 4)
    assert np.allclose(chain.of_words(words), whole) and np.allclose(whole, chain.emissions(*crf_language._places(words)), atol=1e-5)
    assert (crf_language._lexicon(words) == crf_language._places(words)[1]).all()
    sentence = "".join(chr(0x4E00 + i) for i in range(100))
    distinct, codes, sizes = crf_language._words(pa.array([sentence + " ende"]))
    assert "".join(distinct[c] for c in codes) == sentence + "ende" and sizes.tolist() == [6] and max(map(len, distinct)) == 24


def test_words_of_mixed_texts_are_labelled_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chain = crf_language.train(docs)
    clean = {r.lang: r.text for r in docs.where("length(text) between 400 and 900").collect()}
    a, b = (" ".join(clean[x].split()[:25]) for x in ("de", "es"))
    ((lang, score, runs),) = crf_language.label(chain, pa.array([f"{a} {b}"]))
    words = {x: sum(r["words"] for r in runs if r["lang"] == x) for x in chain.langs}
    assert lang in ("de", "es") and 0.3 < score < 0.8
    assert min(words["de"], words["es"]) >= 18 and words["de"] + words["es"] >= 0.9 * sum(words.values()) and len(runs) <= 6


# --- op4


def test_likeness_is_close_to_the_exact_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]

    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    errors = []
    got = {r.doc_id: r for r in fingerprint_edits(docs).collect()}
    for i, (doc_id, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        cut = len(t) // 4
        own, edited = shingles(t), shingles(t[: len(t) - cut] + after[:cut])
        errors += [abs(got[doc_id].near_edited - jaccard(own, edited)), abs(got[doc_id].near_next - jaccard(own, shingles(after)))]
        if len(own | edited) <= 128:
            assert got[doc_id].near_edited == jaccard(own, edited)
    assert np.mean(errors) < 0.02 and max(errors) < 0.2


# --- op9


def test_simhash_of_lines_equals_plain_votes(spark):
    import xxhash

    def spark_hash(*parts):  # column xxhash64: each value is hashed with the hash before it as its seed
        seed = 42
        for p in parts:
            data = p.encode() if isinstance(p, str) else int(p).to_bytes(4, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed=seed) if isinstance(p, str) else spark.range(1).select(F.xxhash64(F.lit(p))).first()[0]
        return seed

    text = "one two three four five six seven eight nine ten eleven twelve"
    row = hashed_lines(_lines(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    words = [w for w in text.split()]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    hashes = [h for r in frame.select(F.xxhash64("w"), F.xxhash64(F.left("w", F.lit(3)), F.lit(1)), F.xxhash64(F.right("w", F.lit(3)), F.lit(2))).collect() for h in r]
    votes = [sum((h >> i) & 1 for h in hashes) for i in range(64)]
    expected = sum(1 << i for i, v in enumerate(votes) if 2 * v > len(hashes))
    assert [h & (1 << 64) - 1 for h in row.hashes] == [expected] and spark_hash("one") == hashes[0] & (1 << 64) - 1


def test_blocks_cover_the_hash():
    assert [b for first, size in BLOCKS for b in range(first, first + size)] == list(range(64))


def test_lines_of_any_columns_and_long_lines(spark):
    line = " ".join(f"w{i}" for i in range(12_000))  # two stretches
    names = ["places", "__row", "row", "doc", "kept", "line", "lines_removed", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(1, line, *names), (2, line.replace("w700 ", "x700 "), *names), (2, "short", *names), (None, "short", *names)]
    got = dedup_lines(spark.createDataFrame(rows, schema))
    assert got.columns == [c for c in ["doc_id", "text", *names] if c != "lines_removed"] + ["lines_removed", "lines_kept"]
    assert sorted((r.doc_id or 0, len(r.text), r.lines_removed) for r in got.collect()) == [(0, 5, 0), (1, len(line), 0), (2, 0, 1), (2, 0, 1)]


def test_lines_of_common_words_are_not_compared(spark, monkeypatch):
    """Lines that share their common words, also their pairs of them, but are not alike: few texts are compared, and every link is found."""
    rng = random.Random(11)
    common = ["the", "of", "and", "in", "to", "is", "was", "for", "that", "on", "at", "by"]
    own = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(6, 12)))
    line = lambda: [rng.choice(common) if rng.random() < 0.7 else own() for _ in range(60)]
    lines = [line() for _ in range(500)]
    near = [[own() if i in (7, 31, 50) else w for i, w in enumerate(x)] for x in lines[:20]]
    near += [[*x[:9], own(), *x[9:40], *x[42:]] for x in lines[20:40]]
    rows = [(i, " ".join(x)) for i, x in enumerate([*lines, *near])]
    compared = []

    def counted(spark, df, tag, *more, **options):
        found = common_module.staged(spark, df, tag, *more, **options)
        if tag.endswith("line-pairs"):
            compared.append(found.count())
        return found

    monkeypatch.setattr(fuzzy_lines, "staged", counted)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect() if r.lines_removed} == set(range(500, 540))
    assert 40 <= sum(compared) < 400


def test_short_lines_equal_brute_force(spark):
    """Lines of 3 to 32 characters with up to a fifth of them edited anywhere: every link is found."""
    rng = random.Random(12)
    rows = []
    for n in [*range(3, 33)] * 3:
        own = "".join(rng.choice("abcdefghijklmnop    ") for _ in range(n))
        other = list(own)
        for _ in range(max(1, n // 5)):
            i = rng.randrange(len(other))
            other[i : i + rng.choice((0, 1))] = rng.choice(("", "x", "y"))
        rows += [own, "".join(other)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    norms = {r.doc_id: r.n for r in frame.select("doc_id", normalised(F.col("text")).alias("n")).collect() if r.n}
    roots = {i: i for i in norms}

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    texts = spark.createDataFrame([*norms.items()], "doc_id long, n string")
    x, y = (texts.select(F.col("doc_id").alias(c), F.col("n").alias(f"{c}_n")) for c in "ab")
    alike = F.expr("levenshtein(a_n, b_n) <= floor(0.2 * greatest(length(a_n), length(b_n)))")
    for r in x.join(y, F.col("a") < F.col("b")).where(alike).collect():
        first, second = sorted((root(r.a), root(r.b)))
        roots[second] = first
    gone = {i for i in norms if root(i) != i}
    assert len(gone) > 40
    assert {r.doc_id for r in dedup_lines(frame).collect() if r.lines_removed} == gone


def test_steps_of_line_dedup_leave_no_files(spark):
    """What a step has shuffled goes with the step, what was staged with the last; the setting is as before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {m[1] for m in re.finditer(r"shuffle_(\d+)_", blocks.getAllBlocks().mkString(" "))}
    at = f"{checkpoint_dir(spark)}/reelstar-llm/{spark.sparkContext.applicationId}"
    tables = lambda: set(os.listdir(at)) if os.path.isdir(at) else set()
    held, stood = shuffles(), tables()
    dedup_lines(spark.createDataFrame([(i, f"alpha beta gamma delta epsilon zeta eta theta iota kappa {i % 7}") for i in range(40)], "doc_id long, text string"))
    for _ in range(50):
        if not (left := shuffles() - held):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == before
    assert [t.rpartition("-")[0] for t in tables() - stood] == ["line-drops"]


# --- pipeline


def test_near_duplicates_keep_one_of_each_group_and_every_clean_text(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("etaoinshrdlu") + str(rng.randrange(900)) for _ in range(80))
    t, clean, other = text(), text(), text()
    near = " ".join(["changed", *t.split()[1:]])
    rows = [(1, t), (5, t), (5, clean), (None, t), (None, t), (None, other), (9, near), (10, None), (11, ""), (12, ""), (None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in rows], schema)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(got, key=key) == sorted([(1, t), (5, clean), (None, other), (10, None), (11, ""), (12, ""), (None, None)], key=key)


def test_fit_holds_two_arrays_of_its_words_and_labels():
    """The driver fits beside the JVM: what it holds at once is bounded by two arrays of words by labels and the features."""
    rng = np.random.default_rng(3)
    k, n = 4, 60_000
    chain = _chain(k)
    chain.weights[:], chain.entries[:], chain.steps[:] = 0.0, 0.0, 0.0
    words = ["der", "house", "große", "que"]
    places, lexicon = crf_language._places(words)
    texts = [(rng.integers(0, 4, n), y) for y in range(k)]
    steps, crf_language.STEPS = crf_language.STEPS, 2
    tracemalloc.start()
    try:
        crf_language.fit(chain, texts, places, lexicon)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        crf_language.STEPS = steps
    tables = 8 * (4 * chain.weights.size + 4 * chain.entries.size)
    assert most < tables + 4 * 8 * k * n * k  # with a few columns beside them
