"""Ranked search, Merkle logs and line rules against plain-Python forms, the SQL forms and odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from reelstar.llm import line_rules, merkle_log, ranked_search
from reelstar.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx long, n long, row string, words string, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long and repeated texts and ids; extra columns named like inner and result ones."""
    long = ". ".join(f"w{i % 997} v{i % 13}" for i in range(30_000)) + "."
    words = "The quick brown fox jumps over the lazy dog. It runs away again and again."
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, long + " end"), (6, words), (6, words), (7, words), (None, words), (8, "one"), (9, "!!! 123 ß")]
    rows = [(i, t, "en" if t else None, "a" if (i or 0) % 2 else None, None, "x", 8, 9, "k", "w", "q") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# --- ranked search


def ranked(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    terms = lambda t: ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.findall(ranked_search.TERM, t or "")]
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(x for _, c in held for x in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = set()
    for item, words in asked.items():
        scored = []
        for i, c in held:
            m = 10 + (90 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 8 * m)) for x in words if x in c)
            if score > 0:
                scored.append((-score, math.inf if i is None else i, i))
        out |= {(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:10], 1)}
    return out


def test_ranked_search_equals_plain_ranking(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 300}"
    docs = [(i, " ".join(word() for _ in range(rng.choice([1, 5, 40, 200])))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (7, None), (3, "")]  # many equal scores
    items = [(q, " ".join(word() for _ in range(rng.choice([1, 8, 30]))).upper()) for q in range(25)] + [(50, docs[7][1]), (51, None), (52, "zzz"), (None, "w1 w2")]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    expected = ranked(docs, items)
    for pairs, batch in ((200_000, 128), (60, 2)):  # one block and several, wide and narrow batches
        monkeypatch.setattr(ranked_search, "BLOCK_PAIRS", pairs)
        monkeypatch.setattr(ranked_search, "BATCH", batch)
        got = ranked_search.search(spark, *frames).collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_shards_of_one_slice_give_the_same(spark):
    docs = [(i, f"a{i % 5} b{i % 7} c") for i in range(60)]
    items = [(0, "a1 b2 c"), (1, "a3")]
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in docs])
    vocabulary = {t.encode(): k for k, t in enumerate(sorted({x for _, q in items for x in q.split()}))}
    rows = [next(ranked_search.posting_writer(vocabulary)(iter([batch.slice(i, 20)]))) for i in (0, 20, 40)]
    weights, queries = np.arange(1, len(vocabulary) + 1), [[vocabulary[x.encode()] for x in q.split()] for _, q in items]
    together = [b.to_pylist() for b in ranked_search.searcher(queries, weights, 60, 180, 10)(iter(rows))]
    apart = [b.to_pylist() for r in rows for b in ranked_search.searcher(queries, weights, 60, 180, 60)(iter([r]))]
    for q in range(len(items)):
        every = sorted(((-x["score"], x["doc_id"]) for part in apart for x in part if x["query"] == q))[:10]
        assert sorted((-x["score"], x["doc_id"]) for x in together[0] if x["query"] == q) == every


def test_ranked_search_of_odd_and_empty(spark, odd):
    items = spark.createDataFrame([(1, "QUICK dog"), (1, "w5"), (2, "ß"), (3, None)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert {tuple(r) for r in ranked_search.search(spark, odd, items).collect()} == ranked(rows, [tuple(r) for r in items.collect()])
    assert ranked_search.search(spark, odd.limit(0), items).count() == 0
    assert ranked_search.search(spark, odd, items.limit(0)).count() == 0


# --- Merkle logs


def test_positions_address_the_log():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096):
        leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
        log = merkle_log.appended(leaves, merkle_log.depth(n))
        level, nodes = 0, leaves
        while True:
            assert [log[merkle_log.position(level, i, n)] for i in range(len(nodes))] == nodes
            if len(nodes) == 1:
                break
            nodes = [merkle_log.digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
            level += 1
        assert log[-1] == nodes[0] and len(log) == merkle_log.position(level, 0, n) + 1


def manifest(docs: list[dict]) -> list[tuple]:
    """The same by whole levels in memory."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    leaf = lambda d, text: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def climb(tree, i, own, proof):
        for nodes in tree[:-1]:
            run = nodes[i - i % 16 : i - i % 16 + 16]
            proof += run[: i % 16] + run[i % 16 + 1 :]
            own, i = sha("".join(run[: i % 16] + [own] + run[i % 16 + 1 :])), i // 16
        return own

    groups = defaultdict(list)
    for d in docs:
        groups[d["source"]].append((d["doc_id"] is not None, d["doc_id"] or 0, leaf(d, d["text"]), d))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, d) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            claimed = own
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 and d["text"] is not None:
                claimed = leaf(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"]))
            proof: list[str] = []
            root = climb(top, k, climb(trees[s], i, claimed, proof), proof)
            out.append((d["doc_id"], own, trees[s][-1][0], top[-1][0], sha("".join(proof)), root, root == top[-1][0]))
    return out


def test_merkle_log_equals_whole_levels(spark, odd, monkeypatch):
    rng = random.Random(8)
    many = [
        {"doc_id": i, "text": f"Text {rng.random()}", "lang": "en", "source": "hot" if i < 5000 else rng.choice([None, "", "b", "ü", *(f"s{j}" for j in range(300))]), "n_chars": i}
        for i in range(6000)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    big = spark.createDataFrame([tuple(d.values()) for d in many], schema).repartition(7)
    as_dicts = lambda df: [r.asDict() for r in df.collect()]
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    for frame, docs in ((big, many), (odd, as_dicts(odd))):
        got = [tuple(r) for r in merkle_log.prove_tampered(spark, frame).collect()]
        assert sorted(got, key=key) == sorted(manifest(docs), key=key)
    assert merkle_log.prove_tampered(spark, odd.limit(0)).count() == 0


# --- line rules


def judged(text: str | None) -> tuple:
    """The contract's measures by plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)


def test_base_measures_equal_plain_loops(spark, odd):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcd") + rng.choice(["", ".", "|"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["\n".join(rng.choice(["Same line here.", "other  line", " ", "x\r"]) for _ in range(9)) for _ in range(50)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(odd.select("doc_id", "text"))
    for r in line_rules.clean_lines(frame).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == judged(r.text)
        assert not (r.base_failed and r.kept)


def test_lines_that_fail_go_and_the_document_is_judged(spark):
    prose = "This is a plain sentence about a river and a bridge."
    cases = {
        "Home | About | News | Contact": True,
        "Start > Shop > Shoes": True,
        "BUY!! NOW!! CHEAP!!": True,
        "a### b%%% c&&& d*** e.": True,
        "No sentence ends in here": True,
        "© 2020 Some Company. All rights reserved.": True,
        "We use cookies to improve the site.": True,
        "Nobody knows who built it, or when.": False,
        "Das ist ein Satz, der \"endet.\"": False,
        "他说这是一个句子。": False,
        "It rose by 5% in May & fell again in June by about as much, he said to the press.": False,
        "": False,
    }
    frame = spark.createDataFrame([(i, f"{prose}\n{x}\nAnother one tells of boats that pass below it at night.") for i, x in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_rules.clean_lines(frame).collect()}
    for i, (line, fails) in enumerate(cases.items()):
        assert (got[i].clean_text.split("\n")[1:-1] == []) == fails, line
        assert got[i].kept
    lost = spark.createDataFrame([(1, f"{prose}\n" + "\n".join(["one | two | three | four"] * 2 + ["red | blue | green | black | white | grey"])), (2, prose)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in line_rules.clean_lines(lost).collect()} == {1: False, 2: True}


def test_line_rules_keep_other_columns_and_null_texts(spark, odd):
    got = line_rules.clean_lines(odd)
    assert [c for c in got.columns if c not in line_rules.RESULTS] == [c for c in odd.columns if c not in line_rules.RESULTS]
    rows = got.collect()
    assert len(rows) == 11 and {r.tree for r in rows} == {"x"}
    assert [r.clean_text for r in rows if r.doc_id == 1] == [None] and [r.clean_text for r in rows if r.doc_id == 2] == [""]
    assert line_rules.clean_lines(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_merkle_log", "op13_line_rules"])
def test_queries_equal_their_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(expected.fetchall())
