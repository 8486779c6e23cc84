"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

``frequent_words`` counts the pre-tokenized words of the whole corpus and
keeps the most frequent ones (a parameter). ``compile_lexicon`` merges each
into its token ids once and compiles the words into an automaton whose states
with equal futures are one state; the numbers on its edges add up to a word's
rank, which finds the ids. The file is handed out with ``addFile`` (Spark
copies it to every executor, also to those that join later) and every Python
worker memory-maps it. Words that are not in it are merged exactly, by rank of
the vocabulary's merges.

Results equal the ``tokenizers`` library's for files of this kind: NFC, white
space to spaces, lower case; words by the file's pattern; byte-level symbols
with a word-end mark; special tokens found in the raw text. Decoding gives
what the library gives without a decoder: the tokens' strings with spaces
between. Null texts are empty: no ids, empty decoded text. A null doc_id is
carried along, repeated rows are each encoded, other columns are ignored, an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import unicodedata
from array import array
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_ids import _byte_chars
from .coded import gather, slices, split_codes

WORDS = 100_000  # lexicon size
_MOST = 400_000  # words kept by a worker; cleared beyond
_LONGEST = 64
_SHORT = 128  # symbols of a word merged without a heap
# fixed values: Unicode White_Space, but for the space itself
_BLANKS = [chr(x) for x in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Words, merges and strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.strings = {i: s for s, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: s for s, i in self.special.items()})
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._byte_chars = _byte_chars()

    def words(self, piece: str) -> list[str]:
        """Words of a piece of text without white space; special tokens' strings are words."""
        if (body := piece[:-1] if piece[-1:] in (".", ",") else piece).isalpha() and _latin(body):
            return [body.lower()] if body is piece else [body.lower(), piece[-1]]
        out = []
        for i, part in enumerate(self._special.split(piece)):
            if i % 2:
                out.append(part)
            elif part:
                # One character at a time: lower case there does not depend on its neighbours.
                text = unicodedata.normalize("NFC", part)
                text = text.lower() if text.isascii() else "".join([c.lower() for c in text])
                out += self.pattern.findall(text)
        return out

    def merged(self, word: str) -> list[int]:
        """Token ids of one word: the adjacent pair of lowest rank, the leftmost of equals, is merged until none is left."""
        if word in self.special:
            return [self.special[word]]
        symbols = list(word.encode().decode("latin-1").translate(self._byte_chars))
        symbols[-1] += self.end
        if len(symbols) > _SHORT:
            return self._merged_long(symbols)
        get, none = self.ranks.get, 1 << 30
        pairs = [get(p, none) for p in zip(symbols, symbols[1:])]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            symbols[i] += symbols.pop(i + 1)
            pairs.pop(i)
            if i:
                pairs[i - 1] = get((symbols[i - 1], symbols[i]), none)
            if i < len(pairs):
                pairs[i] = get((symbols[i], symbols[i + 1]), none)
        return [self.ids[s] for s in symbols]

    def _merged_long(self, symbols: list[str]) -> list[int]:
        """The same with a heap and links, for words of any length."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := self.ranks.get((a, b))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = a + b, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get((symbols[x], symbols[y]))) is not None:
                    heappush(heap, (r, x, symbols[x], symbols[y]))
        return [self.ids[s] for s in symbols if s]


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        return text.encode("latin-1") is not None
    except UnicodeEncodeError:
        return False


# --- the automaton -----------------------------------------------------------


def minimal_states(words: list[bytes]) -> tuple[list[tuple[bool, tuple[tuple[int, int], ...]]], int]:
    """States (final, edges) of the minimal acyclic automaton of sorted distinct words, and its start.

    Built in one pass: when a word leaves the path of the one before it, the
    states it leaves can't change any more and are replaced by equal ones.
    """
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # open states: final, finished edges
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            state = (final, tuple(edges))
            if state not in known:
                known[state] = len(states)
                states.append(state)
            path[-1][1].append((last[len(path) - 1], known[state]))

    for word in words:
        common = len(os.path.commonprefix([last, word]))
        close(common)
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    return states, len(states) - 1


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """File of the transducer: header, first edge of each state, edges, offsets of the ids, ids."""
    ordered = sorted(w for w in words if w)
    states, start = minimal_states(ordered)
    reach: list[int] = []  # words that can be ended from a state; states come after those they lead to
    for final, edges in states:
        reach.append(final + sum(reach[t] for _, t in edges))
    firsts, labels, targets, adds = [0], [], [], []
    for final, edges in states:
        before = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            adds.append(before)
            before += reach[target]
        firsts.append(len(labels))
    ids = [words[w] for w in ordered]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    finals = [int(f) for f, _ in states]
    parts = [np.array(x, dtype="<u4") for x in (firsts, finals, labels, targets, adds, offsets, [i for x in ids for i in x])]
    header = np.array([start, *(len(x) for x in parts)], dtype="<u4")
    return b"".join(x.tobytes() for x in (header, *parts))


class Lexicon:
    """A memory-mapped transducer."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)).cast("I")
        self._start, *sizes = view[:8]
        at, parts = 8, []
        for size in sizes:
            parts.append(view[at : at + size])
            at += size
        self._firsts, self._finals, self._labels, self._targets, self._adds, self._offsets, self._ids = parts

    def find(self, word: bytes) -> list[int] | None:
        """Ids of a word, or None if it is not in the lexicon."""
        state, rank = self._start, 0
        firsts, labels = self._firsts, self._labels
        for byte in word:
            low, high = firsts[state], firsts[state + 1]
            while low < high:  # edges are in order of their labels
                mid = (low + high) // 2
                if labels[mid] < byte:
                    low = mid + 1
                else:
                    high = mid
            if low == firsts[state + 1] or labels[low] != byte:
                return None
            rank += self._adds[low]
            state = self._targets[low]
        if not word or not self._finals[state]:
            return None
        return list(self._ids[self._offsets[rank] : self._offsets[rank + 1]])


# --- tasks -------------------------------------------------------------------

_vocabularies: dict[str, Vocabulary] = {}
_lexicons: dict[str, Lexicon] = {}
_known: dict[tuple[str, str], dict[str, tuple[bytes, str]]] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """White-space pieces of texts, coded."""
    plain = []
    for text in texts.to_pylist():
        text = text or ""
        for blank in _BLANKS:
            if blank in text:
                text = text.replace(blank, " ")
        plain.append(text)
    return split_codes(pc.split_pattern(pa.array(plain, pa.large_string()), " "))


def _counted(path: str):
    def run(batches):
        vocab, total = vocabulary(path), Counter()
        for batch in (part for whole in batches for part in slices(whole)):
            codes, _, pieces = _split(batch.column("text"))
            for piece, n in zip(pieces, np.bincount(codes, minlength=len(pieces)).tolist()):
                for word in vocab.words(piece):
                    total[word] += n
            if len(total) > 2 * _MOST:
                yield _counts(total)
                total.clear()
        yield _counts(total)

    return run


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame, tokenizer: str, most: int = WORDS) -> DataFrame:
    """The ``most`` most frequent words of all texts; ties by the word."""
    words = docs.select("text").mapInArrow(_counted(tokenizer), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)


def share_lexicon(spark: SparkSession, tokenizer: str, words: list[str]) -> str:
    """Compile ``words`` and hand the file to all executors; gives its name there."""
    vocab = vocabulary(tokenizer)
    data = compile_lexicon({w.encode(): vocab.merged(w) for w in words if w not in vocab.special})
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    # addFile sends the file from the driver to Spark's own folder on each executor, whichever machine it is on.
    folder = os.path.join(SparkFiles.getRootDirectory(), "lexicons")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def _digests(tokenizer: str, name: str):
    def run(batches):
        vocab = vocabulary(tokenizer)
        if name not in _lexicons:
            _lexicons[name] = Lexicon(SparkFiles.get(name))
        lexicon = _lexicons[name]
        known = _known.setdefault((tokenizer, name), {})

        def made_of(piece: str) -> tuple[bytes, str]:
            made = []
            for word in vocab.words(piece):
                if (found := known.get(word)) is None:
                    if (ids := lexicon.find(word.encode())) is None:
                        ids = vocab.merged(word)
                    found = array("I", ids).tobytes(), " ".join([vocab.strings[i] for i in ids])
                    if len(word) <= _LONGEST:
                        known[word] = found
                made.append(found)
            return made[0] if len(made) == 1 else (b"".join([x for x, _ in made]), " ".join([x for _, x in made]))

        for batch in (part for whole in batches for part in slices(whole)):
            if len(known) > _MOST:
                known.clear()
            codes, offsets, pieces = _split(batch.column("text"))
            made = [made_of(x) for x in pieces]
            sizes = np.array([len(x) // 4 for x, _ in made], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            lengths = sizes[codes]
            data = memoryview(gather(np.frombuffer(b"".join([x for x, _ in made]), dtype="<u4"), starts[codes], lengths).tobytes())
            ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
            strings = [x for _, x in made]
            codes, offsets = codes.tolist(), offsets.tolist()
            rows = []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                decoded = " ".join(filter(None, map(strings.__getitem__, codes[offsets[i] : offsets[i + 1]])))
                ids = data[ends[i] * 4 : ends[i + 1] * 4]
                rows.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str, most: int = WORDS) -> DataFrame:
    """Digest of the ids and of the decoded text of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = [r["word"] for r in frequent_words(docs, tokenizer, most).collect()]
    name = share_lexicon(spark, tokenizer, words)
    return docs.mapInArrow(_digests(tokenizer, name), _RESULT)
