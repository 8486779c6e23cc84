"""Token ids of the ``tokenizers`` library, looked up by white-space piece.

A byte-level pre-tokenizer cuts before every single space that stands between
two characters that are not white space, so the pieces between such spaces can
be encoded apart and their ids joined. Each distinct piece of a slice of texts
is looked up once; those not kept are cut into the words of the pre-tokenizer
and the library's model encodes the words. Texts with other white space next
to a space, with characters beyond Latin-1 or with a special token's string
go through the whole library call.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .coded import gather, split_codes

# fixed value: the pre-tokenizer's word pattern
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# next to a space these need the library's look-ahead; a line end only when it touches a space
_ODD = ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")
_MOST = 600_000  # words kept by a worker; cleared beyond
_LONGEST = 48  # characters of a word that is kept

_loaded: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = BatchEncoder(path)
    return _loaded[path]


class BatchEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` of a byte-level file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._words: dict[str, bytes] = {}
        self._byte_chars = _byte_chars()

    def _plain(self, text: str) -> bool:
        if any(x in text for x in _ODD) or any(x in text for x in self._special) or text[0] == " " or text[-1] == " ":
            return False
        try:
            return text.isascii() or text.encode("latin-1") is not None
        except UnicodeEncodeError:
            return False

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            tokens = self._model.tokenize(word.encode().decode("latin-1").translate(self._byte_chars))
            ids = np.array([t.id for t in tokens], dtype="<u4").tobytes()
            if len(word) <= _LONGEST:
                self._words[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece of a plain text, with the space before it."""
        if piece[1:].isalpha() and piece[0] == " ":
            return self._word(piece)
        if piece[-1] in ",." and piece[1:-1].isalpha() and piece[0] == " ":
            return self._word(piece[:-1]) + self._word(piece[-1])
        return b"".join([self._word(w) for w in _WORD.findall(piece)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order (unsigned 32-bit), and how many each text has."""
        if len(self._words) > _MOST:
            self._words.clear()
        texts = [t or "" for t in texts]
        plain = [bool(t) and self._plain(t) for t in texts]
        lists = pc.split_pattern(pa.array([t if p else "" for t, p in zip(texts, plain)], pa.large_string()), " ")
        codes, offsets, pieces = split_codes(lists)
        # The first piece of a text has no space before it; other texts are one piece.
        alone = [
            (b"".join([self._word(w) for w in _WORD.findall(t.split(" ", 1)[0])]) if p else self._whole(t))
            for t, p in zip(texts, plain)
        ]
        n = len(pieces)
        codes = codes.astype(np.int64)
        firsts = offsets[:-1]
        used = np.ones(len(codes), dtype=bool)
        used[firsts] = False
        needed = np.zeros(n, dtype=bool)
        needed[codes[used]] = True
        table = [self._piece(" " + x) if y else b"" for x, y in zip(pieces, needed.tolist())] + alone
        codes[firsts] = n + np.arange(len(texts))
        sizes = np.array([len(x) // 4 for x in table], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ids = gather(np.frombuffer(b"".join(table), dtype="<u4"), starts[codes], lengths)
        return ids, np.add.reduceat(lengths, firsts) if len(texts) else np.zeros(0, dtype=np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() if text else b""


def _byte_chars() -> dict[int, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed value: bytes that stand for themselves
    rest = [x for x in range(256) if x not in plain]
    return {x: x for x in plain} | {x: 256 + i for i, x in enumerate(rest)}


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
