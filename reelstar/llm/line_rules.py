"""Quality rules that clean lines first and then judge the document.

Every line is held against rules on punctuation, symbols, shouting, navigation
and boilerplate. Lines that fail are removed; a document is rejected when the
base rules fail on its whole text or when the lines removed hold more than
half of its words. Column functions only: one narrow pass, no shuffle, no
Python, so a document of any length is handled in its own row.

Odd rows: a null or empty text, or one without words, has no words, fails the
base rules and has an empty clean text (null stays null). Repeated rows are
judged each on its own and so alike; a null doc_id is kept. An empty table
gives an empty result. Other columns are kept whatever their names; of a
column named like a result the input's is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns read the same in Java and in RE2, so the SQL form can share them.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"  # what GAP matches
SYMBOL = r"[#*$%&|<>]"
SENTENCE_END = r"[.!?…؟।][)\]\"'”’»]*([\x20\x09-\x0D]|\z)|[。！？]"
SEPARATOR = r"(^|[\x20\x09-\x0D])[|/>»›·•]([\x20\x09-\x0D]|\z)"
SUSPECT = r"[#*$%&|<>/»›·•]|!!"  # a line without any of these passes the three counting rules
BOILERPLATE = (
    r"all rights reserved|copyright|\(c\) [0-9]{4}|©|licensed under|released under|terms of (use|service)|privacy policy"
    r"|cookie|javascript|lorem ipsum|sign (in|up)|log ?in|subscribe|newsletter|click here|read more|share (this|on)"
)
LEAST_WORDS = 10
WINDOW = 5
MOST_REPEATED = 20  # per cent of the words
MOST_LOST = 50  # per cent of the words
LONGEST_BOILERPLATE = 200  # characters; a longer line is prose that mentions such a phrase

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "words_lost", "kept", "clean_text"]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five words that stands twice or more in the list.

    Windows are hashed; only where two hashes agree are the windows themselves
    compared, so a chance agreement of hashes changes nothing.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - WINDOW)
    placed = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("window"), i.alias("at")))
    )

    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def of_pairs(h: Column) -> Column:
        return _bound(
            joined(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1)),
            lambda pairs: joined(joined(F.slice(pairs, 1, n - 4), F.slice(pairs, 3, n - 4)), F.slice(h, WINDOW, n - 4)),
        )

    hashed = _bound(F.transform(words, lambda x: F.xxhash64(x)), of_pairs)

    def twice(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(x["window"] == F.get(ordered, j)["window"], F.lit(False))
        return F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.get(at, j + 1) - x))
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)  # least() skips the null behind the last

    exact = _bound(placed, lambda o: _bound(F.sort_array(F.transform(twice(o), lambda x: x["at"])), covered))
    found = _bound(hashed, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact).otherwise(F.lit(0)))
    return F.when(n > WINDOW, found).otherwise(F.lit(0))


def line_fails(line: Column) -> Column:
    """True for a line that is not prose; lines without words pass."""
    symbols, words = _count(line, SYMBOL), _count(line, WORD)
    symbolic = (symbols >= 2) & (10 * symbols >= 2 * words)
    shouting = 4 * _count(line, "!!") > words
    separators = _count(line, SEPARATOR)
    navigation = (separators >= 2) & (5 * separators >= words)
    phrase = (F.length(line) <= LONGEST_BOILERPLATE) & F.lower(line).rlike(BOILERPLATE)
    return line.rlike(WORD) & (
        ~line.rlike(SENTENCE_END) | phrase | line.rlike(SUSPECT) & (symbolic | shouting | navigation)
    )


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the base measures, the words lost, the verdict and the clean text."""
    docs = docs.drop(*RESULTS)
    row, body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.transform(F.split(body, "\n", -1), lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails")))
    found = docs.select(row.alias("row"), body.alias("body"), _words(body).alias("words"), lines.alias("lines"))
    worded = F.filter(F.transform("lines", lambda x: x["line"]), lambda x: x.rlike(WORD))
    found = found.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("body"), SYMBOL).cast("long").alias("n_symbols"),
        _bound(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.aggregate("lines", F.lit(0), lambda n, x: n + F.when(x["fails"], _count(x["line"], WORD)).otherwise(0)).cast("long").alias("words_lost"),
        F.when(F.col(f"row.`{text}`").isNotNull(), F.array_join(F.transform(F.filter("lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")).alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (100 * F.col("words_lost") <= MOST_LOST * F.col("n_words"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *[{"base_failed": failed, "kept": kept}.get(c, F.col(c)).alias(c) for c in RESULTS])


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = f"""
WITH lines AS (
  SELECT d.rowid_ AS r, u.i AS i, u.line AS line,
    len(regexp_extract_all(u.line, {_quoted(WORD)})) AS w,
    len(regexp_extract_all(u.line, {_quoted(SYMBOL)})) AS sym,
    len(regexp_extract_all(u.line, '!!')) AS shout,
    len(regexp_extract_all(u.line, {_quoted(SEPARATOR)})) AS sep,
    regexp_matches(u.line, {_quoted(SENTENCE_END)}) AS ended,
    length(u.line) <= {LONGEST_BOILERPLATE} AND regexp_matches(lower(u.line), {_quoted(BOILERPLATE)}) AS phrase
  FROM (SELECT row_number() OVER () AS rowid_, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
    LATERAL (SELECT unnest(d.parts) AS line, unnest(range(len(d.parts))) AS i) u
),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i
  FROM (SELECT r, regexp_extract_all(text, {_quoted(WORD)}) AS w FROM docs)
),
windows AS (
  SELECT r, i, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS win
  FROM (SELECT *, count(*) OVER (PARTITION BY r) AS n FROM words)
),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows WHERE i + {WINDOW} <= n) WHERE c > 1
),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY r
),
lost AS (
  SELECT r, sum(CASE WHEN NOT ended OR phrase OR (sym >= 2 AND 10 * sym >= 2 * w) OR 4 * shout > w
                       OR (sep >= 2 AND 5 * sep >= w) THEN w ELSE 0 END) AS lost,
    count(*) - count(DISTINCT line) AS dup
  FROM lines WHERE w > 0 GROUP BY r
),
counted AS (SELECT r, count(*) AS n, sum(length(word)) AS chars FROM words GROUP BY r),
base AS (
  SELECT d.doc_id, coalesce(c.n, 0) AS n_words, coalesce(c.chars, 0) AS word_chars,
    len(regexp_extract_all(d.text, {_quoted(SYMBOL)})) AS n_symbols,
    coalesce(l.dup, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words, coalesce(l.lost, 0) AS words_lost
  FROM docs d LEFT JOIN counted c USING (r) LEFT JOIN lost l USING (r) LEFT JOIN covered v USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  words_lost::BIGINT AS words_lost,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
    AND 100 * words_lost <= {MOST_LOST} * n_words AS kept
FROM base
"""
