"""Latest-per-key (top-1 per group) and deterministic deduplication.

One operator covers the four "latest X per key" steps of the transform and
the event dedup: ``row_number() over (partition by keys order by ...) = 1``.

Why the window form and not ``dropDuplicates``: ``dropDuplicates`` keeps an
arbitrary survivor, which may differ between the actions that recompute it,
so dimensions and fact could disagree. Here the order is made total (caller
order, then a hash of the whole row) so the survivor is a function of the
data only, independent of partitioning and input order.

Why it scales: Catalyst rewrites a ``row_number`` filter into a
``WindowGroupLimit`` that runs *partially before the shuffle* (each map task
keeps only its top-n per key) and finally after it. A hot key — 100 media
over billions of events, or all null event keys in one group — therefore
sends at most n rows per map task across the network instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"
SOURCE = "_source_file"
RUN_ROOT = r"^.*/(?=run_date=)"  # of a landed file's path: what stands before its run


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_tiebreak(df: DataFrame) -> Column:
    """Deterministic last-resort order: a 64-bit hash of every column.

    The hash skips nulls, so each column also gives a flag that says whether
    it is null: rows whose nulls stand in other columns do not tie. Rows that
    do tie are (up to hash collisions) identical, so whichever survives gives
    the same output. Of a source path only what stands from the run on counts,
    so a tree that is moved as a whole keeps its survivors.
    """
    value = lambda c: F.regexp_replace(c, RUN_ROOT, "") if c == SOURCE else F.col(c)
    parts = [x for c in df.columns for x in (F.col(c).isNull(), value(c))]
    return F.xxhash64(*parts).desc()


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column],
    *,
    n: int = 1,
    null_keys: str = "keep_one",
    total: bool = True,
) -> DataFrame:
    """Keep the first ``n`` rows per key under ``order``.

    ``order`` is a list of sort expressions (``F.col(x).desc()``...). With
    ``total=True`` a whole-row hash is appended so ties never fall to chance.

    ``null_keys``: ``keep_one`` treats all-null keys as one group (what
    ``dropDuplicates`` does), ``drop`` removes them, ``keep_all`` passes them
    through untouched.
    """
    key_cols = _cols(keys)
    sort = list(order) + ([row_tiebreak(df)] if total else [])
    any_null = None
    for k in key_cols:
        cond = F.col(k).isNull()
        any_null = cond if any_null is None else (any_null | cond)

    body = df
    passthrough = None
    if null_keys == "drop":
        body = df.where(~any_null)
    elif null_keys == "keep_all":
        body = df.where(~any_null)
        passthrough = df.where(any_null)
    elif null_keys != "keep_one":
        raise ValueError(f"unknown null_keys mode: {null_keys!r}")

    w = Window.partitionBy(*key_cols).orderBy(*sort)
    out = body.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= n).drop(_RN)
    if passthrough is not None:
        out = out.unionByName(passthrough)
    return out


def dedup(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column] = (),
    *,
    null_keys: str = "keep_one",
) -> DataFrame:
    """One row per key; the survivor is the first under ``order`` (then row hash)."""
    return latest_per_key(df, keys, order, n=1, null_keys=null_keys)


def first_n_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column],
    n: int,
) -> DataFrame:
    """Bounded sample: the first ``n`` rows of every group (a top-k report)."""
    return latest_per_key(df, keys, order, n=n, null_keys="keep_one")
