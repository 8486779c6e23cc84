"""Merkle manifest of a table as postorder append logs, with proofs read by address.

Each group of rows (a source) is a tree of 16 children a node over its rows in
key order; the trees' roots, in group order, are the leaves of the root tree.
A tree is written by aligned builders: one takes 4,096 consecutive leaves, a
perfect subtree of three levels, and appends every node at the moment it is
complete, leaves included. The node a builder ends with is a leaf of the next
tier, which is built the same way, until one node is left. So no task ever
holds more than one aligned block, and a hot group is spread over its blocks.

The position of a node follows from subtree sizes alone. Before leaf ``e``
stand ``e`` leaves and ``e // 16 + e // 256 + ...`` complete subtrees; a node of
level ``l`` is written ``l`` places after the last leaf below it. Proofs use
this address for every sibling; nothing is searched.

Odd rows: nulls are leaves like any other (a null field is ``-``); a null group
is a group of its own, before the others; rows of one key, null keys first, are
in the order of their digests, so repeated rows have their own leaves; texts of
any length are hashed in their row. An empty table gives an empty result. Only
the named columns are read, so others and their names have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged

ARITY = 16
LEVELS = 3  # of a builder's subtree
BLOCK = ARITY**LEVELS
NODES = (ARITY ** (LEVELS + 1) - 1) // (ARITY - 1)  # of a complete block
DIGEST = 32  # bytes of a node in the log

PATH = "array<struct<before string, after string>>"
SEGMENT = "tree string, n long, block long, first_position long, leaves int, digests binary, top string"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above the leaves until one node is left."""
    d = 0
    while n > 1:
        n, d = -(-n // ARITY), d + 1
    return d


def position(level: int, index: int, n: int) -> int:
    """Place in the log of the ``index``-th node of a level, in a tree of ``n`` leaves."""
    last, step = min((index + 1) * ARITY**level, n) - 1, ARITY
    before = last
    while step <= last:
        before += last // step
        step *= ARITY
    return before + level


def appended(leaves: list[str], levels: int) -> list[str]:
    """All nodes of one block in the order of their completion; the last one is its top."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = digest("".join(waiting[level]))
        waiting[level].clear()
        waiting[level + 1].append(node)
        log.append(node)

    for leaf in leaves:
        log.append(leaf)
        waiting[0].append(leaf)
        level = 0
        while level < levels and len(waiting[level]) == ARITY:
            close(level)
            level += 1
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def levels_of(n: int) -> int:
    """Levels of a block in a tier of ``n`` leaves: whole blocks while another tier follows."""
    return LEVELS if n > BLOCK else depth(n)


def siblings(log: bytes, leaf: int, leaves: int, levels: int) -> list[dict[str, str]]:
    """For each level of a block, the run's other nodes before and after the path from ``leaf``, read by address."""

    def node(level: int, index: int) -> str:
        at = DIGEST * position(level, index, leaves)
        return log[at : at + DIGEST].hex()

    path, wide = [], leaves
    for level in range(levels):
        own = leaf // ARITY**level
        run = own - own % ARITY
        path.append(
            {
                "before": "".join([node(level, i) for i in range(run, own)]),
                "after": "".join([node(level, i) for i in range(own + 1, min(run + ARITY, wide))]),
            }
        )
        wide = -(-wide // ARITY)
    return path


def folded(leaf: str, path: list[dict[str, str]]) -> str:
    for step in path:
        leaf = digest(step["before"] + leaf + step["after"])
    return leaf


def proof_digest(path: list[dict[str, str]]) -> str:
    return digest("".join([step["before"] + step["after"] for step in path]))


# --- leaves and their places


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 length, a colon and its value."""

    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(columns[name]) for name in FIELDS]), 256)


def placed(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` in the order of ``order`` within ``tree``, and ``n``, the size of the tree.

    Rows are cut into ranges of (tree, order), so a hot tree is many ranges; only
    a count for each range and tree is added up.
    """
    ordered = staged(
        spark,
        rows.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "merkle-order",
    )
    counts = ordered.groupBy("part", "tree").agg(F.count("*").alias("own"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("own").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", "tree", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("own").over(tree).alias("n"))
    found = ordered.join(starts, ["part", "tree"]).withColumn("idx", F.col("before") + F.col("at") - F.col("first"))
    return found.drop("part", "at", "first", "before")


# --- the log


def _built(key: tuple, rows: pa.Table) -> pa.Table:
    tree, block = (x.as_py() for x in key)
    rows = rows.sort_by("idx")
    n = rows.column("n")[0].as_py()
    log = appended(rows.column("leaf").to_pylist(), levels_of(n))
    return pa.table(
        {
            "tree": pa.array([tree], pa.string()),
            "n": pa.array([n], pa.int64()),
            "block": pa.array([block], pa.int64()),
            "first_position": pa.array([block * NODES], pa.int64()),
            "leaves": pa.array([rows.num_rows], pa.int32()),
            "digests": pa.array([bytes.fromhex("".join(log))], pa.binary()),
            "top": pa.array([log[-1]], pa.string()),
        }
    )


def append_logs(spark: SparkSession, leaves: DataFrame) -> list[DataFrame]:
    """The logs of all trees of ``leaves`` (tree, idx, n, leaf), one table of segments a tier."""
    tiers = []
    while True:
        blocks = leaves.select("tree", "idx", "n", "leaf", F.expr(f"idx div {BLOCK}").alias("block"))
        segments = staged(spark, blocks.groupBy("tree", "block").applyInArrow(_built, SEGMENT), f"merkle-log-{len(tiers)}")
        tiers.append(segments)
        above = segments.where(F.col("n") > BLOCK)
        if above.isEmpty():
            return tiers
        leaves = above.select("tree", F.col("block").alias("idx"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("leaf"))


def tops(tiers: list[DataFrame]) -> DataFrame:
    """The root of each tree."""
    found = [t.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("subroot")) for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


# --- proofs


def _leaf_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in batch.to_pylist():
            levels, base = levels_of(s["n"]), s["block"] * BLOCK
            for start in range(0, s["leaves"], 256):
                at = range(start, min(start + 256, s["leaves"]))
                paths = [siblings(s["digests"], i, s["leaves"], levels) + s["path"] for i in at]
                yield pa.RecordBatch.from_pylist(
                    [{"tree": s["tree"], "idx": base + i, "path": p} for i, p in zip(at, paths)],
                    schema=pa.schema(
                        [("tree", pa.string()), ("idx", pa.int64()), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))]
                    ),
                )


def with_paths(spark: SparkSession, tiers: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Segments of the lowest tier with ``path``, the siblings from their top node up to the last root.

    ``above`` (tree, path) leads on from the root of each tree; none does if it is None.
    """
    upper: DataFrame | None = None
    for tier, segments in reversed(list(enumerate(tiers))):
        last = segments.where(F.col("n") <= BLOCK)
        last = last.withColumn("path", F.array().cast(PATH)) if above is None else last.join(above, "tree")
        found = last
        if upper is not None:
            onward = segments.where(F.col("n") > BLOCK).join(upper.withColumnRenamed("idx", "block"), ["tree", "block"])
            found = found.unionByName(onward)
        if tier == 0:
            return found
        upper = staged(spark, found.mapInArrow(_leaf_paths, f"tree string, idx long, path {PATH}"), f"merkle-paths-{tier}")
    raise ValueError("a log has one tier at least")


def _proved(rows: pa.Table, segment: pa.Table) -> pa.Table:
    s = segment.to_pylist()[0]
    levels, base = levels_of(s["n"]), s["block"] * BLOCK
    out = []
    for row in rows.to_pylist():
        path = siblings(s["digests"], row["idx"] - base, s["leaves"], levels) + s["path"]
        root = folded(row["leaf"] if row["claimed"] is None else row["claimed"], path)
        out.append((row["doc_id"], row["leaf"], s["subroot"], s["root"], proof_digest(path), root, root == s["root"]))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def prove(spark: SparkSession, docs: DataFrame, tampered: Column, claim: Column) -> DataFrame:
    """Builds the manifest of ``docs`` and folds each row's proof.

    Rows where ``tampered`` holds claim the text ``claim`` instead of their own;
    their leaf is hashed anew from it and folded with the original siblings.
    """
    own = {name: F.col(f"`{name}`") for name in FIELDS}
    leaves = staged(
        spark,
        docs.select(
            F.coalesce(F.concat(F.lit("1"), own["source"]), F.lit("0")).alias("tree"),  # null before all, order kept
            own["doc_id"].cast("long").alias("doc_id"),
            leaf_digest(own).alias("leaf"),
            F.when(tampered, leaf_digest(own | {"text": claim})).alias("claimed"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    rows = staged(spark, placed(spark, leaves, ["doc_id", "leaf", "row"]), "merkle-placed")
    tiers = append_logs(spark, rows)
    subroots = tops(tiers)
    trees = staged(
        spark,
        placed(spark, subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("leaf")), ["of"]),
        "merkle-trees",
    )
    root_tiers = append_logs(spark, trees)
    root_paths = with_paths(spark, root_tiers, None).mapInArrow(_leaf_paths, f"tree string, idx long, path {PATH}")
    root = tops(root_tiers).select("tree", F.col("subroot").alias("root"))
    above = staged(
        spark,
        trees.join(root_paths, ["tree", "idx"]).join(root, "tree").select(F.col("of").alias("tree"), F.col("leaf").alias("subroot"), "root", "path"),
        "merkle-above",
    )
    segments = with_paths(spark, tiers, above.select("tree", "path")).join(above.drop("path"), "tree")
    rows = rows.select("tree", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "doc_id", "leaf", "claimed")
    return rows.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(_proved, RESULT)


def prove_tampered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Proofs of all documents, where 5 divides the CRC-32 of the decimal id with the text's A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return prove(spark, docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", upper, lower))


# --- the same in SQL, with as many levels as the tables of the checks need


def _sql(levels: int = 6) -> str:
    def leaf(text: str) -> str:
        fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join(fields)} || coalesce(strlen({text})::VARCHAR || ':' || {text}, '-'))"

    byte = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384))"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda c, b: {byte}), 4294967295)"
    folded_text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"base AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND ({crc}) % 5 = 0 THEN {leaf(folded_text)} ELSE {leaf('text')} END AS claimed FROM documents)",
        "a0 AS (SELECT coalesce('1' || source, '0') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM base)",
        "p0 AS (SELECT row_number() OVER () AS r, doc_id, leaf, coalesce('1' || source, '0') AS tree,"
        " row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, claimed AS h, '' AS proof FROM base)",
    ]

    def climb(nodes: str, proofs: str, at: int) -> None:
        # one level: runs of 16 become their digest where a tree has several nodes
        one, two = f"{nodes}{at}", f"{nodes}{at + 1}"
        parts.append(f"{one}n AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {one})")
        parts.append(
            f"{two} AS MATERIALIZED (SELECT tree, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {one}n WHERE n > 1 GROUP BY tree, i // 16"
            f" UNION ALL SELECT tree, i, h FROM {one}n WHERE n = 1)"
        )
        parts.append(
            f"{proofs}{at + 1} AS MATERIALIZED (SELECT p.r, any_value(p.doc_id) AS doc_id, any_value(p.leaf) AS leaf, any_value(p.tree) AS tree,"
            " any_value(CASE WHEN s.n > 1 THEN p.i // 16 ELSE p.i END) AS i,"
            " CASE WHEN any_value(s.n) > 1 THEN sha256(string_agg(CASE WHEN s.i = p.i THEN p.h ELSE s.h END, '' ORDER BY s.i)) ELSE any_value(p.h) END AS h,"
            " any_value(p.proof) || coalesce(string_agg(CASE WHEN s.i <> p.i THEN s.h END, '' ORDER BY s.i), '') AS proof"
            f" FROM {proofs}{at} p JOIN {one}n s ON s.tree = p.tree AND s.i // 16 = p.i // 16 GROUP BY p.r)"
        )

    for k in range(levels):
        climb("a", "p", k)
    parts.append(f"b0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, tree AS source, h FROM a{levels})")
    parts.append(f"q0 AS MATERIALIZED (SELECT p.r, p.doc_id, p.leaf, b.tree, b.i, p.h, p.proof FROM p{levels} p JOIN b0 b ON b.source = p.tree)")
    for k in range(levels):
        climb("b", "q", k)
    return (
        "WITH "
        + ",\n".join(parts)
        + f"\nSELECT q.doc_id, q.leaf, b0.h AS subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.h AS folded_root, q.h = t.h AS verified"
        f" FROM q{levels} q JOIN p0 USING (r) JOIN b0 ON b0.source = p0.tree CROSS JOIN b{levels} t"
    )


SQL = _sql()
