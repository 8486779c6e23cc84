"""Structure profiling of raw JSON records (Q1-Q4, Q6).

The exploration scripts printed the fields and types of the *first* record
of a sample. Here every record is profiled, distributed: each JSON text is
parsed into a VARIANT, exploded with ``variant_explode`` and the (field, type)
pairs are counted with a partially-aggregated ``groupBy``. Nested values are
walked level by level, as deep as the records go: what is nested in one level
is staged and read by the next, so no record is parsed from its top again. The
output is one row per field and type, so it stays small however many records
there are.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.session import checkpoint_dir, remove_path

# JSON type of a VARIANT value, from its ``schema_of_variant`` string.
_JSON_TYPE_SQL = """
CASE
  WHEN {s} LIKE 'OBJECT%' THEN 'object'
  WHEN {s} LIKE 'ARRAY%' THEN 'array'
  WHEN {s} = 'STRING' THEN 'string'
  WHEN {s} = 'BOOLEAN' THEN 'boolean'
  WHEN {s} = 'VOID' THEN 'null'
  ELSE 'number'
END"""


def _json_type(schema_expr: str) -> str:
    return _JSON_TYPE_SQL.format(s=schema_expr)


ROOT = "$"


def field_profile(spark: SparkSession, records: DataFrame, json_col: str = "json", *, totals: bool = False) -> DataFrame:
    """Q1/Q2/Q4: (field, json_type, records) over all top-level keys.

    With ``totals`` the field ``$`` tells how many records there are
    (``record``), by the type of their root, and how many texts are no JSON
    (``rejected``; a null text is one), from the same pass.
    """
    root = f"CASE WHEN t.v IS NULL THEN 'rejected' ELSE {_json_type('schema_of_variant(t.v)')} END"
    own = f"named_struct('field', f.key, 'json_type', {_json_type('schema_of_variant(f.value)')})"
    marks = f"named_struct('field', '{ROOT}', 'json_type', 'record'), named_struct('field', '{ROOT}', 'json_type', {root})"
    # the first (or only) row of a record carries its totals
    entries = f"CASE WHEN coalesce(f.pos, 0) = 0 THEN array({marks}, {own}) ELSE array({own}) END" if totals else f"array({own})"
    return spark.sql(
        f"""
        SELECT field, json_type, COUNT(*) AS records
        FROM (SELECT inline({entries})
              FROM (SELECT try_parse_json({json_col}) AS v FROM {{src}}) t,
                   LATERAL variant_explode_outer(t.v) AS f)
        WHERE field IS NOT NULL
        GROUP BY 1, 2
        """,
        src=records,
    )


def _children(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Members and elements of nested values (``field``, ``json``), an empty array as one row without a value."""
    return spark.sql(
        """
        SELECT t.field AS parent,
               CASE WHEN f.key IS NOT NULL THEN concat_ws('.', t.field, f.key) ELSE concat(coalesce(t.field, '$'), '[]') END AS field,
               f.key IS NULL AND f.pos IS NULL AS empty,
               CASE WHEN t.is_array THEN json_array_length(t.json) END AS array_length,
               f.value AS v
        FROM (SELECT *, try_parse_json(json) AS v, startswith(json, '[') AS is_array FROM {src}) t,
             LATERAL variant_explode_outer(t.v) AS f
        WHERE t.v IS NOT NULL AND (f.pos IS NOT NULL OR t.is_array)
        """,
        src=nodes,
    )


def nested_profile(spark: SparkSession, records: DataFrame, json_col: str = "json") -> DataFrame:
    """Q3: fields at every depth below the top level, in objects and in arrays.

    ``field`` is the path: ``parent.child`` for members, ``parent[]`` for the
    elements of arrays (all of them), so ``steps[].mark.share`` is the member of
    a member of an array's elements. ``records`` counts values. Rows of array
    elements give the range of their arrays' lengths; empty arrays are counted
    under the type ``empty``. Malformed records are left out.
    """
    app = spark.sparkContext.applicationId
    folder = f"{checkpoint_dir(spark).rstrip('/')}/reelstar-profile/{app}/{uuid.uuid4().hex}"
    nodes = records.select(F.lit(None).cast("string").alias("field"), F.col(json_col).alias("json"))
    levels: list[DataFrame] = []
    depth = 0
    while True:
        kids = _children(spark, nodes)
        if depth:  # the top level is field_profile's
            kind = _json_type("schema_of_variant(v)")
            levels.append(
                kids.groupBy("parent", "field", F.expr(f"CASE WHEN empty THEN 'empty' ELSE {kind} END").alias("json_type")).agg(
                    F.count(F.lit(1)).alias("records"),
                    F.min("array_length").cast("long").alias("min_array_length"),
                    F.max("array_length").cast("long").alias("max_array_length"),
                )
            )
        nested = kids.where("schema_of_variant(v) LIKE 'OBJECT%' OR schema_of_variant(v) LIKE 'ARRAY%'")
        path = f"{folder}/depth={depth}"
        nested.select("field", F.expr("to_json(v)").alias("json")).write.parquet(path)
        nodes = spark.read.schema("field string, json string").parquet(path)
        if nodes.isEmpty():
            break
        depth += 1
    if not levels:
        return spark.createDataFrame([], "parent string, field string, json_type string, records long, min_array_length long, max_array_length long")
    found = reduce(DataFrame.unionByName, levels)
    # the answer is small: written once, so the levels' values can go
    found.write.parquet(f"{folder}/profile")
    for d in range(depth + 1):
        remove_path(spark, f"{folder}/depth={d}")
    return spark.read.schema(found.schema).parquet(f"{folder}/profile")


def records_as_json(df: DataFrame, *, keep_nulls: bool = True) -> DataFrame:
    """Encode each row as one JSON object (F17); null fields kept as ``null``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias("json"))


def visitor_last_event(visitors: DataFrame, events: DataFrame) -> DataFrame:
    """Q6: follow every visitor's ``last_event_key`` to that event (all visitors,
    not just the first): an equi-join on the event key."""
    ev = events.select(
        F.col("event_key").alias("last_event_key"),
        F.col("media_id").alias("last_media_id"),
        F.col("received_at").alias("last_received_at"),
    )
    return visitors.join(ev, "last_event_key", "left")
