"""Records of JSON texts whose layout is found from the text itself.

A landed file may hold JSON lines, one array of records on one line, an array
with a record a line, or a pretty-printed array or object over many lines; one
tree may mix them. Nothing tells the reader which, so each line is looked at:

* ``{...}`` from the first column to the end (a trailing comma aside) is a
  record, ``[...]`` an array of records, ``[``, ``]`` and blank lines are
  layout only. Such lines need no other line, so large files stay splittable.
* Any other line is a fragment. The fragments of one file, in their order,
  are put together and read as the elements of an array; that covers every
  pretty-printed form. Fragments that are no JSON together are malformed: one
  record if they look like a document (indented, or a lone brace), else one
  record a line.

All of it is column functions, the same for files in batch, for streamed files
and for texts in a column. A malformed record is kept as its text, to be
counted and set aside by the reader; none is dropped in silence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
SOURCE = "_source_file"
_END = ", \t\r\n"  # what may follow a record on its line
_BOM = "﻿"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _bare(line: Column) -> Column:
    text = F.ltrim(line, F.lit(_BOM))
    # a right trim goes through the whole line: only where there is something to trim
    ends = reduce(or_, (line.endswith(c) for c in _END))
    return F.when(ends, F.rtrim(text, F.lit(_END))).otherwise(text)


def _framed(text: Column, opening: str, closing: str) -> Column:
    return text.startswith(opening) & text.endswith(closing) & (F.length(text) > 1)


def _is_layout(bare: Column) -> Column:
    bracket = F.ltrim(bare, F.lit(_END)).isin("[", "]") & ~bare.rlike(r"^\s+[\[\]]")
    return (bare == "") | ((bare.endswith("[") | bare.endswith("]")) & bracket)


def _is_complete(bare: Column) -> Column:
    return _framed(bare, "{", "}") | _framed(bare, "[", "]")


def _elements(text: Column) -> Column:
    """Texts of the elements of an array; null if it is none."""
    return F.transform(F.from_json(text, "array<string>"), lambda x: F.coalesce(x, F.lit("null")))


def _marked(texts: Column, broken: bool = False) -> Column:
    return F.transform(texts, lambda x: F.struct(x.alias("record"), F.lit(broken).alias("broken")))


def _records_of_value(text: Column) -> Column:
    """Records of a line that stands for itself; the line as a broken record if it is no JSON."""
    # The parser ends with the first value: where others may follow, it reads them as an array.
    values = F.when(text.rlike(r"[}\]]\s*,?\s*[{\[]"), _elements(F.concat(F.lit("["), text, F.lit("]")))).otherwise(F.array(text))
    records = F.flatten(F.transform(values, lambda x: F.when(x.startswith("["), _elements(x)).otherwise(F.array(x))))
    return F.coalesce(_marked(records), _marked(F.array(text), True))


def _records_of_fragments(lines: Column) -> Column:
    joined = F.array_join(lines, "\n")

    def of_elements(found: Column) -> Column:
        values = F.flatten(F.transform(found, lambda x: F.when(x.startswith("["), F.coalesce(_elements(x), F.array(x))).otherwise(F.array(x))))
        return F.when(found.isNotNull(), _marked(values)).otherwise(_let(F.transform(lines, lambda x: F.trim(_bare(x))), of_lines))

    def of_lines(trimmed: Column) -> Column:
        own = F.forall(trimmed, lambda x: _framed(x, "{", "}"))
        document = F.exists(lines, lambda x: x.rlike(r"^\s") | _bare(x).isin("{", "}"))
        broken = F.when(document, F.array(joined)).otherwise(trimmed)
        return F.when(own, F.flatten(F.transform(trimmed, _records_of_value))).otherwise(_marked(broken, True))

    return _let(_elements(F.concat(F.lit("["), F.rtrim(F.ltrim(joined, F.lit(_BOM)), F.lit(_END)), F.lit("]"))), of_elements)


def records_of_lines(lines: Column) -> Column:
    """All records of a file (``record``, ``broken``), given its lines in their order."""
    none = F.array().cast("array<struct<record:string,broken:boolean>>")

    def of_bare(lines: Column) -> Column:
        complete = F.filter(lines, lambda x: _is_complete(x["bare"]))
        others = F.filter(lines, lambda x: ~(_is_complete(x["bare"]) | _is_layout(x["bare"])))
        fragments = _let(F.transform(others, lambda x: x["line"]), lambda x: F.when(F.size(x) > 0, _records_of_fragments(x)).otherwise(none))
        return F.concat(F.flatten(F.transform(complete, lambda x: _records_of_value(x["bare"]))), fragments)

    return _let(F.transform(lines, lambda x: F.struct(x.alias("line"), _bare(x).alias("bare"))), of_bare)


def records_of_text(text: Column) -> Column:
    """The same for a whole text; none for a null or blank text."""
    return records_of_lines(F.split(F.coalesce(text, F.lit("")), "\n", -1))


def parsed(records: DataFrame, schema: StructType) -> DataFrame:
    """``record`` texts as the columns of ``schema`` and ``_corrupt_record``; other columns are kept.

    A record that is broken or no object, or holds a value its column cannot
    take, keeps its text in ``_corrupt_record``.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [c for c in records.columns if c not in ("record", "broken")]
    # Out of an array of one: else a later filter is moved below and every record is read once more for it.
    of = F.explode(F.array(F.from_json(F.when(~F.col("broken"), F.col("record")), full, options))).alias("of")
    found = records.select(*kept, "record", of)
    corrupt = F.coalesce(F.col(f"of.{CORRUPT}"), F.when(F.col("of").isNull(), F.col("record")))
    return found.select(*[F.col(f"of.{f.name}").alias(f.name) for f in schema.fields], corrupt.alias(CORRUPT), *kept)


def scan_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record`` (its text), ``broken`` and ``_source_file`` of every record in the files of ``path``.

    Two readings of the text: one takes the lines that stand for themselves,
    split within files; the other looks for fragments by their first and last
    characters and brings together those of each file. Only fragments are
    shuffled, so a tree of JSON lines moves nothing.
    """
    text = spark.read.text(path)
    line = F.col("value")
    bare = _bare(line)
    file = F.col("_metadata.file_path").alias(SOURCE)
    complete = text.where(_is_complete(bare)).select(F.inline(_records_of_value(bare)), file)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), line.alias("line"))
    fragments = text.where(~_is_layout(bare) & ~_is_complete(bare)).select(file, place.alias("place"))
    ordered = F.transform(F.sort_array(F.collect_list("place")), lambda x: x["line"])
    documents = fragments.groupBy(SOURCE).agg(ordered.alias("lines"))
    whole = documents.select(F.inline(_records_of_fragments(F.col("lines"))), SOURCE)
    return complete.unionByName(whole)


def scan(spark: SparkSession, path: str | list[str], schema: StructType, *, allow_missing: bool = False) -> DataFrame:
    """All records of the files of ``path``: the schema's columns, ``_corrupt_record``, ``_source_file``.

    With ``allow_missing`` a path without files gives an empty frame.
    """
    try:
        return parsed(scan_records(spark, path), schema)
    except AnalysisException as exc:
        if allow_missing and "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], StructType([*schema.fields, StructField(CORRUPT, StringType(), True), StructField(SOURCE, StringType(), True)]))
        raise


def scan_stream(spark: SparkSession, path: str, schema: StructType, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same of a stream of files. A streamed file is one row until its records are taken out of it."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    text = reader.text(path, wholetext=True)
    records = text.select(F.inline(records_of_text(F.col("value"))), F.col("_metadata.file_path").alias(SOURCE))
    return parsed(records, schema)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Separate malformed records from good ones (a quarantine, not a drop).

    Returns ``(good, corrupt)``: ``good`` without the corrupt-record column,
    ``corrupt`` with the text and its source file, to be written aside and
    counted. Both are lazy filters of the same scan.
    """
    if CORRUPT not in df.columns:
        return df, df.where(F.lit(False))
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, SOURCE)
