"""Deterministic adapter: driver test tables -> raw engagement frames.

The driver's tables are TPC-H-ish, not engagement data, so this module gives
them the shape of landed raw records. Every frame is derived by Spark from the
given tables, so its size grows with the scale factor. The same rules are
written once more as SQL CTEs in :mod:`reelstar.plans.oracle`.

Rules (``k`` is the integer ``k`` of ``events.props``):

* events: ``event_key='ev-'||event_id``, ``media_id='m'||k`` (``'x'||k``, a media
  outside the catalog, from a ``value`` of 150 on; null for ``error`` events of
  such a value), visitor key
  ``'u'||user_id`` (null — an anonymous visitor — for ``error`` events), URL
  of page ``event_id % (max(page_id) + 1)``, received time as the ISO string of ``ts``,
  ``percent_viewed=least(value/100, 1)``, geography from the customer row
  of ``user_id``, user agent from ``event_type``/``k``.
* two landing runs with redelivery: run 1 holds events before 2024-01-20,
  run 2 those from 2024-01-15 on; the overlap is landed twice.
* media metadata from ``part`` (``media_id='m'||p_partkey``): run 1 has every
  part, run 2 re-lists those with ``p_size >= 25`` under a new
  title (titles repeat, so GROUP BY title merges media); PROMO parts keep
  the same ``updated`` in both runs, so the run order breaks the tie.
* media stats from ``part``: every part in run 1, those with ``p_size >= 10``
  again in run 2.
* marks before the landing run: every part has one; those of PROMO parts and
  of the null media are earlier, those of ECONOMY parts do not parse (such
  media land in full).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.functions import columns as fn
from reelstar.sources.raw import NULL_PARTITION

# --- fixed values -----------------------------------------------------------
RUN1_ID, RUN1_DATE = "20240120T060000Z", "2024-01-20"
RUN2_ID, RUN2_DATE = "20240131T060000Z", "2024-01-31"
RUN1_BEFORE = "2024-01-20 00:00:00"  # run 1 holds events strictly before this
RUN2_FROM = "2024-01-15 00:00:00"  # run 2 holds events from this on
MEDIA_CREATED = "2024-01-01T00:00:00.000Z"
MEDIA_UPDATED_R1 = "2024-01-10T00:00:00.000Z"
MEDIA_UPDATED_R2 = "2024-01-25T00:00:00.000Z"
EXTERNAL_FROM = 150.0  # events of this value or more belong to media outside the catalog
INCREMENTAL_MARK = "2024-01-20T12:00:00.000Z"  # checkpoint for the landing queries
EARLY_MARK = "2024-01-12T00:00:00.000Z"  # of PROMO parts
BAD_MARK = "unknown"  # of ECONOMY parts
FILE_IDS = 5000  # ids whose records share a landed file
CUT_RECORD = '{"event_key": "cut'  # last line of every file of run 2
CUT_STATS = '{\n  "play_rate" : 0.'
# Channel rules that match the adapter's page URLs (the defaults match none).
ADAPTER_CHANNEL_RULES = (("blog.", "Blog"), ("//m.", "Mobile"))
# ---------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the input tables the adapter reads (identical at every
# scale). Declaring them skips a schema-inference job per read.
INPUT_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(INPUT_SCHEMAS[name]) if name in INPUT_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def channel_rules() -> tuple[tuple[str, str], ...]:
    return tuple(fn.DEFAULT_CHANNEL_RULES) + ADAPTER_CHANNEL_RULES


def _page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL of every page; ``html`` is never read. The planner's size check decides how it joins."""
    return table(spark, sf_dir, "pages").groupBy("page_id").agg(F.min("url").alias("media_url"))


def _page_of(spark: SparkSession, sf_dir: str, event_id: F.Column) -> F.Column:
    """The page an event is seen on: all pages are used, whatever their number."""
    pages = table(spark, sf_dir, "pages").select((F.max("page_id") + 1).alias("n")).scalar()
    return event_id % pages


def _with_geo(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """country/region/city of ``user_id`` via customer -> nation -> region.

    Joined one table at a time, each a plain pruned scan, so the planner's
    size check sees each table's own estimate (a joined customer-nation-region
    frame would be estimated at the product of the three sizes and never
    broadcast). customer grows with the data: broadcast while small, a
    shuffle join (skew-split by AQE) beyond; nation and region are tiny.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        events.join(customer, events.user_id == customer.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        .withColumnRenamed("n_name", "country")
        .withColumnRenamed("r_name", "region")
        .withColumnRenamed("c_mktsegment", "city")
    )


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event source as an API would serve it: one record per event."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.withColumn("k", k).withColumn("page_id", _page_of(spark, sf_dir, F.col("event_id")))
    pages = _page_urls(spark, sf_dir)
    joined = _with_geo(e.join(pages, "page_id", "left"), spark, sf_dir)
    uid = F.col("user_id")
    return joined.select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("event_key"),
        F.when(
            ~((F.col("event_type") == "error") & (F.col("value") >= EXTERNAL_FROM)),
            F.concat(F.when(F.col("value") >= EXTERNAL_FROM, "x").otherwise("m"), F.col("k").cast("string")),
        ).alias("media_id"),
        F.col("media_url"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), uid.cast("string")))
        .alias("visitor_key"),
        fn.iso_millis(F.col("ts")).alias("received_at"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).cast("double").alias("percent_viewed"),
        F.concat(F.lit("10.0."), F.expr("user_id div 256").cast("string"), F.lit("."), (uid % 256).cast("string")).alias("ip"),
        F.col("country"),
        F.col("region"),
        F.col("city"),
        F.struct(
            F.col("event_type").alias("browser"),
            F.col("event_type").alias("platform"),
            ((F.col("k") % 2) == 0).alias("mobile"),
        ).alias("user_agent_details"),
    )


def _events_path(run_date: str, run_id: str) -> F.Column:
    return F.concat(
        F.lit(f"raw/run_date={run_date}/run_id={run_id}/events/media_id="),
        F.coalesce("media_id", F.lit(NULL_PARTITION)),
        F.lit("/page_001.json"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed events of both runs, as the JSON reader returns them.

    One scan of ``events``: each record is exploded into the runs that landed
    it (one or two), instead of scanning the table once per run.
    """
    src = source_events(spark, sf_dir)
    landed = src.withColumn("__run", F.explode(_run_of(F.col("received_at"))))
    path = F.when(F.col("__run") == 1, _events_path(RUN1_DATE, RUN1_ID)).otherwise(_events_path(RUN2_DATE, RUN2_ID))
    return landed.withColumn("_source_file", path).drop("__run")


def _run_of(received: F.Column) -> F.Column:
    """The runs that landed an event: one, or both where it was delivered again."""
    ts = fn.parse_ts(received)
    return F.array_compact(
        F.array(
            F.when(ts < F.to_timestamp(F.lit(RUN1_BEFORE)), F.lit(1)),
            F.when(ts >= F.to_timestamp(F.lit(RUN2_FROM)), F.lit(2)),
        )
    )


def _run_path(run: F.Column, *rest: F.Column) -> F.Column:
    first = F.lit(f"raw/run_date={RUN1_DATE}/run_id={RUN1_ID}/")
    second = F.lit(f"raw/run_date={RUN2_DATE}/run_id={RUN2_ID}/")
    return F.concat(F.when(run == 1, first).otherwise(second), *rest)


def _as_json(df: DataFrame, columns: list[str], pretty: bool) -> F.Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "pretty": str(pretty).lower()})


def _texts(records: DataFrame, columns: list[str]) -> DataFrame:
    """``_source_file, text``: the records of a file as a pretty-printed page in run 1, as lines with a cut one in run 2.

    Files are keyed by a range of ids, so none gathers more than ``FILE_IDS`` records.
    """
    both = records.select("_source_file", "run", F.when(F.col("run") == 1, _as_json(records, columns, True)).otherwise(_as_json(records, columns, False)).alias("json"))
    files = both.groupBy("_source_file", "run").agg(F.collect_list("json").alias("all"))
    page = F.concat(F.lit("[\n"), F.array_join("all", ",\n"), F.lit("\n]\n"))
    lines = F.concat(F.array_join("all", "\n"), F.lit("\n" + CUT_RECORD + "\n"))
    return files.select("_source_file", F.when(F.col("run") == 1, page).otherwise(lines).alias("text"))


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed event files of both runs as texts: ``_source_file, text``."""
    src = source_events(spark, sf_dir)
    number = F.substring("event_key", 4, 20).cast("long")
    landed = src.withColumn("run", F.explode(_run_of(F.col("received_at"))))
    page = F.concat(F.lit("/page_"), F.floor(number / FILE_IDS).cast("string"), F.lit(".json"))
    return _texts(landed.withColumn("_source_file", _run_path(F.col("run"), F.lit("events/media_id="), F.coalesce("media_id", F.lit(NULL_PARTITION)), page)), src.columns)


def metadata_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed metadata snapshots, in files of a directory."""
    found = raw_metadata(spark, sf_dir)
    columns = [c for c in found.columns if c != "_source_file"]
    part = F.concat(F.col("_source_file"), F.lit("/part-"), F.floor(F.substring("hashed_id", 2, 20).cast("long") / FILE_IDS).cast("string"))
    run = F.when(F.col("_source_file").contains(RUN1_ID), F.lit(1)).otherwise(F.lit(2))
    return _texts(found.withColumn("run", run).withColumn("_source_file", part), columns)


def stats_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed statistics, one object a file; those that run 2 does not serve are cut off in it."""
    good = raw_stats(spark, sf_dir).select("_source_file", F.to_json(F.struct("play_rate"), {"pretty": "true"}).alias("text"))
    path = _run_path(F.lit(2), F.lit("media_stats/m"), F.col("p_partkey").cast("string"), F.lit(".json"))
    cut = _part(spark, sf_dir).where(F.col("p_size") < 10).select(path.alias("_source_file"), F.lit(CUT_STATS).alias("text"))
    return good.unionByName(cut)


def profile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source event as a JSON text; those without a media are cut off in it."""
    src = source_events(spark, sf_dir)
    text = _as_json(src, src.columns, False)
    return src.select(F.when(F.col("media_id").isNull(), F.substring(text, 1, 30)).otherwise(text).alias("json"))


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with a context three levels deep and a list of none to two steps, each with tags."""
    src = source_events(spark, sf_dir)
    place = F.struct("country", "city")
    page = F.struct(F.col("media_url").alias("url"), place.alias("place"))
    tags = F.when(F.col("visitor_key").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.col("region"), F.lit("seen")))
    mark = F.struct(F.col("percent_viewed").alias("share"), tags.alias("tags"))
    n = F.substring("event_key", 4, 20).cast("long") % 3
    step = F.struct(F.lit(True).alias("played"), mark.alias("mark"))
    full = src.select("*", F.struct(page.alias("page")).alias("context"), F.array_repeat(step, n.cast("int")).alias("steps"))
    cut = F.when(F.col("media_id").isNull(), F.lit(30)).otherwise(F.lit(10_000_000))
    return full.select(F.substr(_as_json(full, full.columns, False), F.lit(1), cut).alias("json"))


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media-metadata snapshots of both runs (+ source path)."""
    part = _part(spark, sf_dir)
    hashed = F.concat(F.lit("m"), F.col("p_partkey").cast("string"))
    r1 = part.select(
        hashed.alias("hashed_id"),
        F.col("p_name").alias("name"),
        F.lit(MEDIA_CREATED).alias("created"),
        F.lit(MEDIA_UPDATED_R1).alias("updated"),
        (F.col("p_size") * F.lit(60.0)).alias("duration"),
        F.lit("ready").alias("status"),
        F.lit(f"raw/run_date={RUN1_DATE}/run_id={RUN1_ID}/media_metadata.json").alias("_source_file"),
    )
    r2 = part.where(F.col("p_size") >= 25).select(
        hashed.alias("hashed_id"),
        F.concat(F.col("p_name"), F.lit(" v2")).alias("name"),
        F.lit(MEDIA_CREATED).alias("created"),
        F.when(F.col("p_type") == "PROMO", F.lit(MEDIA_UPDATED_R1)).otherwise(F.lit(MEDIA_UPDATED_R2)).alias("updated"),
        (F.col("p_size") * F.lit(60.0) + F.lit(1.0)).alias("duration"),
        F.lit("ready").alias("status"),
        F.lit(f"raw/run_date={RUN2_DATE}/run_id={RUN2_ID}/media_metadata.json").alias("_source_file"),
    )
    return r1.unionByName(r2)


def raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media-statistics objects of both runs; the media id is only in the path."""
    part = _part(spark, sf_dir)

    def path(run_date: str, run_id: str) -> F.Column:
        return F.concat(
            F.lit(f"raw/run_date={run_date}/run_id={run_id}/media_stats/m"),
            F.col("p_partkey").cast("string"),
            F.lit(".json"),
        )

    r1 = part.select((F.col("p_size") / F.lit(100.0)).alias("play_rate"), path(RUN1_DATE, RUN1_ID).alias("_source_file"))
    r2 = part.where(F.col("p_size") >= 10).select(
        (F.col("p_size") / F.lit(50.0)).alias("play_rate"), path(RUN2_DATE, RUN2_ID).alias("_source_file")
    )
    return r1.unionByName(r2)


def landing_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint before the landing run: a mark for every catalogued media and the null one."""
    mark = F.when(F.col("p_type") == "ECONOMY", BAD_MARK).when(F.col("p_type") == "PROMO", EARLY_MARK).otherwise(INCREMENTAL_MARK)
    marks = _part(spark, sf_dir).select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("media_id"),
        mark.alias("last_received_at"),
    )
    return marks.unionByName(spark.createDataFrame([(None, EARLY_MARK)], marks.schema))


def configured_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media the landing job is configured for: one per part, and events without a media."""
    media = _part(spark, sf_dir).select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("media_id"))
    return media.unionByName(spark.createDataFrame([(None,)], media.schema))
