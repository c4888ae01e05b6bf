"""Topic sources and sinks, JSON parsing, log stamping and routing.

A topic is read as a streaming DataFrame of ``(key, value)`` strings and the
record's position in its source.  With Kafka brokers that is the Kafka source;
without them (tests, replays) the same topic lives in a folder of text files,
one numbered JSON value per line, written by ``write_topic``.

``POSITION`` is a struct (time, part, offset) that orders a topic's records:
the record's timestamp, partition and offset, or for files the file's time, a
hash of its name and the line's number.  Records of one key keep their order if producers
put them into one partition (of a topic with append timestamps) or one file.
It travels with the parsed rows, so that a table can tell which of two writes
of one key came later (``tables``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic names.
TOPIC_STARTUP = "SHOP_STARTUP"
TOPIC_EVENT = "SHOP_EVENT"
TOPIC_ORDER = "SHOP_ORDER"
TOPIC_ORDER_DETAIL = "SHOP_ORDER_DETAIL"
TOPIC_USER = "SHOP_USER"
TOPIC_LOG = "SHOP_LOG"          # raw client logs, before stamping
TOPIC_CHANGES = "SHOP_CHANGES"  # the captured change log
STARTUP_TYPE = "startup"

POSITION = "_pos"
REASON = "_reason"
MALFORMED = "malformed"


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/topic={topic}"


def _position(time: Column, part: Column, offset: Column) -> Column:
    return F.struct(time.cast("long").alias("time"), part.cast("long").alias("part"),
                    offset.cast("long").alias("offset")).alias(POSITION)


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """(key, value, position) of text lines: ``number TAB value``, or a bare value."""
    number = F.regexp_extract("value", r"\A(\d{1,18})\t", 1)
    value = F.when(number != "", F.expr("substring(value, length(_number) + 2)")).otherwise(F.col("value"))
    rows = lines.withColumn("_number", number)
    return rows.select(F.lit(None).cast("string").alias("key"), value.alias("value"), _position(
        F.unix_millis("_metadata.file_modification_time"), F.xxhash64("_metadata.file_name"),
        F.when(F.col("_number") != "", F.col("_number"))))


def _make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read_topic(spark: SparkSession, topic: str, bootstrap_servers: str | None = None,
               root: str | None = None, starting_offsets: str = "latest",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(key, value, position)`` of one topic.

    Kafka: subscribe to ``topic``, start at ``latest`` when the query has no
    checkpoint yet (the query's checkpoint then owns the offsets, so every
    query reads the whole topic independently).  File twin: text files
    anywhere under ``root/topic=<topic>``, whoever wrote them.
    """
    if bootstrap_servers:
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", bootstrap_servers)
               .option("subscribe", topic)
               .option("startingOffsets", starting_offsets)
               .load())
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"),
                          _position(F.unix_millis("timestamp"), F.col("partition"), F.col("offset")))
    if root is None:
        raise ValueError("either bootstrap_servers or root is required")
    path = topic_path(root, topic)
    _make_folder(spark, path)   # a topic that nobody has written to yet
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _numbered_lines(reader.load(path))


def read_topic_batch(spark: SparkSession, topic: str, root: str) -> DataFrame:
    """The whole file twin of a topic as a batch DataFrame."""
    return _numbered_lines(spark.read.option("recursiveFileLookup", "true").text(topic_path(root, topic)))


def _checked(df: DataFrame, schema: T.StructType, required: str | None) -> DataFrame:
    """The rows of ``df`` with the parsed struct ``_r`` and the ``REASON`` why a
    value is refused (null: it is not).

    Numbers are read as text and cast, so that a number in quotes, as the
    change log's after-images hold them, is a number too.
    """
    broken = "_broken"
    plain = [f for f in schema.fields if not isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType))]
    read = T.StructType([T.StructField(f.name, T.StringType() if f in plain else f.dataType, True)
                         for f in schema.fields] + [T.StructField(broken, T.StringType(), True)])
    rows = df.withColumn("_t", F.from_json(F.col("value"), read, {"columnNameOfCorruptRecord": broken}))
    fields = [F.col(f"_t.{f.name}").try_cast(f.dataType).alias(f.name) if f in plain
              else F.col(f"_t.{f.name}").alias(f.name) for f in schema.fields]
    rows = rows.withColumn("_r", F.struct(*fields))
    wrong = F.col("_t").isNull() | F.col(f"_t.{broken}").isNotNull()
    wrong = wrong | F.col("value").isNull() | (F.trim("value") == "")   # an empty line is no record
    for f in plain:
        wrong = wrong | (F.col(f"_t.{f.name}").isNotNull() & F.col(f"_r.{f.name}").isNull())
    reason = F.when(wrong, F.lit(MALFORMED))
    if required is not None:
        reason = reason.when(F.col(f"_r.{required}").isNull(), F.lit(f"no {required}"))
    return rows.withColumn(REASON, reason)


def parse_records(df: DataFrame, schema: T.StructType, required: str | None = None) -> DataFrame:
    """JSON ``value`` -> typed columns of ``schema``, and the position if there is one.

    Fields bind by name; JSON numbers read into string fields keep their text.
    Values that are no JSON object, hold a value that its field cannot take, or
    lack the ``required`` field are not here but in ``rejected_records``: every
    value is in exactly one of the two.  Without ``required`` nothing is left
    out, and what cannot be parsed gives nulls.
    """
    rows = _checked(df, schema, required)
    if required is not None:
        rows = rows.filter(F.col(REASON).isNull())
    position = [POSITION] if POSITION in df.columns else []
    return rows.select(*(F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields), *position)


def checked_records(df: DataFrame, schema: T.StructType, required: str) -> DataFrame:
    """(value, reason) of every value, and the position if there is one: null, or
    why ``parse_records`` leaves the value out."""
    position = [POSITION] if POSITION in df.columns else []
    return _checked(df, schema, required).select("value", F.col(REASON).alias("reason"), *position)


def rejected_records(df: DataFrame, schema: T.StructType, required: str) -> DataFrame:
    """The rows of ``checked_records`` that have a reason."""
    return checked_records(df, schema, required).filter(F.col("reason").isNotNull())


def keep_rejected(rejected: DataFrame, root: str, topic: str, producer: str, batch_id: int) -> None:
    """Add (value, reason) rows of a topic to the reject table, a parquet table
    by topic.  A batch that is written again replaces its files."""
    out = rejected.select("value", "reason", F.lit(topic).alias("topic"), F.lit(producer).alias("q"),
                          F.lit(batch_id).cast("long").alias("b"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("topic", "q", "b").parquet(root))


def stamp_ingest_ts(df: DataFrame, as_of_ms: int | None = None) -> DataFrame:
    """Set ``ts`` to the ingest time in epoch ms, overwriting any client value."""
    return df.withColumn("ts", _now(as_of_ms))


def _now(as_of_ms: int | None) -> Column:
    return F.lit(as_of_ms).cast("long") if as_of_ms is not None else F.unix_millis(F.current_timestamp())


def stamp_json(value: Column, as_of_ms: int | None = None) -> Column:
    """A JSON object's text with ``ts`` set to the ingest time and every other
    field, known or not and of whatever type, as it is; null for anything but
    an object."""
    fields = F.from_json(value, "map<string, variant>")
    others = F.map_filter(fields, lambda k, v: k != "ts")
    now = F.to_variant_object(F.array(_now(as_of_ms)))
    stamped = F.map_concat(others, F.create_map(F.lit("ts"), F.variant_get(now, "$[0]", "variant")))
    return F.to_json(stamped)


def log_topic(log_type: Column) -> Column:
    """'startup' logs go to the startup topic, everything else (null too) to events."""
    return F.when(log_type.eqNullSafe(F.lit(STARTUP_TYPE)), F.lit(TOPIC_STARTUP)) \
        .otherwise(F.lit(TOPIC_EVENT))


def route_logs(logs: DataFrame, type_col: str = "type") -> DataFrame:
    """Add the destination ``topic`` of each client log line."""
    return logs.withColumn("topic", log_topic(F.col(type_col)))


def to_topic_records(df: DataFrame, topic: str | Column, exclude: tuple[str, ...] = (),
                     keep: dict[str, str] | None = None) -> DataFrame:
    """``(topic, value)`` with the row as a JSON object (value only, no key), and
    the columns that ``keep`` names (new name -> column) beside it."""
    cols = [c for c in df.columns if c not in exclude and c != POSITION]
    topic_col = F.lit(topic) if isinstance(topic, str) else topic
    beside = [F.col(c).alias(name) for name, c in (keep or {}).items()]
    return df.select(topic_col.alias("topic"), F.to_json(F.struct(*cols)).alias("value"), *beside)


def write_topic(records: DataFrame, bootstrap_servers: str | None = None, root: str | None = None,
                producer: str | None = None, batch_id: int = 0) -> None:
    """Publish a batch of ``(topic, value)`` records.

    Kafka when brokers are given.  Otherwise text files under
    ``root/topic=<topic>/q=<producer>/b=<batch>``, one numbered JSON value per
    line, compressed: producers have folders of their own, so any number of them share a
    root, and a batch that is written again replaces its own files.  Without a
    ``producer`` every call is one of its own.
    """
    if bootstrap_servers:
        (records.select("topic", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).save())
        return
    line = F.concat(F.monotonically_increasing_id().cast("string"), F.lit("\t"), "value")
    (records.filter("value is not null")
     .select("topic", F.lit(producer or uuid.uuid4().hex).alias("q"), F.lit(batch_id).alias("b"), line.alias("value"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
     .partitionBy("topic", "q", "b").text(root))


def persist_raw_log(logs: DataFrame, path: str, producer: str | None = None, batch_id: int = 0) -> None:
    """Keep the very lines that a collector publishes: ``(value, ts)``, as text
    files by day of ``ts``.  A batch that is written again replaces its files."""
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd").alias("log_date")
    (logs.select(day, F.lit(producer or uuid.uuid4().hex).alias("q"), F.lit(batch_id).alias("b"), "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "q", "b").text(path))


def write_topic_stream(records: DataFrame, checkpoint: str, bootstrap_servers: str | None = None,
                       root: str | None = None, trigger: dict | None = None):
    """Streaming twin of ``write_topic``, a producer of its own; returns the started query."""
    from martlane.streaming.runners import start_batches

    def publish(batch: DataFrame, query_id: str, batch_id: int) -> None:
        write_topic(batch, bootstrap_servers, root, query_id, batch_id)

    return start_batches(records.select("topic", "value"), publish, checkpoint, trigger)
