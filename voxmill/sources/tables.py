"""Adapters from the analytics tables onto the segment, transcript, turn and embedding schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    clock = F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    return F.unix_date(F.to_date(ts)).cast("long") * 86_400_000 + clock + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as segments: a recording is an hour, a speaker an event type, the duration the value in seconds."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("segment_id"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("video_id"),
        F.col("event_type").alias("speaker"),
        epoch_ms(F.col("ts")).cast("long").alias("start_ms"),
        F.round(F.col("value") * 1000).cast("long").alias("duration_ms"),
        ((F.col("event_id") * 7919) % 3000 / 100.0).alias("snr_db"),
        (F.col("user_id") % 50 / 1000.0).alias("sfm"),
        (F.get_json_object("props", "$.k").cast("long") % 13).cast("double").alias("hnr_db"),
        F.col("user_id").alias("user_id"),
    ).withColumn("end_ms", F.col("start_ms") + F.col("duration_ms"))


SEGMENTS_SQL = """seg AS (SELECT event_id AS segment_id, strftime(ts, '%Y-%m-%d %H') AS video_id, event_type AS speaker, epoch_us(ts) // 1000 AS start_ms,
  CAST(round(value * 1000) AS BIGINT) AS duration_ms, ((event_id * 7919) % 3000) / 100.0::DOUBLE AS snr_db, (user_id % 50) / 1000.0::DOUBLE AS sfm,
  CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 13 AS DOUBLE) AS hnr_db, user_id, epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS end_ms FROM events)"""


def target_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segments whose speaker is TARGET where the event is a purchase or a click, else OTHER_00 to OTHER_02, UNKNOWN or UNCERTAIN by the user."""
    s = segments(spark, sf_dir)
    other = F.element_at(F.array(*map(F.lit, ("OTHER_00", "OTHER_01", "OTHER_02", "UNKNOWN", "UNCERTAIN"))), (F.col("user_id") % 5 + 1).cast("int"))
    return s.withColumns({"original_speaker": F.col("speaker"), "speaker": F.when(F.col("segment_id") % 2 == 0, "TARGET").otherwise(other)})


TARGETS_SQL = f"""{SEGMENTS_SQL}, tgt AS (SELECT * REPLACE (CASE WHEN segment_id % 2 = 0 THEN 'TARGET' ELSE ['OTHER_00', 'OTHER_01', 'OTHER_02', 'UNKNOWN', 'UNCERTAIN'][user_id % 5 + 1] END AS speaker),
  speaker AS original_speaker FROM seg)"""


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as transcripts: 60 ms a character; labels decide whether there is a result, and make up errors and confidences."""
    d, lab = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    joined = d.join(lab.select("doc_id", "quality", "toxic"), "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("segment_id"),
        F.col("source").alias("video_id"),
        "text", F.col("lang").alias("language"),
        (F.col("n_chars") * 60).alias("duration_ms"),
        (F.col("n_chars") * 0.06).alias("duration"),
        ((F.col("doc_id") % 17) != 3).alias("has_result"),
        F.when(F.col("toxic") == 1, "toxic").alias("error"),
        F.when(F.col("quality").isNotNull(), (F.col("doc_id") % 100) / 100.0).alias("confidence"),
    )


UTTERANCES_SQL = """utt AS (SELECT d.doc_id AS segment_id, source AS video_id, text, lang AS language, n_chars * 60 AS duration_ms, n_chars * 0.06::DOUBLE AS duration,
  (d.doc_id % 17) <> 3 AS has_result, CASE WHEN l.toxic = 1 THEN 'toxic' END AS error, CASE WHEN l.quality IS NOT NULL THEN (d.doc_id % 100) / 100.0::DOUBLE END AS confidence
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("nth"), F.col("role").alias("speaker"), "text")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))


#: Unit vectors as (vec_id, label, pos, x).
CELLS_SQL = """raw AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
  cells AS (SELECT vec_id, label, pos, v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)) AS x FROM raw)"""
