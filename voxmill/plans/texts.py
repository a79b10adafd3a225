"""Queries over transcripts and files, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.config import Asr, Evaluation
from voxmill.functions import text as fn
from voxmill.operators import dataset, report, transcripts
from voxmill.plans.segments import stats_sql
from voxmill.sources import files
from voxmill.sources import tables as t

#: No CJK text occurs in the test tables, so the wanted script is accented Latin there.
LATIN = Asr(script="\\u00C0-\\u024F")
UTT = t.UTTERANCES_SQL
_TRIM = "trim(coalesce(text, ''), ' ')"
_REASON = f"""CASE WHEN duration < 0.5 THEN 'too_short' WHEN NOT has_result THEN 'empty_result' WHEN error IS NOT NULL THEN 'transcribe_error' WHEN {_TRIM} = '' THEN 'empty_text' WHEN length({_TRIM}) < 2 THEN 'text_too_short'
  WHEN NOT regexp_matches({_TRIM}, '[À-ɏ]') THEN 'no_chinese' WHEN regexp_full_match({_TRIM}, '[^\\p{{L}}\\p{{M}}\\p{{Pc}}]*') THEN 'non_linguistic' WHEN confidence < 0.85 THEN 'low_confidence' ELSE 'ok' END"""
_VALID = f"v AS (SELECT *, {_REASON} AS reason FROM utt)"

utt = t.utterances


def _valid(s, d):
    return transcripts.validity(utt(s, d), LATIN)


def _with_asr(s, d):
    u = utt(s, d).withColumn("asr", F.struct("text", F.when(F.col("segment_id") % 4 != 0, F.col("duration")).otherwise(F.lit(0.0)).alias("duration")))
    return u.withColumn("duration_ms", F.col("duration_ms").cast("long"))


_RECORDS = f"""{UTT}, rec AS (SELECT segment_id, trim(text, ' ') AS text, 'wavs/' || segment_id || '.wav' AS audio,
  round(CASE WHEN segment_id % 4 <> 0 AND duration <> 0 THEN duration ELSE duration_ms / 1000.0::DOUBLE END, 2) AS duration, 0.0::DOUBLE AS similarity, video_id, 'ZH' AS language, 'target_blogger' AS speaker FROM utt WHERE {_TRIM} <> '')"""


def q_failed(s, d):
    v = _valid(s, d)
    seg = v.select("segment_id", "video_id", F.col("duration_ms").cast("long").alias("duration_ms"), F.lit("TARGET").alias("speaker"), *[F.lit(None).cast("double").alias(c) for c in ("snr_db", "sfm", "hnr_db")],
                   F.struct("valid", "reason", "text", "confidence", F.col("confidence").alias("confidence_min")).alias("asr"))
    return transcripts.failed_export(seg).select("segment_id", "duration", "reason", "text", "confidence")


def q_confidence(s, d):
    """Confidence of four invented tokens of three scores each."""
    scores = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: F.array(((F.col("doc_id") * k) % 7).cast("double"), ((F.col("doc_id") + k) % 5).cast("double"), F.lit(1.0)))
    mean, least = transcripts.confidence(scores)
    return t.read(s, d, "documents").select("doc_id", mean.alias("confidence"), least.alias("confidence_min"))


_SCORES = "list_transform(range(1, 5), lambda k: [((doc_id * k) % 7)::DOUBLE, ((doc_id + k) % 5)::DOUBLE, 1.0::DOUBLE])"
_TOPS = f"list_transform({_SCORES}, lambda v: 1.0 / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))))"


def q_functions(s, d):
    p = t.read(s, d, "pages").select("page_id", "url")
    return p.select(
        "page_id", fn.safe_filename(F.col("url")).alias("safe"), fn.basename(F.col("url")).alias("base"), fn.model_name(F.concat("url", F.lit(".ckpt"))).alias("model"), fn.encode_key(F.col("url"), F.lit("x")).alias("key"),
        fn.fill_prompt(Evaluation().prompt, F.col("url")).alias("prompt"), fn.preview(F.col("url"), 20).alias("preview"), fn.contains_script(F.col("url"), "0-9").alias("digits"),
    )


def q_stem_kind(s, d):
    p = t.read(s, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit("song_(Vocals).wav")).when(F.col("p_partkey") % 3 == 1, F.lit("song_(Instrumental).wav")).otherwise(F.col("p_name")).alias("name"))
    return p.select("p_partkey", fn.stem_kind(F.col("name")).alias("kind"))


def q_skip_existing(s, d):
    return files.not_yet(t.read(s, d, "documents").select("doc_id", "source"), t.read(s, d, "labels"), "doc_id")


def q_land(s, d):
    return files.not_yet(t.read(s, d, "documents").select("doc_id", "source"), t.read(s, d, "labels"), "doc_id", 25)


def q_semi(s, d):
    docs, labels = t.read(s, d, "documents").select("doc_id", "source"), t.read(s, d, "labels")
    return docs.join(labels.select("doc_id"), "doc_id", "left_semi")


def q_align(s, d):
    a = t.read(s, d, "documents").where("doc_id % 3 <> 0").select("doc_id", F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("path"))
    b = t.read(s, d, "labels").select("doc_id", F.concat(F.lit("b/"), F.col("doc_id").cast("string")).alias("path"))
    return files.align_stems(a, b, "doc_id")


def q_stems(s, d):
    stems = t.read(s, d, "lineitem").select(F.col("l_orderkey").alias("video_id"), F.when(F.col("l_linenumber") % 2 == 0, "vocals").otherwise("no_vocals").alias("kind"))
    return files.with_both_stems(stems)


def q_missing(s, d):
    records = dataset.project(_with_asr(s, d))
    there = t.read(s, d, "labels").select(F.concat(F.lit("/data/wavs/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"))
    return dataset.with_audio(records, there).select("segment_id", "audio")


QUERIES = {
    "transcript_cascade": lambda s, d: _valid(s, d).select("segment_id", "reason", "valid"),
    "transcript_reason_counts": lambda s, d: transcripts.reason_counts(_valid(s, d)),
    "failed_export": q_failed,
    "token_confidence": q_confidence,
    "text_length_stats": lambda s, d: report.text_stats(utt(s, d)),
    "video_means": lambda s, d: report.totals(utt(s, d).withColumn("duration_ms", F.col("duration_ms").cast("long")), "video_id"),
    "longest_texts": lambda s, d: report.longest(utt(s, d)).select("segment_id", "duration_ms", fn.preview(F.col("text"), 60).alias("preview")),
    "dataset_projection": lambda s, d: dataset.project(_with_asr(s, d)),
    "dataset_total": lambda s, d: dataset.total(dataset.project(_with_asr(s, d))),
    "dataset_files": q_missing,
    "scalar_functions": q_functions,
    "stem_classification": q_stem_kind,
    "stem_pairs": q_stems,
    "skip_existing": q_skip_existing,
    "incremental_landing": q_land,
    "artefact_semi": q_semi,
    "stem_alignment": q_align,
    "turn_totals": lambda s, d: t.turns(s, d).groupBy("speaker").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")),
}

ORACLE = {
    "transcript_cascade": f"WITH {UTT}, {_VALID} SELECT segment_id, reason, reason = 'ok' AS valid FROM v",
    "transcript_reason_counts": f"WITH {UTT}, {_VALID} SELECT reason, count(*) AS n FROM v GROUP BY reason",
    "failed_export": f"WITH {UTT}, {_VALID} SELECT segment_id, duration_ms / 1000.0::DOUBLE AS duration, reason, text, confidence FROM v WHERE reason <> 'ok'",
    "token_confidence": f"SELECT doc_id, round(list_avg({_TOPS}), 4) AS confidence, round(list_min({_TOPS}), 4) AS confidence_min FROM documents",
    "text_length_stats": f"WITH {UTT} SELECT count(*) AS n, {stats_sql('length(text)', 1)} FROM utt",
    "video_means": f"WITH {UTT} SELECT video_id, count(*) AS n, sum(duration_ms)::BIGINT AS total_ms, round(sum(duration_ms)::BIGINT / 60000.0::DOUBLE, 2) AS minutes, round(sum(duration_ms)::BIGINT / count(*)::DOUBLE / 1000, 6) AS mean_seconds FROM utt GROUP BY video_id",
    "longest_texts": f"WITH {UTT} SELECT segment_id, duration_ms, substring(text, 1, 60) AS preview FROM utt ORDER BY duration_ms DESC, segment_id LIMIT 10",
    "dataset_projection": f"WITH {_RECORDS} SELECT * FROM rec",
    "dataset_total": f"WITH {_RECORDS}, s AS (SELECT count(*) AS n, coalesce(sum(duration::DECIMAL(18, 2)), 0)::DOUBLE AS total_seconds FROM rec) SELECT n, total_seconds, round(total_seconds / 60, 2) AS total_minutes, total_seconds < 1800 AS below_minimum FROM s",
    "dataset_files": f"WITH {_RECORDS} SELECT segment_id, audio FROM rec WHERE segment_id IN (SELECT doc_id FROM labels)",
    "scalar_functions": f"""SELECT page_id, trim(regexp_replace(url, '[^\\p{{L}}\\p{{N}}._\\- ]', '', 'g'), ' ') AS safe, string_split(url, '/')[-1] AS base, string_split(url, '/')[-1] AS model, url || '|||x' AS key,
      replace('{Evaluation().prompt}', '{{text}}', url) AS prompt, substring(url, 1, 20) AS preview, regexp_matches(url, '[0-9]') AS digits FROM pages""",
    "stem_classification": """WITH n AS (SELECT p_partkey, lower(CASE p_partkey % 3 WHEN 0 THEN 'song_(Vocals).wav' WHEN 1 THEN 'song_(Instrumental).wav' ELSE p_name END) AS x FROM part)
      SELECT p_partkey, CASE WHEN x LIKE '%instrumental%' OR x LIKE '%no\\_vocals%' ESCAPE '\\' OR x LIKE '%other%' OR x LIKE '%accompaniment%' THEN 'no_vocals' WHEN x LIKE '%vocal%' THEN 'vocals' END AS kind FROM n""",
    "stem_pairs": "SELECT l_orderkey AS video_id FROM lineitem GROUP BY l_orderkey HAVING count_if(l_linenumber % 2 = 0) > 0 AND count_if(l_linenumber % 2 <> 0) > 0",
    "skip_existing": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "incremental_landing": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 25",
    "artefact_semi": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "stem_alignment": """WITH a AS (SELECT doc_id, 'a/' || doc_id AS path_a FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, 'b/' || doc_id AS path_b FROM labels)
      SELECT doc_id, path_a, path_b, CASE WHEN path_a IS NOT NULL AND path_b IS NOT NULL THEN 'ensemble' WHEN path_a IS NOT NULL THEN 'demucs_only' WHEN path_b IS NOT NULL THEN 'mdx_only' ELSE 'failed' END AS kind FROM a FULL JOIN b USING (doc_id)""",
    "turn_totals": "SELECT role AS speaker, count(*) AS n, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY role",
}
