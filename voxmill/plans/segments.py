"""Queries over segments, with their DuckDB SQL."""

from __future__ import annotations


from pyspark.sql import functions as F

from voxmill.config import QualityGate
from voxmill.operators import embeddings, intervals, quality, report
from voxmill.sources import files
from voxmill.sources import tables as t

SEG, TGT = t.SEGMENTS_SQL, t.TARGETS_SQL
GATE = QualityGate()

_STATS = """round(coalesce(avg({x}), 0) / {s}, 6) AS mean, round(coalesce(stddev_pop({x} / {s}), 0), 6) AS std, round(coalesce(min({x}) / {s}, 0), 6) AS min, round(coalesce(max({x}) / {s}, 0), 6) AS max,
  round(coalesce(quantile_cont({x}::DOUBLE, 0.5) / {s}, 0), 6) AS median, round(coalesce(quantile_cont({x}::DOUBLE, 0.25) / {s}, 0), 6) AS p25,
  round(coalesce(quantile_cont({x}::DOUBLE, 0.75) / {s}, 0), 6) AS p75, round(coalesce(quantile_cont({x}::DOUBLE, 0.9) / {s}, 0), 6) AS p90"""


def stats_sql(x: str, scale: float) -> str:
    return _STATS.format(x=x, s=f"{scale:.1f}::DOUBLE")


_DURATIONS = f"count(*) AS n, coalesce(sum(duration_ms), 0)::BIGINT / 1000.0::DOUBLE AS total_seconds, round(coalesce(sum(duration_ms), 0)::BIGINT / 60000.0::DOUBLE, 6) AS total_minutes, {stats_sql('duration_ms', 1000)}"
_TOTALS = "count(*) AS n, sum(duration_ms)::BIGINT AS total_ms, round(sum(duration_ms)::BIGINT / 60000.0::DOUBLE, 2) AS minutes, round(sum(duration_ms)::BIGINT / count(*)::DOUBLE / 1000, 6) AS mean_seconds"
_PAIRS = """pairs AS (SELECT a.video_id, a.segment_id AS a_id, b.segment_id AS b_id, a.speaker AS a_speaker, b.speaker AS b_speaker, a.start_ms AS a_start_ms, a.end_ms AS a_end_ms, b.start_ms AS b_start_ms, b.end_ms AS b_end_ms,
  least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms) AS overlap_ms
  FROM seg a JOIN seg b ON a.video_id = b.video_id AND a.segment_id < b.segment_id AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms WHERE least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms) > 50)"""
_FLAGS = f"{_PAIRS}, flagged AS (SELECT a_id AS id FROM pairs UNION SELECT b_id FROM pairs), seg2 AS (SELECT s.*, f.id IS NOT NULL AS is_overlap FROM seg s LEFT JOIN flagged f ON s.segment_id = f.id)"
_REASON = f"""CASE WHEN (snr_db < {GATE.snr_db})::INT + (sfm > {GATE.sfm})::INT + (hnr_db < {GATE.hnr_db})::INT >= 2 THEN 'multi' WHEN snr_db < {GATE.snr_db} THEN 'snr' WHEN sfm > {GATE.sfm} THEN 'sfm' WHEN hnr_db < {GATE.hnr_db} THEN 'hnr' ELSE 'keep' END"""
_GATED = f"gated AS (SELECT *, {_REASON} AS filter_reason FROM tgt WHERE speaker = 'TARGET')"

seg, tgt = t.segments, t.target_segments


def _flags(s, d):
    return intervals.overlap_flags(seg(s, d))


def _gated(s, d):
    return quality.quality_gate(tgt(s, d).where("speaker = 'TARGET'"), GATE)


def q_overlap_flags(s, d):
    return _flags(s, d).select("segment_id", "video_id", "is_overlap")


def q_overlap_pairs(s, d):
    return intervals.overlap_pairs(seg(s, d)).select("video_id", "a_id", "b_id", "a_speaker", "b_speaker", "overlap_ms")


def q_overlap_partners(s, d):
    return intervals.overlap_partners(seg(s, d)).select("segment_id", F.concat_ws(",", "overlap_speakers").alias("partners"))


def q_merge_gaps(s, d):
    return intervals.merge_gaps(seg(s, d), 300)


def q_split_long(s, d):
    return intervals.split_long(seg(s, d)).select("segment_id", "child", "original_speaker", "start_ms", "end_ms", "duration_ms")


def q_assign_ids(s, d):
    return intervals.assign_ids(seg(s, d)).select("segment_id", "new_id")


def q_pause_split(s, d):
    """Long segments of odd ids cut at pauses: 4.2 s of speech in every 5 s of a segment."""
    long = seg(s, d)
    speech = long.where("segment_id % 2 = 1").select("segment_id", F.expr("transform(sequence(0L, greatest(0L, duration_ms - 1) div 5000), k -> struct(k * 5000 AS start, least(k * 5000 + 4200, duration_ms) AS end))").alias("intervals"))
    return intervals.pack_speech(long, speech).select("segment_id", "start_ms", "end_ms", "duration_ms")


def q_turns(s, d):
    """Annotations rebuilt from segments, and read again as rows."""
    a = seg(s, d).groupBy("video_id", F.pmod("segment_id", F.lit(16)).alias("deal")).agg(F.collect_list(F.struct("speaker", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"))).alias("turns"))
    return intervals.turns(a, 500)


def q_min_duration(s, d):
    return seg(s, d).where(F.col("duration_ms") >= 500).select("segment_id", "duration_ms")


def q_target_nonoverlap(s, d):
    from voxmill.operators.transcripts import target_without_overlap

    marked = intervals.overlap_flags(tgt(s, d))
    return target_without_overlap(marked).select("segment_id", "video_id", "duration_ms")


def q_gate(s, d):
    return _gated(s, d).select("segment_id", "filter_reason", "snr_db", "sfm", "hnr_db")


def q_split_kept(s, d):
    kept, rejected = quality.split_kept(tgt(s, d), _gated(s, d))
    return kept.select("segment_id", F.lit("kept").alias("side")).unionAll(rejected.select("segment_id", F.lit("rejected")))


def q_speech_ratio(s, d):
    df = seg(s, d).select("segment_id", (F.col("user_id") % 100).alias("speech_samples"), F.lit(100).alias("total_samples"))
    return quality.speech_gate(df).select("segment_id", "speech_ratio", (F.col("filter_decision").isNotNull()).alias("discarded"))


def q_decisions(s, d):
    return report.decisions(_gated(s, d).withColumn("filter_decision", F.when(F.col("filter_reason") != "keep", F.col("filter_reason"))))


def q_demote(s, d):
    return embeddings.demote_short(tgt(s, d)).select("segment_id", "speaker")


def _label_map(s, d):
    pairs = seg(s, d).select("video_id", F.col("speaker")).distinct()
    return pairs.where("speaker <> 'view'").withColumn("global_label", F.when(F.col("speaker") == "click", "TARGET").otherwise(F.concat(F.lit("OTHER_"), F.substring("speaker", 1, 2))))


_MAP = "map AS (SELECT DISTINCT video_id, speaker, CASE WHEN speaker = 'click' THEN 'TARGET' ELSE 'OTHER_' || substring(speaker, 1, 2) END AS global_label FROM seg WHERE speaker <> 'view')"


def q_label_map(s, d):
    one = seg(s, d).withColumn("original_speaker", F.when(F.col("segment_id") % 3 != 0, F.col("speaker")))
    return embeddings.apply_labels(one, _label_map(s, d)).select("segment_id", "speaker")


def q_label_durations(s, d):
    return embeddings.label_durations(_label_map(s, d), seg(s, d))


def q_rerank(s, d):
    return embeddings.rerank_by_duration(embeddings.label_durations(_label_map(s, d), seg(s, d))).groupBy("global_label", "new_label").agg(F.sum("total_ms").alias("total_ms"))


def q_funnel(s, d):
    before = tgt(s, d)
    after = _gated(s, d).where("filter_reason = 'keep'")
    return report.funnel(before, after)


def q_first_source(s, d):
    base = seg(s, d).select("segment_id", "speaker")
    return files.first_source([base.where("speaker = 'no such speaker'"), base.where("speaker = 'purchase'"), base])


def q_longest(s, d):
    return report.longest(seg(s, d)).select("segment_id", "duration_ms")


def q_shortest(s, d):
    return report.shortest(seg(s, d)).select("segment_id", "duration_ms")


def q_tally(s, d):
    return report.tally(seg(s, d).select(F.when(F.col("segment_id") % 7 == 0, "failed").when(F.col("segment_id") % 5 == 0, "skipped").otherwise("success").alias("status")))


def q_checkpoint_keys(s, d):
    from voxmill.functions.text import encode_key

    rows = seg(s, d).select(F.when(F.col("segment_id") % 10 == 0, F.col("video_id")).otherwise(encode_key(F.col("video_id"), F.col("speaker"))).alias("key"), F.col("duration_ms").alias("value"))
    return files.checkpoint_durations(rows).groupBy("video_id", "speaker").agg(F.sum("value").alias("value"))


_PACK = """RECURSIVE {seg}, sp AS (SELECT segment_id, start_ms, duration_ms, k, k * 5000 AS a, least(k * 5000 + 4200, duration_ms) AS b FROM seg, range(0, greatest(0, duration_ms - 1) // 5000 + 1) r(k)
    WHERE segment_id % 2 = 1 AND duration_ms > 10000),
  walk AS (SELECT segment_id, start_ms, k, a AS s, b AS e, 0 AS block FROM sp WHERE k = 0
    UNION ALL SELECT w.segment_id, w.start_ms, n.k, CASE WHEN n.b - w.s <= 10000 THEN w.s ELSE n.a END, n.b, CASE WHEN n.b - w.s <= 10000 THEN w.block ELSE w.block + 1 END
    FROM walk w JOIN sp n ON n.segment_id = w.segment_id AND n.k = w.k + 1),
  blocks AS (SELECT segment_id, start_ms + min(s) AS start_ms, start_ms + max(e) AS end_ms FROM walk GROUP BY segment_id, start_ms, block),
  children AS (SELECT segment_id, start_ms, end_ms, end_ms - start_ms AS duration_ms FROM blocks WHERE end_ms - start_ms >= 300)
SELECT * FROM children UNION ALL SELECT segment_id, start_ms, end_ms, duration_ms FROM seg WHERE duration_ms <= 10000 OR segment_id NOT IN (SELECT segment_id FROM children)"""

_BUCKET = "CASE WHEN duration_ms < 500 THEN 0 WHEN duration_ms < 1000 THEN 1 WHEN duration_ms < 2000 THEN 2 WHEN duration_ms < 3000 THEN 3 WHEN duration_ms < 5000 THEN 4 WHEN duration_ms < 10000 THEN 5 WHEN duration_ms < 15000 THEN 6 WHEN duration_ms < 30000 THEN 7 ELSE 8 END"
_NAMES = ", ".join(f"({i}, '{name}')" for i, (_, name) in enumerate(report.BUCKETS))

QUERIES = {
    "speaker_duration_report": lambda s, d: report.duration_stats(seg(s, d), "speaker"),
    "duration_stats": lambda s, d: report.duration_stats(seg(s, d)),
    "duration_histogram": lambda s, d: report.histogram(seg(s, d)),
    "speaker_totals": lambda s, d: report.totals(seg(s, d), "speaker"),
    "video_totals": lambda s, d: report.totals(seg(s, d), "video_id").orderBy(F.desc("total_ms"), "video_id"),
    "overlap_pairs": q_overlap_pairs,
    "overlap_flags": q_overlap_flags,
    "overlap_partners": q_overlap_partners,
    "overlap_summary": lambda s, d: report.overlap_summary(_flags(s, d), "video_id", "speaker"),
    "overlap_totals": lambda s, d: report.overlap_summary(_flags(s, d)),
    "merge_gaps": q_merge_gaps,
    "split_long_equal": q_split_long,
    "pause_aware_split": q_pause_split,
    "assign_segment_ids": q_assign_ids,
    "annotation_turns": q_turns,
    "min_duration_filter": q_min_duration,
    "target_nonoverlap": q_target_nonoverlap,
    "quality_gate": q_gate,
    "quality_reason_counts": lambda s, d: quality.gate_counts(_gated(s, d)),
    "quality_metric_summary": lambda s, d: quality.metric_summary(_gated(s, d)),
    "kept_and_rejected": q_split_kept,
    "speech_ratio_gate": q_speech_ratio,
    "filter_decision_counts": q_decisions,
    "precision_demotion": q_demote,
    "label_map_apply": q_label_map,
    "label_durations": q_label_durations,
    "duration_rerank": q_rerank,
    "label_distribution": lambda s, d: report.label_distribution(tgt(s, d)),
    "overall_totals": lambda s, d: report.overall(seg(s, d)),
    "retention_funnel": q_funnel,
    "source_priority": q_first_source,
    "longest_10": q_longest,
    "shortest_10": q_shortest,
    "stage_tally": q_tally,
    "checkpoint_keys": q_checkpoint_keys,
}

ORACLE = {
    "speaker_duration_report": f"WITH {SEG} SELECT speaker, {_DURATIONS} FROM seg GROUP BY speaker",
    "duration_stats": f"WITH {SEG} SELECT {_DURATIONS} FROM seg",
    "duration_histogram": f"WITH {SEG}, b(ordinal, bucket) AS (VALUES {_NAMES}) SELECT b.ordinal::BIGINT AS ordinal, b.bucket, count(s.segment_id) AS n FROM b LEFT JOIN (SELECT segment_id, {_BUCKET} AS o FROM seg) s ON s.o = b.ordinal GROUP BY ALL",
    "speaker_totals": f"WITH {SEG} SELECT speaker, {_TOTALS} FROM seg GROUP BY speaker",
    "video_totals": f"WITH {SEG} SELECT video_id, {_TOTALS} FROM seg GROUP BY video_id",
    "overlap_pairs": f"WITH {SEG}, {_PAIRS} SELECT video_id, a_id, b_id, a_speaker, b_speaker, overlap_ms FROM pairs",
    "overlap_flags": f"WITH {SEG}, {_FLAGS} SELECT segment_id, video_id, is_overlap FROM seg2",
    "overlap_partners": f"""WITH {SEG}, {_PAIRS}, u AS (SELECT a_id AS id, b_speaker AS sp, b_start_ms AS s, b_end_ms AS e, b_id AS o FROM pairs UNION ALL SELECT b_id, a_speaker, a_start_ms, a_end_ms, a_id FROM pairs),
      f AS (SELECT id, sp, s, e, o FROM u QUALIFY row_number() OVER (PARTITION BY id, sp ORDER BY s, e, o) = 1) SELECT id AS segment_id, string_agg(sp, ',' ORDER BY s, e, o) AS partners FROM f GROUP BY id""",
    "overlap_summary": f"WITH {SEG}, {_FLAGS} SELECT video_id, speaker, count(*) AS n, count_if(is_overlap)::BIGINT AS n_overlap, sum(duration_ms)::BIGINT AS total_ms, coalesce(sum(CASE WHEN is_overlap THEN duration_ms END), 0)::BIGINT AS overlap_ms, round(count_if(is_overlap) * 100 / count(*)::DOUBLE, 2) AS overlap_pct FROM seg2 GROUP BY ALL",
    "overlap_totals": f"WITH {SEG}, {_FLAGS} SELECT count(*) AS n, count_if(is_overlap)::BIGINT AS n_overlap, sum(duration_ms)::BIGINT AS total_ms, coalesce(sum(CASE WHEN is_overlap THEN duration_ms END), 0)::BIGINT AS overlap_ms, round(count_if(is_overlap) * 100 / count(*)::DOUBLE, 2) AS overlap_pct FROM seg2",
    "merge_gaps": f"""WITH {SEG}, m AS (SELECT *, CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY video_id, speaker ORDER BY start_ms, end_ms, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 300 THEN 0 ELSE 1 END AS fresh FROM seg),
      i AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id, speaker ORDER BY start_ms, end_ms, segment_id) AS island FROM m) SELECT video_id, speaker, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_segments FROM i GROUP BY video_id, speaker, island""",
    "split_long_equal": f"""WITH {SEG}, n AS (SELECT *, CASE WHEN duration_ms > 10000 THEN (duration_ms + 9999) // 10000 ELSE 1 END AS k FROM seg), c AS (SELECT n.*, i AS child, start_ms + (2 * i * duration_ms + k) // (2 * k) AS a, start_ms + (2 * (i + 1) * duration_ms + k) // (2 * k) AS b FROM n, range(0, k) r(i))
      SELECT segment_id, child, speaker AS original_speaker, a AS start_ms, b AS end_ms, b - a AS duration_ms FROM c WHERE k = 1 OR b - a >= 300""",
    "pause_aware_split": "WITH " + _PACK.format(seg=SEG),
    "assign_segment_ids": f"WITH {SEG} SELECT segment_id, printf('%s_%s_%04d', video_id, speaker, row_number() OVER (PARTITION BY video_id ORDER BY start_ms, end_ms, segment_id) - 1) AS new_id FROM seg",
    "annotation_turns": f"WITH {SEG} SELECT video_id, speaker, start_ms, end_ms, duration_ms FROM seg WHERE duration_ms >= 500",
    "min_duration_filter": f"WITH {SEG} SELECT segment_id, duration_ms FROM seg WHERE duration_ms >= 500",
    "target_nonoverlap": f"WITH {TGT}, {_FLAGS} SELECT t.segment_id, t.video_id, t.duration_ms FROM tgt t JOIN seg2 s USING (segment_id) WHERE t.speaker = 'TARGET' AND NOT s.is_overlap",
    "quality_gate": f"WITH {TGT}, {_GATED} SELECT segment_id, filter_reason, snr_db, sfm, hnr_db FROM gated",
    "quality_reason_counts": f"WITH {TGT}, {_GATED} SELECT filter_reason, count(*) AS n FROM gated GROUP BY ALL",
    "quality_metric_summary": f"WITH {TGT}, {_GATED} SELECT count_if(filter_reason = 'keep')::BIGINT AS kept, count_if(filter_reason <> 'keep')::BIGINT AS discarded, "
    + ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(median({m}), 6) AS {m}_median, min({m}) AS {m}_min, max({m}) AS {m}_max" for m in ("snr_db", "sfm", "hnr_db")) + " FROM gated",
    "kept_and_rejected": f"WITH {TGT}, {_GATED} SELECT t.segment_id, CASE WHEN t.speaker <> 'TARGET' OR g.filter_reason = 'keep' THEN 'kept' ELSE 'rejected' END AS side FROM tgt t LEFT JOIN gated g USING (segment_id)",
    "speech_ratio_gate": f"WITH {SEG} SELECT segment_id, (user_id % 100) / 100.0::DOUBLE AS speech_ratio, (user_id % 100) / 100.0::DOUBLE < 0.5 AS discarded FROM seg",
    "filter_decision_counts": f"WITH {TGT}, {_GATED} SELECT filter_reason AS filter_decision, count(*) AS n FROM gated WHERE filter_reason <> 'keep' GROUP BY ALL",
    "precision_demotion": f"WITH {TGT} SELECT segment_id, CASE WHEN speaker = 'TARGET' AND duration_ms < 1500 THEN 'UNCERTAIN' ELSE speaker END AS speaker FROM tgt",
    "label_map_apply": f"WITH {SEG}, {_MAP} SELECT segment_id, coalesce(global_label, s.speaker) AS speaker FROM seg s LEFT JOIN map m ON s.video_id = m.video_id AND s.speaker = m.speaker",
    "label_durations": f"WITH {SEG}, {_MAP} SELECT m.video_id, m.speaker, m.global_label, coalesce(sum(duration_ms), 0)::BIGINT AS total_ms FROM map m LEFT JOIN seg s ON s.video_id = m.video_id AND s.speaker = m.speaker GROUP BY ALL",
    "duration_rerank": f"""WITH {SEG}, {_MAP}, u AS (SELECT global_label, sum(duration_ms)::BIGINT AS total_ms FROM map m JOIN seg s ON s.video_id = m.video_id AND s.speaker = m.speaker GROUP BY ALL),
      top AS (SELECT global_label AS g FROM u ORDER BY total_ms DESC, global_label <> 'TARGET', global_label LIMIT 1)
      SELECT global_label, CASE WHEN global_label = g THEN 'TARGET' WHEN global_label = 'TARGET' THEN g ELSE global_label END AS new_label, total_ms FROM u, top""",
    "label_distribution": f"""WITH {TGT}, g AS (SELECT speaker, count(*) AS n, sum(duration_ms)::BIGINT AS total_ms FROM tgt GROUP BY speaker)
      SELECT *, row_number() OVER (ORDER BY CASE WHEN speaker = 'TARGET' THEN 0 WHEN speaker LIKE 'OTHER\\_%' ESCAPE '\\' THEN 1 WHEN speaker = 'UNKNOWN' THEN 3 WHEN speaker = 'UNCERTAIN' THEN 4 ELSE 2 END, speaker) AS position FROM g""",
    "overall_totals": f"WITH {SEG} SELECT count(*) AS n, sum(duration_ms)::BIGINT AS total_ms, count(DISTINCT speaker) AS n_speakers, count(DISTINCT video_id) AS n_videos FROM seg",
    "retention_funnel": f"""WITH {TGT}, {_GATED}, b AS (SELECT count(*) AS n_before, sum(duration_ms)::BIGINT AS ms_before, count_if(speaker = 'TARGET')::BIGINT AS target_before FROM tgt), a AS (SELECT count(*) AS n_after, coalesce(sum(duration_ms), 0)::BIGINT AS ms_after FROM gated WHERE filter_reason = 'keep')
      SELECT *, round(n_after * 100.0::DOUBLE / n_before, 2) AS segments_pct, round(ms_after * 100.0::DOUBLE / ms_before, 2) AS duration_pct, round((ms_before - ms_after) / 60000.0::DOUBLE, 2) AS minutes_lost, round(n_after * 100.0::DOUBLE / target_before, 2) AS target_pct FROM b, a""",
    "source_priority": f"WITH {SEG}, r AS (SELECT segment_id, speaker, 0 AS priority FROM seg WHERE speaker = 'no such speaker' UNION ALL SELECT segment_id, speaker, 1 FROM seg WHERE speaker = 'purchase' UNION ALL SELECT segment_id, speaker, 2 FROM seg) SELECT priority, segment_id, speaker FROM r WHERE priority = (SELECT min(priority) FROM r)",
    "longest_10": f"WITH {SEG} SELECT segment_id, duration_ms FROM seg ORDER BY duration_ms DESC, segment_id LIMIT 10",
    "shortest_10": f"WITH {SEG}, x AS (SELECT segment_id, duration_ms FROM seg ORDER BY duration_ms, segment_id DESC LIMIT 10) SELECT * FROM x WHERE duration_ms > 0",
    "stage_tally": f"WITH {SEG}, x AS (SELECT CASE WHEN segment_id % 7 = 0 THEN 'failed' WHEN segment_id % 5 = 0 THEN 'skipped' ELSE 'success' END AS st FROM seg) SELECT count(*) AS total, count_if(st = 'success')::BIGINT AS success, count_if(st = 'failed')::BIGINT AS failed, count_if(st = 'skipped')::BIGINT AS skipped, round(count_if(st = 'success') * 100.0::DOUBLE / count(*), 2) AS success_pct FROM x",
    "checkpoint_keys": f"WITH {SEG} SELECT video_id, speaker, sum(duration_ms)::BIGINT AS value FROM seg WHERE segment_id % 10 <> 0 GROUP BY ALL",
}
