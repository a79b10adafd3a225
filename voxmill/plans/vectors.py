"""Queries over embeddings and signals, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voxmill.functions import dsp
from voxmill.operators import embeddings, quality
from voxmill.session import shared_dir
from voxmill.sources import tables as t
from voxmill.streaming import incremental

#: Distances in the test embeddings lie near 1, so thresholds do too.
CUT, GATE = 0.9, 0.87
CELLS = t.CELLS_SQL
_DIST = f"""{CELLS}, vec AS (SELECT vec_id, label, list(x ORDER BY pos) AS e FROM cells GROUP BY ALL), dist AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label AS la, b.label AS lb, 1 - list_dot_product(a.e, b.e) AS d FROM vec a JOIN vec b ON a.vec_id <> b.vec_id)"""


def emb(s, d):
    return embeddings.normalised(t.embeddings(s, d))


def _spoiled(s, d):
    """Embeddings of which some have a NaN, an infinity, no length, or one dimension less."""
    e, k = t.embeddings(s, d), F.col("vec_id") % 10
    bad = F.when(k == 1, F.transform("embedding", lambda x: F.lit(float("nan")))).when(k == 2, F.transform("embedding", lambda x: F.lit(float("inf")))).when(k == 3, F.transform("embedding", lambda x: x * 0))
    return e.withColumn("embedding", bad.when(k == 4, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")))


def q_clusters(s, d):
    return embeddings.clusters(emb(s, d), CUT)


def q_rank_labels(s, d):
    sizes = emb(s, d).groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
    return embeddings.rank_labels(sizes).select("cluster", "size", "label")


def q_speakers(s, d):
    return embeddings.speaker_labels(t.embeddings(s, d), 0.8, 1.0, GATE, True)


def _wave(e):
    """An embedding as a waveform: its values, over and over, 2048 samples long."""
    return F.flatten(F.array_repeat(e, 32)).cast("array<double>")


def q_snr(s, d):
    """SNR of tones whose level changes halfway by the vector's number."""
    x = F.transform(F.sequence(F.lit(0), F.lit(4095)), lambda i: F.when(i < 2048, 0.01).otherwise(0.01 * (1 + F.col("vec_id") % 20)) * F.when(i % 2 == 0, 1).otherwise(-1))

    @F.pandas_udf("double")
    def run(samples: pd.Series) -> pd.Series:
        return samples.map(lambda v: dsp.snr_db(np.asarray(v)))

    return t.embeddings(s, d).select("vec_id", x.alias("x")).select("vec_id", F.round(run("x"), 6).alias("snr_db"))


_SNR = """WITH f AS (SELECT vec_id, k, (0.01 * (1 + vec_id % 20))::DOUBLE AS loud FROM embeddings, range(0, 15) r(k)),
  e AS (SELECT vec_id, greatest(0, least(512, 2048 - k * 256)) * 0.0001::DOUBLE + (512 - greatest(0, least(512, 2048 - k * 256))) * loud * loud AS energy FROM f),
  p AS (SELECT vec_id, greatest(quantile_cont(energy, 0.1), 1e-12) AS lo, greatest(quantile_cont(energy, 0.9), 1e-12) AS hi FROM e GROUP BY vec_id) SELECT vec_id, round(greatest(0, least(60, 10 * log10(hi / lo))), 6) AS snr_db FROM p"""


def q_signal(s, d):
    e = t.embeddings(s, d)
    run = dsp.metrics_udf()
    return e.select("vec_id", run(_wave(F.col("embedding")), F.expr("array(struct(0D AS start, 0.128D AS end))")).alias("m")).select("vec_id", *[F.round(f"m.{c}", 6).alias(c) for c in ("snr_db", "sfm", "hnr_db")], "m.speech_samples", "m.total_samples")


def q_loudness(s, d):
    """Gain that brings each waveform to -26 dB below full scale, and its clipping ratio, constant part and peak."""

    @F.pandas_udf("gain double, clipping double, dc double, peak double")
    def run(samples: pd.Series) -> pd.DataFrame:
        rows = []
        for x in map(np.asarray, samples):
            top = int(np.abs(x).argmax())
            rows.append((dsp.loudness_normalise(x)[top] / x[top], dsp.clipping_ratio(x, 0.2), dsp.dc_offset(x), abs(x[top])))
        return pd.DataFrame(rows, columns=["gain", "clipping", "dc", "peak"])

    return t.embeddings(s, d).select("vec_id", run("embedding").alias("m")).select("vec_id", *[F.round(f"m.{c}", 6).alias(c) for c in ("gain", "clipping", "dc", "peak")])


def q_validity(s, d):
    """Reasons for which waveforms are refused."""
    k = F.col("vec_id") % 4
    x = F.when(k == 0, F.slice("embedding", 1, 50)).when(k == 1, F.flatten(F.array_repeat("embedding", 10))).when(k == 2, F.transform(_wave(F.col("embedding")), lambda v: v * 0)).otherwise(_wave(F.col("embedding")))
    return t.embeddings(s, d).select("vec_id", x.alias("x")).select("vec_id", quality.audio_status(F.col("x"), F.lit(16_000)).alias("status"))


def q_stab(s, d):
    """Whether segments' midpoints, in the minute, are speech, with speech in the first 20 s and from 30 to 45 s."""
    from voxmill.operators.intervals import in_speech

    spans = F.expr("array(struct(0L AS start, 20000L AS end), struct(30000L AS start, 45000L AS end))")
    seg = t.segments(s, d).withColumn("mid", F.pmod(F.col("start_ms") + F.expr("duration_ms div 2"), F.lit(60_000)))
    return seg.select("segment_id", in_speech(spans, F.col("mid")).alias("in_speech"))


def q_incremental(s, d):
    """Totals by recording and speaker kept by a stream over the events table's file."""
    work = f"{shared_dir(s).rstrip('/')}/stream-{os.urandom(8).hex()}"
    t.segments(s, d).select("video_id", "speaker", "duration_ms").write.parquet(f"{work}/in")
    schema = s.read.parquet(f"{work}/in").schema
    incremental.update_totals(incremental.read_new(s, f"{work}/in", schema), f"{work}/out", f"{work}/checkpoint")
    return s.read.parquet(f"{work}/out")


QUERIES = {
    "embedding_validity": lambda s, d: embeddings.normalised(_spoiled(s, d)).select("vec_id", F.size("embedding").cast("long").alias("dim")),
    "modal_dimension": lambda s, d: embeddings.modal_dimension(embeddings.normalised(_spoiled(s, d))).select("vec_id"),
    "cosine_neighbors": lambda s, d: embeddings.nearest(emb(s, d)).select(F.col("id").alias("vec_id"), F.round("min_dist", 6).alias("min_dist")),
    "cosine_pairs": lambda s, d: embeddings.pairs_under(emb(s, d), CUT).select("a", "b", F.round("dist", 6).alias("dist")),
    "cluster_quality": lambda s, d: embeddings.cluster_quality(emb(s, d)).select("label", "n", *[F.round(c, 6).alias(c) for c in ("intra", "inter", "ratio")]),
    "centroid_gate": lambda s, d: embeddings.centroid_distances(emb(s, d)).select("vec_id", F.round("dist", 6).alias("dist"), (F.round("dist", 6) > GATE).alias("uncertain")),
    "iqr_outliers": lambda s, d: embeddings.iqr_outliers(emb(s, d)).select("vec_id", "mean_dist", "is_outlier"),
    "cluster_rank_labels": q_rank_labels,
    "ahc_clusters": q_clusters,
    "speaker_labels": q_speakers,
    "frame_snr": q_snr,
    "signal_metrics": q_signal,
    "loudness_gain": q_loudness,
    "audio_validity": q_validity,
    "speech_mask": q_stab,
    "incremental_totals": q_incremental,
}

ORACLE = {
    "embedding_validity": "SELECT vec_id, CASE WHEN vec_id % 10 = 4 THEN 63 ELSE 64 END::BIGINT AS dim FROM embeddings WHERE vec_id % 10 NOT IN (1, 2, 3)",
    "modal_dimension": "SELECT vec_id FROM embeddings WHERE vec_id % 10 NOT IN (1, 2, 3, 4)",
    "cosine_neighbors": f"WITH {_DIST} SELECT a AS vec_id, round(greatest(min(d), 0), 6) AS min_dist FROM dist GROUP BY a",
    "cosine_pairs": f"WITH {_DIST} SELECT a, b, round(d, 6) AS dist FROM dist WHERE a < b AND d < {CUT}",
    "cluster_quality": f"""WITH {_DIST}, n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label), i AS (SELECT la, avg(d) AS intra FROM dist WHERE la = lb GROUP BY la),
      x AS (SELECT la, lb, avg(d) AS m FROM dist WHERE la <> lb GROUP BY la, lb), o AS (SELECT la, avg(m) AS inter FROM x GROUP BY la)
      SELECT n.label, n, round(intra, 6) AS intra, round(inter, 6) AS inter, round(intra / inter, 6) AS ratio FROM n JOIN o ON o.la = n.label LEFT JOIN i ON i.la = n.label""",
    "centroid_gate": f"""WITH {CELLS}, c AS (SELECT label, pos, avg(x) AS m FROM cells GROUP BY ALL), l AS (SELECT label, sqrt(sum(m * m)) AS len FROM c GROUP BY label),
      g AS (SELECT vec_id, round(1 - sum(x * m) / any_value(len), 6) AS dist FROM cells JOIN c USING (label, pos) JOIN l USING (label) GROUP BY vec_id) SELECT vec_id, dist, dist > {GATE} AS uncertain FROM g""",
    "iqr_outliers": f"""WITH {_DIST}, m AS (SELECT a, la, round(avg(d), 6) AS x, count(*) + 1 AS n FROM dist WHERE la = lb GROUP BY ALL), q AS (SELECT la, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM m GROUP BY la)
      SELECT a AS vec_id, x AS mean_dist, n >= 4 AND x > q3 + 1.5 * (q3 - q1) AS is_outlier FROM m JOIN q USING (la)""",
    "cluster_rank_labels": """WITH s AS (SELECT label AS cluster, count(*) AS size, min(vec_id) AS first FROM embeddings GROUP BY label), r AS (SELECT *, row_number() OVER (ORDER BY size DESC, first) AS k FROM s)
      SELECT cluster, size, CASE WHEN k = 1 THEN 'TARGET' ELSE printf('OTHER_%02d', k - 2) END AS label FROM r""",
    "frame_snr": _SNR,
    "loudness_gain": """WITH c AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT vec_id, round(pow(10.0::DOUBLE, -1.3::DOUBLE) / sqrt(sum(x * x) / count(*)), 6) AS gain,
      round(count_if(abs(x) > 0.2) / count(*)::DOUBLE, 6) AS clipping, round(sum(x) / count(*), 6) AS dc, round(max(abs(x)), 6) AS peak FROM c GROUP BY vec_id""",
    "audio_validity": "SELECT vec_id, ['audio_empty', 'audio_too_short', 'audio_silent', 'ok'][vec_id % 4 + 1] AS status FROM embeddings",
    "speech_mask": f"WITH {t.SEGMENTS_SQL}, m AS (SELECT segment_id, (start_ms + duration_ms // 2) % 60000 AS mid FROM seg) SELECT segment_id, mid < 20000 OR (mid >= 30000 AND mid < 45000) AS in_speech FROM m",
    "incremental_totals": f"WITH {t.SEGMENTS_SQL} SELECT video_id, speaker, count(*) AS n, sum(duration_ms)::BIGINT AS total_ms FROM seg GROUP BY ALL",
}
