"""Runs of the stages over a folder of stage tables: all, a range, or what is missing.

A stage's result is written to <folder>/<id>. Stages run in the order of their ids, which is that of their dependencies; the automatic run
starts a stage when its own table is missing or one of its inputs was just made.
"""

from __future__ import annotations

import argparse
import importlib
import logging

from pyspark.sql import SparkSession

from voxmill.config import load_config
from voxmill.plans.stages import STAGES, Context, Stage
from voxmill.sources.sinks import write_table

log = logging.getLogger("voxmill")


def stage_range(first: str | None = None, last: str | None = None, stages: dict[str, Stage] = STAGES) -> list[str]:
    """Ids from first to last, both included, in the order of the ids as text."""
    ids = sorted(stages)
    for x in (first, last):
        if x is not None and x not in stages:
            raise ValueError(f"no stage {x}; there are {', '.join(ids)}")
    return [i for i in ids if (first is None or i >= first) and (last is None or i <= last)]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written whole to path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def run_stage(spark: SparkSession, ctx: Context, stage_id: str, stages: dict[str, Stage] = STAGES) -> bool:
    """Run a stage and write its table; False if the configuration leaves it out. Fails early on missing inputs."""
    stage = stages[stage_id]
    if not stage.enabled(ctx):
        log.info("stage %s is switched off", stage_id)
        return False
    names = stage.inputs(ctx)
    if missing := [i for i in names if not exists(spark, f"{ctx.folder}/{i}")]:
        raise FileNotFoundError(f"stage {stage_id} needs {', '.join(missing)}")
    inputs = {i: spark.read.parquet(f"{ctx.folder}/{i}") for i in names}
    write_table(stage.run(spark, inputs, ctx), f"{ctx.folder}/{stage_id}")
    log.info("stage %s (%s) is done", stage_id, stage.title)
    return True


def run_range(spark: SparkSession, ctx: Context, first: str | None = None, last: str | None = None) -> list[str]:
    return [i for i in stage_range(first, last) if run_stage(spark, ctx, i)]


def run_missing(spark: SparkSession, ctx: Context) -> list[str]:
    """Run, in order, the stages without a table and those that depend on one that ran; stages whose inputs are absent wait."""
    ran: list[str] = []
    for i in stage_range():
        names = STAGES[i].inputs(ctx)
        stale = not exists(spark, f"{ctx.folder}/{i}") or any(x in ran for x in names)
        if stale and all(exists(spark, f"{ctx.folder}/{x}") for x in names) and run_stage(spark, ctx, i):
            ran.append(i)
    return ran


def load_models(name: str | None) -> dict:
    """The hook factories that a module holds in MODELS; none without a module."""
    return dict(importlib.import_module(name).MODELS) if name else {}


def main(argv: list[str] | None = None) -> list[str]:
    p = argparse.ArgumentParser(description="Run stages over a folder of stage tables.")
    p.add_argument("folder")
    p.add_argument("--all", action="store_true")
    p.add_argument("--auto", action="store_true")
    p.add_argument("--from", dest="first")
    p.add_argument("--to", dest="last")
    p.add_argument("--config")
    p.add_argument("--models", help="module whose MODELS has hook factories by name")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("voxmill").getOrCreate()
    ctx = Context(a.folder, load_config(a.config), load_models(a.models))
    return run_missing(spark, ctx) if a.auto and not a.first else run_range(spark, ctx, a.first, a.last)


if __name__ == "__main__":
    main()
