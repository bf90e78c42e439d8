"""Command line: python -m qaforge JOB SETTINGS, where SETTINGS is a YAML or JSON file.

normalise: datasets (see ``sources.adapters.job``), out. split: samples (JSON lines), out, seed. manifest: refs (Parquet), out and the
settings of ``sources.config.Sampling``. profile: samples, out. distil: samples, out, url, model, key_env, version, done.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .operators import jobs, merge, provider
from .session import ship
from .sources import adapters, config, sinks


def _samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.SAMPLE).json(path, recursiveFileLookup=True)


def run(spark: SparkSession, name: str, s: dict):
    """Result of a job's report. KeyError for a missing setting."""
    ship(spark)
    if name == "normalise":
        return adapters.normalise_all(spark, s["datasets"], s["out"])
    if name == "split":
        return jobs.split_job(spark, _samples(spark, s["samples"]), s["out"], s.get("seed", 42), s.get("ratios"))
    if name == "manifest":
        return jobs.manifest_job(spark, spark.read.parquet(s["refs"]), config.Sampling.of(s), s["out"], s.get("mode", "hash"))
    if name == "profile":
        p = merge.profile(_samples(spark, s["samples"]), "source", ["task_type", "task_domain", "language"], ["context"])
        report = sinks.figures(p, ["source", "metric", "value"])
        sinks.write_report(spark, s["out"], report)
        return report
    if name == "distil":
        fields = schema.SAMPLE.fieldNames()
        df = _samples(spark, s["samples"])
        df = df.withColumns({c: F.lit("") for c in ("model_answer", "model_reasoning") if c not in fields})
        done = spark.read.schema("id string, model_answer string, model_reasoning string").json(s["done"]) if s.get("done") else None
        model = provider.HttpProvider(s["url"], os.environ[s["key_env"]], s["model"])
        return {"rows": sinks.write_json_lines(jobs.distil(df, model, s["model"], s.get("version", "v1"), done), s["out"])}
    raise KeyError(name)


def main() -> None:
    p = argparse.ArgumentParser(prog="qaforge", description=__doc__)
    p.add_argument("job", choices=["normalise", "split", "manifest", "profile", "distil"])
    p.add_argument("settings")
    a = p.parse_args()
    spark = SparkSession.builder.appName(f"qaforge {a.job}").getOrCreate()
    print(run(spark, a.job, config.load(a.settings)))
    spark.stop()


if __name__ == "__main__":
    main()
