"""python -m folioflow INPUT --out OUT [--from-layer N] [--set section.name=value ...]

INPUT holds the decoded tables as Parquet: pages, regions, drawings, native_tables, and any of responses, documents, figures.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from folioflow.config import Config
from folioflow.plans import pipeline as PL


def configured(settings: list[str]) -> Config:
    """Config with values such as cutting.tokens=256 put in; values are JSON, or else plain strings."""
    cfg = Config()
    for item in settings:
        path, _, raw = item.partition("=")
        section, _, name = path.partition(".")
        old = getattr(getattr(cfg, section), name)
        try:
            value = json.loads(raw)
        except ValueError:
            value = raw
        if type(value) is not type(old) and not (isinstance(old, float) and isinstance(value, int)):
            raise SystemExit(f"{path} takes a {type(old).__name__}")
        cfg = dataclasses.replace(cfg, **{section: dataclasses.replace(getattr(cfg, section), **{name: value})})
    return cfg


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    p.add_argument("input")
    p.add_argument("--out", required=True)
    p.add_argument("--from-layer", type=int, default=1, choices=range(1, len(PL.LAYERS) + 1))
    p.add_argument("--set", action="append", default=[], metavar="SECTION.NAME=VALUE")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("folioflow").getOrCreate()
    tables = {}
    for f in dataclasses.fields(PL.Inputs):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{a.input}/{f.name}")
        if f.default is dataclasses.MISSING or path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            tables[f.name] = spark.read.parquet(str(path))
    made = PL.execute(PL.Run(spark, a.out, configured(a.set)), PL.Inputs(**tables), a.from_layer)
    for row in made.toLocalIterator():
        print(row.asDict(recursive=True))


if __name__ == "__main__":
    main()
