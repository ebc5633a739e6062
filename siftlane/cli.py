"""Run a stage list over a lead file: ``python -m siftlane.cli v9 --source leads.parquet --out scored``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import low
from siftlane.plans.pipelines import STAGES, VALIDATION, Pipeline
from siftlane.sources.files import LEAD_SCHEMA, read_csv
from siftlane.sources.sinks import write_csv, write_partitioned


def load(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return read_csv(spark, path, LEAD_SCHEMA.replace("array<string>", "string")).drop("emails", "phones")
    return spark.read.parquet(path)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("stages", choices=sorted(STAGES))
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--limit", type=int, help="a trial run over the first leads by _ord")
    p.add_argument("--countries", help="countries whose leads count, comma-joined; all if left out")
    p.add_argument("--min-priority", type=int, help="the least priority of a source whose leads count")
    p.add_argument("--skip-validation", action="store_true", help="leave out the filters by address and name")
    p.add_argument("--by", help="write a folder for each value of this column")
    p.add_argument("--csv", action="store_true")
    o = p.parse_args(args)
    spark = SparkSession.builder.appName(f"siftlane {o.stages}").getOrCreate()
    leads = load(spark, o.source)
    if o.countries:
        leads = leads.where(F.lower(F.trim("country")).isin(*[c.strip().lower() for c in o.countries.split(",")]))
    if o.min_priority is not None:
        priorities = F.create_map(*[F.lit(x) for kv in D.SOURCE_PRIORITY.items() for x in kv])
        leads = leads.where(F.coalesce(F.try_element_at(priorities, low("source_type")), F.lit(0)) >= o.min_priority)
    if o.limit:
        leads = leads.orderBy("_ord").limit(o.limit)
    stages = Pipeline.named(o.stages)
    done = (stages.without(*VALIDATION) if o.skip_validation else stages).run(leads)
    if o.csv:
        write_csv(done.select(*[c for c, t in done.dtypes if not t.startswith(("struct", "map", "array<struct"))]), o.out)
    elif o.by:
        write_partitioned(done, o.out, o.by)
    else:
        done.write.mode("overwrite").parquet(o.out)
    print(done.agg(F.count("*").alias("rows")).first()["rows"], "leads in", o.out)


if __name__ == "__main__":
    main()
