"""Daily job runner: ``spark-submit --py-files portrait.zip portrait/jobs.py <job> <yyyyMMdd> --tables DIR --out DIR``
(or ``python -m portrait.jobs ...``).

Runs one registered query for a job date against the tables in ``--tables``
and publishes the result as that date's partition of ``<out>/<job>``
(dynamic partition overwrite: re-running a date replaces only that date).
The job date becomes the as-of date of the query; nothing reads the wall
clock."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import DataFrame, SparkSession

if __package__ in (None, ""):   # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portrait.plans import params
from portrait.plans.queries import QUERIES
from portrait.sources.sinks import overwrite_partition


def run_job(spark: SparkSession, job: str, job_date: str, tables: str, out: str | None = None) -> DataFrame:
    if job not in QUERIES:
        raise KeyError(f"unknown job {job!r}; known: {', '.join(sorted(QUERIES))}")
    day = dt.datetime.strptime(job_date, "%Y%m%d").date()
    with params.job_day(day):
        df = QUERIES[job](spark, tables)
        if out:
            overwrite_partition(df, f"{out.rstrip('/')}/{job}", int(job_date))
        return df


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="portrait.jobs", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", help="query key, e.g. install_features")
    ap.add_argument("job_date", help="yyyyMMdd")
    ap.add_argument("--tables", required=True, help="folder with the input parquet tables")
    ap.add_argument("--out", required=True, help="warehouse folder; output goes to <out>/<job>/stat_date=<date>")
    a = ap.parse_args(argv)
    from portrait.session import build_session
    spark = build_session(app_name=f"portrait-{a.job}")
    run_job(spark, a.job, a.job_date, a.tables, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
