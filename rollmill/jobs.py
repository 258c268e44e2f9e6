"""``spark-submit run_job.py stream|batch settings.json``: run one of the two jobs."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rollmill.plans.batch import BatchJob
from rollmill.session import shared_dir
from rollmill.spec import read_settings
from rollmill.streaming.job import StreamJob


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("job", choices=("stream", "batch"))
    options.add_argument("settings", help="JSON file with the indexer and table settings")
    options.add_argument("--checkpoint", help="stream checkpoint (default: below spark.checkpoint.dir)")
    options.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    args = options.parse_args(argv)

    spark = SparkSession.builder.appName(f"rollmill-{args.job}").getOrCreate()
    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(args.settings).collect())
    indexer, tables = read_settings(text)
    if args.job == "stream":
        checkpoint = args.checkpoint or f"{shared_dir(spark)}/{indexer.id}"
        job = StreamJob(spark, indexer, tables)
        job.start(checkpoint, available_now=args.available_now).awaitTermination()
    else:
        BatchJob(spark, indexer, tables).run()


if __name__ == "__main__":
    main()
