"""Run the pipeline: ``PYTHONPATH=. spark-submit hiretide/__main__.py --help``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from hiretide.session import CONF
from hiretide.sources.event_stream import EventFiles, KafkaTopic
from hiretide.streaming.pipeline import COUNTS, await_all, run_pipeline
from hiretide.streaming.tables import MODES, reset


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hiretide")
    parser.add_argument("--root", required=True, help="folder of the tables and checkpoints")
    parser.add_argument("--files", help="read event files of this folder instead of the topic "
                                        "that KAFKA_BOOTSTRAP and KAFKA_TOPIC_RAW name")
    parser.add_argument("--per-batch", type=int, help="files or events a batch reads at most")
    parser.add_argument("--mode", choices=MODES, default="queries")
    parser.add_argument("--window", type=int, default=300, help="window size in seconds")
    parser.add_argument("--watermark", help="e.g. '1 hour': drop state and events older than this")
    parser.add_argument("--count", choices=COUNTS, help="count events once, or every delivery")
    parser.add_argument("--merge-every", type=int, default=100, help="batches between merges")
    parser.add_argument("--every", help="e.g. '30 seconds': time between batches")
    parser.add_argument("--once", action="store_true", help="read what is there, then stop")
    parser.add_argument("--reset", action="store_true", help="empty the tables first")
    args = parser.parse_args(arguments)

    builder = SparkSession.builder.appName("hiretide")
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.reset:
        reset(spark, args.root, args.mode)
    source = EventFiles(args.files, args.per_batch) if args.files \
        else KafkaTopic.from_env(os.environ, max_per_batch=args.per_batch)
    trigger = {"availableNow": True} if args.once \
        else {"processingTime": args.every} if args.every else None
    await_all(run_pipeline(spark, source, args.root, args.mode, trigger, args.window,
                           args.watermark, count=args.count, merge_every=args.merge_every))


if __name__ == "__main__":
    main()
