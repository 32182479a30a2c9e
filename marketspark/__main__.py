"""Command line: ``python -m marketspark stream|rebuild|compact|validate``; run it with spark-submit on a cluster."""

from __future__ import annotations

import argparse
import json
import os

from marketspark.operators.quality import SUITES, require, validate_table
from marketspark.plans.rebuild import rebuild
from marketspark.schemas import GOLD, RAW_TOPIC
from marketspark.session import build_session, object_store_options
from marketspark.sinks.compaction import TARGET_FILE_SIZE_MB, compact
from marketspark.sources.tables import Layout
from marketspark.sources.topics import publishing_options, reading_options, topic_stream
from marketspark.streaming.jobs import TradeStreams


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marketspark")
    parser.add_argument("--object-store-endpoint", help="S3-compatible endpoint; keys come from the environment")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="topic to bronze, dead letters, silver and gold")
    stream.add_argument("--bootstrap-servers", required=True)
    stream.add_argument("--topic", default=RAW_TOPIC)
    stream.add_argument("--root", required=True)
    stream.add_argument("--watermark-seconds", type=int, default=60)
    stream.add_argument("--gold", nargs="*", choices=sorted(GOLD), default=[])
    stream.add_argument("--windows", nargs="+", default=["1 minute"])
    stream.add_argument("--publish-dead-letters", action="store_true", help="to their topic instead of a table")

    again = commands.add_parser("rebuild", help="silver, gold and marts from stored bronze, into a new root")
    again.add_argument("--bronze", required=True)
    again.add_argument("--root", required=True)
    again.add_argument("--windows", nargs="+", default=["1 minute"])

    files = commands.add_parser("compact", help="rewrite a partitioned table with fewer files")
    files.add_argument("--input-path", required=True)
    files.add_argument("--output-path", required=True)
    files.add_argument("--target-file-size-mb", type=float, default=TARGET_FILE_SIZE_MB)

    checks = commands.add_parser("validate", help="run a suite; exit status 1 when it fails")
    checks.add_argument("--suite", required=True, choices=sorted(SUITES))
    checks.add_argument("--path", required=True)
    checks.add_argument("--output")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    options = {}
    if args.object_store_endpoint:
        options = object_store_options(
            args.object_store_endpoint, os.environ["AWS_ACCESS_KEY_ID"], os.environ["AWS_SECRET_ACCESS_KEY"]
        )
    spark = build_session(f"marketspark-{args.command}", options=options)
    if args.command == "stream":
        source = topic_stream(spark, reading_options(args.bootstrap_servers, args.topic))
        publishing = publishing_options(args.bootstrap_servers) if args.publish_dead_letters else None
        TradeStreams(spark, source, Layout(args.root), args.watermark_seconds, publishing=publishing).run(args.gold, args.windows)
    elif args.command == "rebuild":
        rebuild(spark, args.bronze, Layout(args.root), window_durations=args.windows)
    elif args.command == "compact":
        print(json.dumps(compact(spark, args.input_path, args.output_path, args.target_file_size_mb)))
    else:
        result = validate_table(spark, args.suite, args.path, args.output)
        print(json.dumps(result, indent=2))
        require(result)


if __name__ == "__main__":
    main()
