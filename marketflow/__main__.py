"""Command line for the daily steps, for an orchestrator or spark-submit.

    python -m marketflow lake-cut      --lake PATH --default DATE [--since DATE]
    python -m marketflow ingest-master (--messages PATH | --brokers HOSTS --topic NAME) --raw PATH --checkpoint PATH
    python -m marketflow clean-master  --raw PATH --out PATH
    python -m marketflow enrich        (--messages PATH | --brokers HOSTS --topic NAME) --master PATH --lake PATH
                                       --checkpoint PATH [--cut-token TOKEN | --cut DATE]
    python -m marketflow replay        --lake PATH --master PATH
    python -m marketflow load          --lake PATH --warehouse PATH --initial-cut DATE [--lookback-days N]
    python -m marketflow news          --texts PATH --tickers A,B --warehouse PATH [--horizon-days N]
                                       [--whole-files]
    python -m marketflow news-stream   --texts PATH --tickers A,B --out PATH --checkpoint PATH
                                       [--delay-days N] [--whole-files]
    python -m marketflow study         --articles PATH --lake PATH --out PATH [--days N]

Before the step: ``--checkpoint-dir`` names the folder that the driver and all
executors share (``spark.checkpoint.dir``); only local masters do without.
``lake-cut`` prints the cut's base64 token as its last line, which ``enrich``
takes as ``--cut-token``. A topic needs the Kafka connector in the session (``spark-submit
--packages``); ``--option KEY=VALUE`` sets its reader's options. ``news-stream`` reads each
text once over all runs, ``study`` writes the correlation of sentiment and return per ticker
and day over the last ``--days``. ``replay`` brings bars that waited for their master row
into the lake, after ``clean-master``. ``load`` takes the batches that a streamed lake's
record names as new; ``--lookback-days`` is for other lakes. The warehouse here is a Parquet folder; a JDBC
warehouse is used through the library (``JdbcWarehouse``) so that credentials
never appear on a command line.
"""

from __future__ import annotations

import argparse
import base64
import datetime as dt
import json
import sys


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text.strip())


def _token_date(token: str) -> dt.date:
    return _date(base64.b64decode(token).decode("utf-8"))


def _pairs(items: list[str]) -> dict[str, str]:
    return {key: value for key, _, value in (item.partition("=") for item in items)}


def _add_source(p: argparse.ArgumentParser) -> None:
    """Messages from landed files or from a topic."""
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of landed message files")
    source.add_argument("--topic", help="Kafka topic, with --brokers")
    p.add_argument("--brokers", help="kafka.bootstrap.servers")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the topic's reader (repeatable)")
    p.add_argument("--max-files-per-trigger", type=int, default=None)


def _topic_options(args: argparse.Namespace) -> dict[str, str]:
    return {"kafka.bootstrap.servers": args.brokers, "subscribe": args.topic, **_pairs(args.option)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marketflow")
    parser.add_argument("--master-url", default=None, help="Spark master (default: from spark-submit)")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE",
                        help="extra Spark setting (repeatable)")
    parser.add_argument("--checkpoint-dir", default=None,
                        help="shared folder for derived tables (spark.checkpoint.dir)")
    sub = parser.add_subparsers(dest="step", required=True)

    p = sub.add_parser("lake-cut")
    p.add_argument("--lake", required=True)
    p.add_argument("--default", required=True, type=_date)
    p.add_argument("--since", type=_date, default=None, help="the last known cut")

    p = sub.add_parser("clean-master")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)

    p = sub.add_parser("ingest-master")
    _add_source(p)
    p.add_argument("--raw", required=True)
    p.add_argument("--checkpoint", required=True)

    p = sub.add_parser("enrich")
    _add_source(p)
    p.add_argument("--master", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--checkpoint", required=True)
    g = p.add_mutually_exclusive_group()
    g.add_argument("--cut-token", type=_token_date, dest="cut")
    g.add_argument("--cut", type=_date, dest="cut")

    p = sub.add_parser("replay")
    p.add_argument("--lake", required=True)
    p.add_argument("--master", required=True)

    p = sub.add_parser("load")
    p.add_argument("--lake", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--initial-cut", required=True, type=_date)
    p.add_argument("--lookback-days", type=int, default=0)

    p = sub.add_parser("news")
    p.add_argument("--texts", required=True)
    p.add_argument("--tickers", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--horizon-days", type=int, default=None)
    p.add_argument("--whole-files", action="store_true", help="one JSON text per file, not per line")

    p = sub.add_parser("news-stream")
    p.add_argument("--texts", required=True)
    p.add_argument("--tickers", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--delay-days", type=int, default=100)
    p.add_argument("--whole-files", action="store_true", help="one JSON text per file, not per line")
    p.add_argument("--max-files-per-trigger", type=int, default=None)

    p = sub.add_parser("study")
    p.add_argument("--articles", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--days", type=int, default=90)

    args = parser.parse_args(argv)
    if getattr(args, "topic", None) and not args.brokers:
        parser.error("--topic needs --brokers")

    from pyspark.sql import SparkSession

    from marketflow.operators.incremental import ParquetWarehouse
    from marketflow.plans import jobs
    from marketflow.sinks.parquet import overwrite_parquet
    from marketflow.sources.messages import read_message_files
    from marketflow.sources.parquet import read_lake
    from marketflow.streaming.lake import replay_unmatched

    builder = SparkSession.builder.appName(f"marketflow-{args.step}")
    if args.master_url:
        builder = builder.master(args.master_url)
    if args.checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", args.checkpoint_dir)
    for key, value in _pairs(args.conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        if args.step == "lake-cut":
            row = jobs.lake_cut_token(spark, args.lake, args.default, args.since).first()
            print(row["token"] if row else base64.b64encode(f"{args.default}\n".encode()).decode())
        elif args.step == "clean-master":
            jobs.clean_master_table(spark, args.raw, args.out)
        elif args.step == "ingest-master":
            if args.topic:
                rows = jobs.ingest_master_from_kafka(spark, _topic_options(args), args.raw, args.checkpoint)
            else:
                messages = read_message_files(spark, args.messages, streaming=True,
                                              max_files_per_trigger=args.max_files_per_trigger)
                rows = jobs.ingest_master(spark, messages, args.raw, args.checkpoint)
            print(json.dumps({"rows_in": rows}))
        elif args.step == "enrich":
            if args.topic:
                routes = jobs.enrich_kafka_to_lake(spark, _topic_options(args), args.master, args.lake,
                                                   args.checkpoint, args.cut)
            else:
                messages = read_message_files(spark, args.messages, streaming=True,
                                              max_files_per_trigger=args.max_files_per_trigger)
                routes = jobs.enrich_stream_to_lake(spark, messages, args.master, args.lake,
                                                    args.checkpoint, args.cut)
            print(json.dumps({"messages_in": sum(routes.values()), **routes}))
        elif args.step == "replay":
            print(json.dumps(replay_unmatched(spark, args.lake, spark.read.parquet(args.master))))
        elif args.step == "load":
            wh = ParquetWarehouse(spark, args.warehouse, partition_by={"market_data": ["year", "month"]})
            out = jobs.load_warehouse(spark, args.lake, wh, args.initial_cut, args.lookback_days)
            print(json.dumps(out, default=str))
        elif args.step == "news":
            wh = ParquetWarehouse(spark, args.warehouse)
            out = jobs.publish_articles(spark, args.texts, args.tickers, wh,
                                        horizon_days=args.horizon_days, whole_files=args.whole_files)
            print(json.dumps(out))
        elif args.step == "news-stream":
            out = jobs.stream_articles(spark, args.texts, args.tickers, args.out, args.checkpoint, args.delay_days,
                                       args.whole_files, args.max_files_per_trigger)
            print(json.dumps(out))
        elif args.step == "study":
            found = jobs.rolling_study(spark.read.parquet(args.articles), read_lake(spark, args.lake), days=args.days)
            overwrite_parquet(found, args.out)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
