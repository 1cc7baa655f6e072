"""Run the jobs: ``spark-submit ... -m fiscalframe <job>`` or ``python -m fiscalframe <job>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from fiscalframe.operators.quality import run_summary
from fiscalframe.operators.requests import build_requests, next_requests
from fiscalframe.operators.worklist import DOCUMENT_URL, fetch_outcomes, fetch_summary, fetch_worklist
from fiscalframe.operators.responses import attempt_states
from fiscalframe.plans.receipts import parse_receipts
from fiscalframe.plans.responses import recover_receipts
from fiscalframe.sources.inputs import list_images, read_fetch_log, read_fiscal_ids, read_ocr_text, read_responses
from fiscalframe.sources.outputs import write_by_sale_date, write_csv
from fiscalframe.streaming.answers import current_receipts, keep_answers, stream_responses
from fiscalframe.streaming.incremental import parse_new_receipts, stream_ocr_files, stream_ocr_table


def _show(one_row: DataFrame) -> None:
    for name, value in one_row.first().asDict().items():
        print(f"{name}: {value}")


def worklist(spark: SparkSession, args: argparse.Namespace) -> None:
    wanted = fetch_worklist(read_fiscal_ids(spark, args.ids), list_images(spark, args.images), args.base_url)
    wanted.write.option("header", True).csv(args.out)


def outcomes(spark: SparkSession, args: argparse.Namespace) -> None:
    _show(fetch_summary(fetch_outcomes(read_fetch_log(spark, args.log, args.format), list_images(spark, args.images))))


def parse(spark: SparkSession, args: argparse.Namespace) -> None:
    items = parse_receipts(read_ocr_text(spark, args.text, args.format))
    (write_by_sale_date if args.by_date else write_csv)(items, args.out)


def parse_new(spark: SparkSession, args: argparse.Namespace) -> None:
    source = stream_ocr_files if args.format == "text" else stream_ocr_table
    parse_new_receipts(source(spark, args.text), args.out, args.checkpoint).awaitTermination()


def requests(spark: SparkSession, args: argparse.Namespace) -> None:
    build_requests(read_ocr_text(spark, args.text, args.format)).write.json(args.out)


def requests_again(spark: SparkSession, args: argparse.Namespace) -> None:
    states = attempt_states(read_responses(spark, args.responses, args.responses_format))
    next_requests(read_ocr_text(spark, args.text, args.format), states, args.max_attempts or 2).write.json(args.out)


def recover_new(spark: SparkSession, args: argparse.Namespace) -> None:
    keep_answers(stream_responses(spark, args.responses), args.kept, args.checkpoint).awaitTermination()
    write_csv(current_receipts(read_ocr_text(spark, args.text, args.format), args.kept), args.out, two_decimals=True)


def recover(spark: SparkSession, args: argparse.Namespace) -> None:
    receipts = read_ocr_text(spark, args.text, args.format)
    answers = read_responses(spark, args.responses, args.responses_format)
    # The CSV and the summary both need the rows; what an executor loses of them is worked out again.
    rows = recover_receipts(receipts, answers, args.max_attempts).persist(StorageLevel.DISK_ONLY)
    write_csv(rows, args.out, two_decimals=True)
    _show(run_summary(rows, receipts))
    rows.unpersist()


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fiscalframe", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(run, summary: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__.replace("_", "-"), help=summary)
        sub.set_defaults(run=run)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    job(worklist, "IDs whose image is still to be fetched", "ids", "images", "out").add_argument(
        "--base-url", default=DOCUMENT_URL
    )
    from_log = job(outcomes, "how fetching went", "log", "images")
    parsing = job(parse, "receipt text to items", "text", "out")
    parsing.add_argument("--by-date", action="store_true", help="parquet by sale date instead of CSV")
    fresh = job(parse_new, "only text that arrived since the last run", "text", "out", "checkpoint")
    asking = job(requests, "one extraction request per receipt", "text", "out")
    recovering = job(recover, "model answers to items, with a summary", "text", "responses", "out")
    again = job(requests_again, "requests for the next attempt of receipts without an answer", "text", "responses", "out")
    renewing = job(recover_new, "take in answers that arrived since the last run, then write all items", "text", "responses", "kept", "checkpoint", "out")
    for sub in (parsing, fresh, asking, recovering, again, renewing):
        sub.add_argument("--format", default="parquet", choices=("parquet", "json", "text"), help="of the receipt text")
    tables = ("parquet", "json")
    from_log.add_argument("--format", default="parquet", choices=tables, help="of the fetch log")
    for sub in (recovering, again):
        sub.add_argument("--responses-format", default="parquet", choices=tables, help="of the answers")
    recovering.add_argument("--max-attempts", type=int, help="attempts that count; all unless given")
    again.add_argument("--max-attempts", type=int, help="attempts that a receipt gets; two unless given")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName("fiscalframe").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
