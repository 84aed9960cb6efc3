"""Run a workflow: ``python -m hustings history DATA OUT``, ``… template DATA TEMPLATE OUT``, ``… web PAGES OUT`` or
``… contest TABLES OUT`` (a folder with one Parquet table per field of ``plans.contest.Contest``)."""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from hustings.operators.models import mean_accuracy
from hustings.plans import contest, history, template, web
from hustings.plans.outcome import Outcome
from hustings.sources.sinks import check_target


def report(outcome: Outcome) -> None:
    """Everything a workflow has to tell: what was read and left out, class balance, accuracy per fold and its mean, splits."""
    if outcome.counts:
        print(", ".join(f"{n} {what}" for what, n in outcome.counts.items()))
    outcome.left_out.show(truncate=False)
    for told in (outcome.balance, outcome.accuracy, outcome.accuracy if outcome.accuracy is None else mean_accuracy(outcome.accuracy), outcome.splits):
        if told is not None:
            told.show()


def main() -> None:
    parser = argparse.ArgumentParser(prog="hustings")
    parser.add_argument("--kind", choices=["xlsx", "csv"], default="xlsx", help="kind of result files")
    parser.add_argument("--mode", choices=["threshold", "argmax"], default="threshold", help="how outcomes are set")
    parser.add_argument("--overwrite", action="store_true", help="replace what an earlier run has written")
    parser.add_argument("--save-model", metavar="DIR", help="keep the fitted pipeline")
    parser.add_argument("--load-model", metavar="DIR", help="use a kept pipeline instead of fitting one")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, arguments in {"history": ["data", "out"], "template": ["data", "template", "out"], "web": ["pages", "out"], "contest": ["tables", "out"]}.items():
        command = commands.add_parser(name)
        for argument in arguments:
            command.add_argument(argument)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("hustings").getOrCreate()
    if args.command == "contest":
        contest.run(spark, args.tables, args.out, overwrite=args.overwrite).show()
        contest.suspected_copies(contest.read_contest(spark, args.tables)).orderBy("entry_id", "source_entry").show()
        return
    if args.save_model:
        check_target(spark, args.save_model)
    given = {"overwrite": args.overwrite, "model": PipelineModel.load(args.load_model) if args.load_model else None}
    if args.command == "history":
        outcome = history.process(spark, args.data, args.out, args.kind, args.mode, **given)
    elif args.command == "template":
        outcome = template.process(spark, args.data, args.template, args.out, args.kind, **given)
    else:
        outcome = web.process(spark.read.parquet(args.pages), args.out, args.mode, **given)
    if args.save_model:
        outcome.model.save(args.save_model)
    report(outcome)


if __name__ == "__main__":
    main()
