"""spark-submit entry: `train` on a folder of source tables, `score` a CSV file."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cohortflow.functions.columns import TARGET
from cohortflow.functions.expressions import as_column
from cohortflow.operators.cohort import build_cohort
from cohortflow.plans.workflow import (
    Scorer,
    TrainingRun,
    add_synthetic_rows,
    choose_features,
    clean_and_shape,
    encode_features,
    numbered_synthetic,
    score_file,
    with_chosen_levels,
)
from cohortflow.sources.scratch import ScratchScope, materialize
from cohortflow.sources.tables import configure_storage, read_source_tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cohortflow")
    top.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="storage setting, repeatable")
    commands = top.add_subparsers(dest="command", required=True)
    train = commands.add_parser("train")
    train.add_argument("--tables", required=True, help="folder with the six CSV tables")
    train.add_argument("--output", required=True, help="folder for model, scaler, metrics, features")
    train.add_argument("--target", default=TARGET)
    train.add_argument("--synthetic", type=int, default=5000)
    train.add_argument("--leakage", nargs="*", default=["discharge_location"])
    train.add_argument("--key", nargs="*", default=["hadm_id", "icustay_id"], help="columns that identify a row")
    train.add_argument("--group", help="column whose rows stay on one side of the split, such as subject_id")
    score = commands.add_parser("score")
    score.add_argument("--model", required=True)
    score.add_argument("--features", required=True)
    score.add_argument("--scaler", required=True, help="saved feature specification with scaling")
    score.add_argument("--preprocess", help="saved preprocessing; the one kept with the feature specification otherwise")
    score.add_argument("--input_csv", required=True)
    score.add_argument("--output", required=True)
    score.add_argument("--target", default=TARGET)
    score.add_argument("--no-evaluate", action="store_true")
    return top


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    scope = ScratchScope(spark)
    with scope:
        cohort = build_cohort(read_source_tables(spark, args.tables))
        wanted = [*args.key, *([args.group] if args.group else [])]
        keep = list(dict.fromkeys(c for c in wanted if c in cohort.columns))
        spec, shaped = clean_and_shape(cohort, keep)
        extended = materialize(add_synthetic_rows(shaped, args.synthetic, skip=keep), "extended")
        if keep:  # a synthetic row is a row and a group of its own
            extended = numbered_synthetic(extended, keep)
        encoded, levels, features = encode_features(extended, args.target, args.leakage, keep)
        encoded = materialize(encoded, "encoded")
        key = [c for c in args.key if c in keep] or None
        chosen, _ = choose_features(encoded, features, args.target, key=key, levels=levels)
        encoded, levels = with_chosen_levels(encoded, levels, chosen)
        data = encoded.select(*[as_column(c) for c in [*keep, *chosen]], args.target, "is_synthetic")
        run = TrainingRun(spark, data, args.target, levels, key, args.group if args.group in keep else None)
    report = run.run(args.output, preprocess=spec)
    run.close()
    scope.delete()
    for table in ("metrics", "report", "confusion"):
        report[table].show(truncate=False)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    scorer = Scorer.from_parts(spark, args.model, args.features, args.scaler, args.preprocess)
    report = score_file(spark, scorer, args.input_csv, args.output, args.target, not args.no_evaluate)
    for table in ("metrics", "report", "confusion"):
        if table in report:
            report[table].show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("cohortflow").getOrCreate()
    configure_storage(spark, dict(c.split("=", 1) for c in args.conf))
    {"train": train, "score": score}[args.command](spark, args)


if __name__ == "__main__":
    main()
