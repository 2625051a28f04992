"""The preparation job: load, prepare, report, show, save.

    spark-submit --py-files pairloom.zip pairloom/plans/job.py \\
        --input <root> --format both --save_path <folder>/train.json

One narrow Spark job: both outputs come from one read and one parse of the pairs, and
statistics are collected while they are written, so nothing is cached.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.preview import excerpt, shorten
from pairloom.functions.tokens import Tokenizer
from pairloom.operators.limits import first_prepared
from pairloom.operators.prepare import only, prepare_both
from pairloom.operators.statistics import as_report, observe_formats, observe_statistics
from pairloom.sources.pairs import SPLITS, load_pairs
from pairloom.sources.writers import save_paths, write_formats, write_json
from pairloom.streaming.prepare import PREPARE

# How many characters of each column are shown.
RAW_SIZE = 500
TEXT_SIZES = {"sft": {"text": 500}, "dpo": {"prompt": 300, "chosen": 200, "rejected": 200}}
SAMPLE_SIZES = {"prompt": 100, "chosen": 50, "rejected": 50}


@dataclass(frozen=True)
class PrepareConfig:
    input: str
    split: str = "train"
    subset: str | None = None
    max_samples: int | None = None
    format: str = "both"
    save_path: str | None = None
    show_examples: int = 3
    file_format: str = "json"
    keep_row_id: bool = True
    tokenizer: Tokenizer | None = None

    @property
    def outputs(self) -> tuple[str, ...]:
        return ("sft", "dpo") if self.format == "both" else (self.format,)


@dataclass
class PrepareReport:
    loaded: int = 0
    raw_sample: str | None = None
    statistics: dict[str, dict[str, Any]] = field(default_factory=dict)
    examples: dict[str, list[Row]] = field(default_factory=dict)
    saved: dict[str, str] = field(default_factory=dict)


def shown(prepared: DataFrame, kind: str) -> DataFrame:
    """`row_id` and the shortened text columns of an example."""
    sizes = TEXT_SIZES[kind]
    return prepared.select("row_id", *[shorten(F.col(c), n).alias(c) for c, n in sizes.items()])


def sampled(prepared: DataFrame) -> DataFrame:
    """The short form the preference reader shows of a pair."""
    cut: list[Column] = [excerpt(F.col(c), n).alias(c) for c, n in SAMPLE_SIZES.items()]
    return prepared.select("row_id", *cut)


def run_prepare(spark: SparkSession, config: PrepareConfig) -> PrepareReport:
    if config.format not in (*PREPARE, "both"):
        raise ValueError(f"format must be sft, dpo or both, not {config.format!r}")
    report = PrepareReport()

    def load(max_samples: int | None) -> DataFrame:
        return load_pairs(
            spark,
            config.input,
            config.split,
            config.subset,
            max_samples,
            file_format=config.file_format,
        ).drop("subset", "split")

    def prepare(df: DataFrame, kind: str) -> DataFrame:
        return PREPARE[kind](df, config.tokenizer)

    columns = ["chosen"] if config.format == "sft" else ["chosen", "rejected"]
    read = Observation()
    pairs = load(config.max_samples).select("row_id", *columns)
    pairs = pairs.observe(read, F.count(F.lit(1)).alias("rows"))
    if config.max_samples != 0:
        raw = load(1).select(excerpt(F.col("chosen"), RAW_SIZE)).first()
        report.raw_sample = raw[0] if raw else None
    paths = save_paths(config.save_path, config.format) if config.save_path else {}
    if config.format == "both":
        both, statistics = observe_formats(prepare_both(pairs, config.tokenizer))
        prepared = {kind: only(both, kind) for kind in config.outputs}
        if paths:
            write_formats(both, paths, keep_row_id=config.keep_row_id)
        else:
            both.write.format("noop").mode("overwrite").save()
    else:
        kind = config.format
        table, observed = observe_statistics(prepare(pairs, kind), kind)
        prepared, statistics = {kind: table}, {kind: observed}
        if paths:
            write_json(table, paths[kind], keep_row_id=config.keep_row_id)
        else:
            table.write.format("noop").mode("overwrite").save()
    report.loaded, report.saved = read.get["rows"], dict(paths)
    for kind in config.outputs:
        report.statistics[kind] = as_report(prepared[kind], statistics[kind].get)
        rows = first_prepared(
            load,
            lambda df, kind=kind: shown(prepare(df, kind), kind),
            config.show_examples,
            most=config.max_samples,
        )
        report.examples[kind] = rows.collect()
    return report


def lines(report: PrepareReport) -> list[str]:
    """The report as text, with means as whole numbers."""
    out = [f"loaded {report.loaded} pairs", f"first chosen: {report.raw_sample}"]
    for kind, stats in report.statistics.items():
        out.append(f"{kind}: {stats['num_examples']} rows, columns {', '.join(stats['columns'])}")
        for name, value in stats.items():
            if name.endswith("_length") and value["mean"] is not None:
                out.append(f"  {name}: mean {value['mean']:.0f}, {value['min']} to {value['max']}")
        for number, row in enumerate(report.examples[kind], 1):
            for column, value in row.asDict().items():
                out.append(f"  example {number} {column}: {value}")
        if kind in report.saved:
            out.append(f"  saved to {report.saved[kind]}")
    return out


def parse_args(argv: list[str] | None = None) -> PrepareConfig:
    parser = argparse.ArgumentParser(description="Prepare preference pairs for training")
    parser.add_argument("--input", required=True, help="root folder of the pair files")
    parser.add_argument("--split", choices=SPLITS, default="train")
    parser.add_argument("--subset", help="one subset folder; all by default")
    parser.add_argument("--max_samples", type=int)
    parser.add_argument("--format", choices=(*PREPARE, "both"), default="both")
    parser.add_argument("--save_path")
    parser.add_argument("--show_examples", type=int, default=3)
    parser.add_argument("--file_format", choices=("json", "parquet"), default="json")
    parser.add_argument("--no_row_id", dest="keep_row_id", action="store_false")
    return PrepareConfig(**vars(parser.parse_args(argv)))


def main(argv: list[str] | None = None) -> None:
    config = parse_args(argv)
    spark = SparkSession.builder.appName("pairloom-prepare").getOrCreate()
    print("\n".join(lines(run_prepare(spark, config))))


if __name__ == "__main__":
    main()
