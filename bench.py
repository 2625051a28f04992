"""Time the headline queries and print one JSON line.

Two parts: every registered query named in QUERIES over the tables of
$BENCH_SF_DIR, and the main operators over the same pairs repeated to about
$BENCH_PAIRS rows, where throughput rather than job overhead shows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import pairloom as P  # noqa: E402
from pairloom.plans import catalog  # noqa: E402
from pairloom.plans.fixtures import pairs_from_turns, stored_pairs  # noqa: E402
from pairloom.session import local_session, scratch_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PAIRS = int(os.environ.get("BENCH_PAIRS", "170000"))

QUERIES = (
    "prepare_dpo prepare_sft prepare_sft_chat dpo_length_filter sft_length_filter parse_messages "
    "extract_pair chat_render token_count token_count_documents stats_sft stats_dpo max_samples "
    "max_samples_per_split preview_dpo split_exact split_counts load_pairs json_roundtrip "
    "trainer_sft stream_dpo dpo_length_hook prompt_mismatch split_hash trainer_dpo_extra job_stream"
).split()


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def second_run(action: Callable[[], object]) -> float:
    """The first run compiles and stores the input; the second is reported."""
    action()
    return timed(action)


def repeated_pairs(spark: SparkSession, rows: int) -> DataFrame:
    """The stored pairs, as many times as it takes, written once."""
    pairs = stored_pairs(spark, SF_DIR)
    times = max(1, round(rows / pairs.count()))
    copies = pairs.repartition(int(CPUS) * 4).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    )
    path = scratch_dir(spark) + "/repeated"
    copies.select(
        (F.col("row_id") * times + F.col("copy")).alias("row_id"), "chosen", "rejected"
    ).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    spark = local_session("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    registered = catalog.queries()
    drain(registered["prepare_dpo"](spark, SF_DIR))  # starts the JVM and stores the pairs

    raw = catalog.pair_files(spark, SF_DIR)
    seconds = {
        "assemble": second_run(lambda: drain(pairs_from_turns(turns))),
        "ingest_pairs": second_run(lambda: P.ingest_pairs(spark, raw, scratch_dir(spark))),
    }
    for name in QUERIES:
        seconds[name] = second_run(lambda name=name: drain(registered[name](spark, SF_DIR)))

    big = repeated_pairs(spark, PAIRS)
    count = big.count()
    native = P.native_tokenizer()
    at_scale = {
        "prepare_dpo": lambda: drain(P.prepare_for_dpo(big)),
        "prepare_dpo_lengths": lambda: drain(P.prepare_for_dpo(big, native)),
        "prepare_sft": lambda: drain(P.prepare_for_sft(big)),
        "prepare_sft_chat": lambda: drain(P.prepare_for_sft(big, native)),
        "stats_dpo": lambda: P.get_dataset_statistics(P.prepare_for_dpo(big)),
        "first_half": lambda: drain(P.first_rows(big, count // 2)),
        "split": lambda: drain(P.with_split(big)),
        "prepare_both": lambda: drain(P.prepare_both(big)),
        "hash_split": lambda: drain(P.with_hash_split(big)),
        "write_dpo_json": lambda: P.write_json(
            P.prepare_for_dpo(big), scratch_dir(spark) + "/dpo.json"
        ),
    }
    rates = {}
    for name, action in at_scale.items():
        seconds[f"repeated_{name}"] = second_run(action)
        rates[name] = round(count / seconds[f"repeated_{name}"])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
                "repeated_pairs": count,
                "pairs_per_second": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
