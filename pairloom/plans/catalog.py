"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.functions.binding import bind_columns
from pairloom.functions.preview import excerpt
from pairloom.functions.template import INST
from pairloom.functions.tokens import native_tokenizer, python_tokenizer
from pairloom.operators.assemble import assemble_conversations
from pairloom.operators.funnel import Funnel
from pairloom.operators.limits import first_prepared, first_rows
from pairloom.operators.mismatch import prompt_mismatch
from pairloom.operators.prepare import prepare_for_dpo, prepare_for_sft, sft_text_from_pairs
from pairloom.operators.split import VALIDATION, with_hash_split, with_split
from pairloom.operators.statistics import dataset_statistics
from pairloom.plans.fixtures import edge_pairs, stored_pairs
from pairloom.plans.job import RAW_SIZE, PrepareConfig, PrepareReport, run_prepare, sampled, shown
from pairloom.session import scratch_dir
from pairloom.sources.pairs import SPLITS, ingest_pairs, load_pairs, open_pairs, stream_pairs
from pairloom.sources.prepared import load_preference_data, load_training_text
from pairloom.sources.writers import read_keyed, write_json, write_keyed
from pairloom.streaming.job import job_output, start_job
from pairloom.streaming.prepare import start_preparation

Query = Callable[[SparkSession, str], DataFrame]

# Limits tight enough that the length filters drop rows of the given tables.
MAX_LENGTH, MAX_PROMPT_LENGTH = 300, 100
NATIVE = native_tokenizer()
# Another template, and two marker tokens for each text that is counted.
MARKED = native_tokenizer(INST, special_per_call=2)


def _plain_python_tokenizer():
    """A tokenizer object like the ones users bring, for the Python hooks.

    Defined in place, so that workers need no module of this package for it.
    """

    def load():
        import re

        token = re.compile("[^ \t\n\r\f\v]+")

        def ids(texts, truncation):
            return {"input_ids": [token.findall(t) for t in texts]}

        def chat(messages, tokenize, add_generation_prompt):
            parts = [f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in messages]
            return "".join(parts) + ("<|im_start|>assistant\n" if add_generation_prompt else "")

        class Plain:
            __call__ = staticmethod(ids)
            apply_chat_template = staticmethod(chat)

        return Plain()

    return python_tokenizer(load)


def _table(name: str) -> Query:
    return lambda spark, sf: spark.read.parquet(f"{sf}/{name}.parquet")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return edge_pairs(stored_pairs(spark, sf))


def _over(source: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = source(spark, sf)
        for step in steps:
            df = step(df)
        return df

    return run


def _flat(sft: DataFrame) -> DataFrame:
    """Messages as one text per row, for comparison by value."""
    items = F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return sft.withColumn("messages", F.array_join(items, chr(30)))


def _messages(df: DataFrame) -> DataFrame:
    exploded = df.select("row_id", F.posexplode(T.parse_conversation(F.col("chosen"))))
    return exploded.select("row_id", F.col("pos").cast("bigint").alias("pos"), "col.role", "col.content")


def _of_chosen(function: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select("row_id", function(F.col("chosen")).alias("text"))


def _rendered(tokenizer, generation: bool = False) -> Callable[[DataFrame], DataFrame]:
    return _of_chosen(lambda c: tokenizer.render(T.parse_conversation(c), generation))


def _prompt_response(df: DataFrame) -> DataFrame:
    return bind_columns(df, ["row_id"], p=T.format_conversation(F.col("chosen"))).select("row_id", "p.*")


def _extracted(df: DataFrame) -> DataFrame:
    pair = T.extract_prompt_and_responses(F.col("chosen"), F.col("rejected"))
    return bind_columns(df, ["row_id"], p=pair).select("row_id", "p.*")


def _empty(df: DataFrame) -> DataFrame:
    found = _extracted(df).where(
        (F.length("chosen_response") == 0) | (F.length("rejected_response") == 0)
    )
    return found.withColumnsRenamed({"chosen_response": "chosen", "rejected_response": "rejected"})


def _token_counts(df: DataFrame) -> DataFrame:
    columns = ("prompt", "chosen", "rejected")
    return df.select("row_id", *[NATIVE.count(F.col(c)).alias(f"{c}_tokens") for c in columns])


def _split_counts(df: DataFrame) -> DataFrame:
    return with_split(df).groupBy("split").agg(F.count("*").alias("rows"))


# The raw files: one folder per subset and split, told apart by content.
SUBSETS = ("short", "long")


def _with_nulls(df: DataFrame) -> DataFrame:
    """The same pairs, every fifth without `chosen` and every seventh without `rejected`."""

    def missing(column: str, step: int) -> Column:
        return F.when(F.pmod("row_id", F.lit(step)) != 0, F.col(column))

    return df.withColumns({"chosen": missing("chosen", 5), "rejected": missing("rejected", 7)})


def _place(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "subset": F.when(F.length("chosen") > 2500, F.lit("long")).otherwise(F.lit("short")),
            "split": F.when(F.col("chosen") < F.col("rejected"), F.lit("test")).otherwise(
                F.lit("train")
            ),
        }
    )


_laid_out: dict[tuple[str, str], str] = {}


def pair_files(spark: SparkSession, sf: str) -> str:
    """All pairs as raw JSON files in row order, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _laid_out:
        root = scratch_dir(spark)
        placed = _place(stored_pairs(spark, sf))
        for subset in SUBSETS:
            for split in SPLITS:
                part = placed.where((F.col("subset") == subset) & (F.col("split") == split))
                ordered = part.repartitionByRange("row_id").sortWithinPartitions("row_id")
                ordered.select("chosen", "rejected").write.json(f"{root}/{subset}/{split}")
        _laid_out[key] = root
    return _laid_out[key]


def _loaded(**choice) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        pairs = load_pairs(spark, pair_files(spark, sf), **choice)
        return pairs.select("chosen", "rejected", "subset", "split")

    return run


_ingested: dict[tuple[str, str], str] = {}


def _opened(spark: SparkSession, sf: str) -> DataFrame:
    """The raw files, staged once per application and opened again for each query."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ingested:
        target = scratch_dir(spark)
        ingest_pairs(spark, pair_files(spark, sf), target)
        _ingested[key] = target
    return open_pairs(spark, _ingested[key])


def _streamed(kind: str, schema_of: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        root = scratch_dir(spark)
        pairs = stream_pairs(spark, pair_files(spark, sf))
        query = start_preparation(pairs, kind, f"{root}/out", f"{root}/checkpoint", keep=[])
        query.awaitTermination()
        schema = schema_of(stored_pairs(spark, sf)).schema
        return spark.read.schema(schema).json(f"{root}/out")

    return run


_reports: dict[tuple[str, str], PrepareReport] = {}


def _job(spark: SparkSession, sf: str) -> PrepareReport:
    """The whole job over the raw training files, run once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _reports:
        target = f"{scratch_dir(spark)}/train.json"
        _reports[key] = run_prepare(spark, PrepareConfig(pair_files(spark, sf), save_path=target))
    return _reports[key]


def _saved(kind: str, schema: str) -> Query:
    return lambda spark, sf: spark.read.schema(schema).json(_job(spark, sf).saved[kind])


def _job_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics of the report, a row per format and measured column."""
    rows = []
    for kind, report in _job(spark, sf).statistics.items():
        for name, value in report.items():
            if name.endswith("_length"):
                of = (kind, name.removesuffix("_length"), report["num_examples"])
                rows.append((*of, value["mean"], value["min"], value["max"]))
    schema = "format string, column string, num_examples bigint, mean double, min bigint, max bigint"
    return spark.createDataFrame(rows, schema)


def _job_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables of a streamed job, in batches of three files."""
    root = scratch_dir(spark)
    pairs = stream_pairs(spark, pair_files(spark, sf), files_per_trigger=3)
    start_job(pairs, f"{root}/out", f"{root}/checkpoint", keep=[]).awaitTermination()
    sft, dpo = [job_output(spark, f"{root}/out", kind) for kind in ("sft", "dpo")]
    none = F.lit(None).cast("string")
    sft = _flat(sft).withColumns({c: none for c in dpo.columns})
    dpo = dpo.withColumns({"text": none, "messages": none})
    return sft.withColumn("format", F.lit("sft")).unionByName(dpo.withColumn("format", F.lit("dpo")))


def _funnel(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of the rows while the table is written."""
    funnel = Funnel()
    prepared = prepare_for_dpo(edges(spark, sf), NATIVE, MAX_LENGTH, MAX_PROMPT_LENGTH, funnel=funnel)
    write_json(prepared, f"{scratch_dir(spark)}/dpo.json")
    counts = funnel.get
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


def _split_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The validation side, after both sides were written in one pass."""
    path = f"{scratch_dir(spark)}/sides"
    write_keyed(with_split(prepare_for_dpo(stored_pairs(spark, sf))), path, "split")
    schema = "row_id bigint, prompt string, chosen string, rejected string"
    return read_keyed(spark, path, "split", VALIDATION, schema)


def _preview(source: Query, prepare: Callable[[DataFrame], DataFrame], n: int) -> Query:
    """The first n prepared rows, parsing only a start of the raw table."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        pairs = source(spark, sf)
        return first_prepared(lambda size: first_rows(pairs, size), prepare, n)

    return run


def _written(prepare: Callable[[DataFrame], DataFrame], source: Query, read) -> Query:
    """Prepare, save as JSON, and read back."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = f"{scratch_dir(spark)}/prepared.json"
        prepared = prepare(source(spark, sf))
        write_json(prepared, path)
        return read(spark, path, prepared)

    return run


def _with_extra(prepared: DataFrame) -> DataFrame:
    """Prepared pairs with further fields, of which one has a name that rows do not share."""
    kind = F.concat(F.lit("kind_"), F.pmod("row_id", F.lit(3)).cast("string"))
    size = F.parse_json(F.length("prompt").cast("string"))
    return prepared.withColumn(
        "extra", F.create_map(F.lit("size"), size, kind, F.parse_json(F.lit('{"a": [1, null]}')))
    )


def _read_extra(spark: SparkSession, path: str, _: DataFrame) -> DataFrame:
    return load_preference_data(spark, path, "variant").withColumn("extra", F.to_json("extra"))


def _read_declared(spark: SparkSession, path: str, prepared: DataFrame) -> DataFrame:
    return spark.read.schema(prepared.schema).json(path)


def queries() -> dict[str, Query]:
    plain, hook = stored_pairs, _plain_python_tokenizer()

    def sft(*args, **options):
        return lambda df: prepare_for_sft(df, *args, **options)

    def dpo(*args, **options):
        return lambda df: prepare_for_dpo(df, *args, **options)

    def ordered_first(n: int) -> Callable[[DataFrame], DataFrame]:
        return lambda df: first_rows(df, n)

    documents = _table("documents")
    return {
        # Sources and sinks
        "load_pairs": _loaded(),
        "load_subset": _loaded(subset="long"),
        "load_split": _loaded(split="test"),
        "load_max_samples": _loaded(subset="short", split="train", max_samples=12),
        "ingest_pairs": _opened,
        "split_loaded": _over(_opened, dpo(), with_split),
        "pair_count": _over(plain, lambda df: df.agg(F.count("*").alias("pairs"))),
        "json_roundtrip": _written(dpo(), edges, _read_declared),
        "json_roundtrip_sft": _over(_written(sft(), edges, _read_declared), _flat),
        "trainer_sft": _written(dpo(), plain, lambda spark, path, _: load_training_text(spark, path)),
        "trainer_dpo": _written(
            dpo(), plain, lambda spark, path, _: load_preference_data(spark, path)
        ),
        "trainer_dpo_extra": _written(lambda df: _with_extra(prepare_for_dpo(df)), plain, _read_extra),
        "stream_sft": _over(_streamed("sft", sft(keep=[])), _flat),
        "stream_dpo": _streamed("dpo", dpo(keep=[])),
        # Projections
        "assemble": _over(_table("conversations"), assemble_conversations),
        "parse_messages": _over(plain, _messages),
        "parse_messages_edge": _over(edges, _messages),
        "prompt_response": _over(plain, _prompt_response),
        "prompt_response_edge": _over(edges, _prompt_response),
        "reconstruct": _over(
            plain, _of_chosen(lambda c: T.reconstruct_conversation(T.parse_conversation(c)))
        ),
        "reconstruct_edge": _over(
            edges, _of_chosen(lambda c: T.reconstruct_conversation(T.parse_conversation(c)))
        ),
        "extract_pair": _over(plain, _extracted),
        "extract_pair_edge": _over(edges, _extracted),
        "chat_render": _over(edges, _rendered(NATIVE)),
        "chat_render_generation": _over(edges, _rendered(NATIVE, True)),
        "chat_render_inst": _over(edges, _rendered(MARKED)),
        "chat_render_hook": _over(edges, _rendered(hook)),
        "prepare_sft": _over(plain, sft(), _flat),
        "prepare_sft_edge": _over(edges, sft(), _flat),
        "prepare_sft_chat": _over(edges, sft(NATIVE), _flat),
        "prepare_dpo": _over(plain, dpo()),
        "prepare_dpo_edge": _over(edges, dpo()),
        "prepare_sft_nulls": _over(edges, _with_nulls, sft(on_null="drop"), _flat),
        "prepare_dpo_nulls": _over(edges, _with_nulls, dpo(on_null="drop")),
        "sft_text_from_pairs": _over(edges, dpo(), sft_text_from_pairs),
        # Filters
        "dropped_empty": _over(edges, _empty),
        "sft_length_filter": _over(edges, sft(NATIVE, MAX_LENGTH, use_chat_template=False), _flat),
        "sft_chat_length_filter": _over(edges, sft(NATIVE, MAX_LENGTH), _flat),
        "sft_special_length_filter": _over(edges, sft(MARKED, MAX_LENGTH), _flat),
        "dpo_special_length_filter": _over(edges, dpo(MARKED, MAX_LENGTH, MAX_PROMPT_LENGTH)),
        "dpo_length_filter": _over(edges, dpo(NATIVE, MAX_LENGTH, MAX_PROMPT_LENGTH)),
        "dpo_length_noprompt": _over(edges, dpo(NATIVE, MAX_LENGTH, None)),
        "dpo_length_off": _over(edges, dpo(NATIVE, None, MAX_PROMPT_LENGTH)),
        "dpo_length_hook": _over(edges, dpo(hook, MAX_LENGTH, MAX_PROMPT_LENGTH)),
        "token_count": _over(plain, dpo(), _token_counts),
        "token_count_documents": _over(
            documents, lambda df: df.select("doc_id", NATIVE.count(F.col("text")).alias("tokens"))
        ),
        # Aggregates
        "stats_raw": _over(plain, dataset_statistics),
        "stats_sft": _over(edges, sft(), dataset_statistics),
        "stats_dpo": _over(edges, dpo(), dataset_statistics),
        "stats_documents": _over(documents, lambda df: dataset_statistics(df.select("text"))),
        # First rows, previews, split
        "max_samples": _over(plain, ordered_first(40)),
        "max_samples_per_split": _over(
            plain, lambda df: first_rows(_place(df).drop("subset"), 15, splits=SPLITS)
        ),
        "preview_raw": _over(
            plain,
            ordered_first(1),
            lambda df: df.select("row_id", excerpt(F.col("chosen"), RAW_SIZE).alias("chosen")),
        ),
        "preview_sft": _preview(edges, lambda df: shown(prepare_for_sft(df), "sft"), 3),
        "preview_dpo": _preview(edges, lambda df: shown(prepare_for_dpo(df), "dpo"), 3),
        "preview_trainer_dpo": _preview(plain, lambda df: sampled(prepare_for_dpo(df)), 1),
        "split_exact": _over(plain, dpo(), lambda df: with_split(df).select("row_id", "split")),
        "split_counts": _over(
            plain, dpo(), _split_counts
        ),
        "split_other_seed": _over(
            plain, dpo(), lambda df: with_split(df, 0.3, seed=7).select("row_id", "split")
        ),
        "split_rows": _over(plain, dpo(), lambda df: with_split(df, 17).select("row_id", "split")),
        "split_hash": _over(plain, dpo(), lambda df: with_hash_split(df).select("row_id", "split")),
        "split_saved": _split_saved,
        # Reports and the job
        "prompt_mismatch": _over(edges, prompt_mismatch),
        "funnel": _funnel,
        "job_sft": _over(_saved("sft", f"text string, messages {T.MESSAGES_TYPE}"), _flat),
        "job_dpo": _saved("dpo", "prompt string, chosen string, rejected string"),
        "job_stats": _job_statistics,
        "job_stream": _job_streamed,
        "entry": _over(plain, dpo()),
    }
