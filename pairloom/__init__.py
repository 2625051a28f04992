"""Preference-pair preparation on Spark."""

from pairloom.functions.preview import excerpt, shorten
from pairloom.functions.template import CHATML, INST, ChatTemplate
from pairloom.functions.text import (
    extract_prompt_and_responses,
    format_conversation,
    parse_conversation,
    reconstruct_conversation,
)
from pairloom.functions.tokens import Tokenizer, native_tokenizer, python_tokenizer
from pairloom.operators.assemble import assemble_conversations
from pairloom.operators.funnel import Funnel
from pairloom.operators.limits import first_prepared, first_rows
from pairloom.operators.mismatch import prompt_mismatch
from pairloom.operators.prepare import (
    prepare_both,
    prepare_for_dpo,
    prepare_for_sft,
    sft_text_from_pairs,
)
from pairloom.operators.split import create_train_val_split, with_hash_split, with_split
from pairloom.operators.statistics import (
    dataset_statistics,
    get_dataset_statistics,
    observe_statistics,
)
from pairloom.sources.pairs import ingest_pairs, load_pairs, open_pairs, stream_pairs
from pairloom.sources.prepared import load_preference_data, load_training_text
from pairloom.sources.writers import (
    read_keyed,
    save_paths,
    write_formats,
    write_json,
    write_keyed,
)
from pairloom.streaming.job import job_counts, job_output, start_job
from pairloom.streaming.prepare import start_preparation

__all__ = [
    "CHATML",
    "INST",
    "ChatTemplate",
    "Funnel",
    "Tokenizer",
    "assemble_conversations",
    "create_train_val_split",
    "dataset_statistics",
    "excerpt",
    "extract_prompt_and_responses",
    "first_prepared",
    "first_rows",
    "format_conversation",
    "get_dataset_statistics",
    "ingest_pairs",
    "job_counts",
    "job_output",
    "load_pairs",
    "load_preference_data",
    "load_training_text",
    "native_tokenizer",
    "observe_statistics",
    "open_pairs",
    "parse_conversation",
    "prepare_both",
    "prepare_for_dpo",
    "prepare_for_sft",
    "prompt_mismatch",
    "python_tokenizer",
    "read_keyed",
    "reconstruct_conversation",
    "save_paths",
    "sft_text_from_pairs",
    "shorten",
    "start_job",
    "start_preparation",
    "stream_pairs",
    "with_hash_split",
    "with_split",
    "write_formats",
    "write_json",
    "write_keyed",
]
