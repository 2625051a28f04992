"""Raw pairs out of a table of turns: the input of the registered queries.

The provided `conversations` table holds one row per turn, while preparation
starts from whole conversations side by side. This builds them, once, and
stores them; it is input preparation, not an operator of the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.functions.binding import bind_columns
from pairloom.operators.assemble import assemble_conversations
from pairloom.session import scratch_dir

def pairs_from_turns(turns: DataFrame) -> DataFrame:
    """`row_id, chosen, rejected`; the rejected reply is the next conversation's.

    A conversation without a next one keeps its own reply.
    """
    whole = assemble_conversations(turns)
    sides = bind_columns(
        whole, ["conv_id", "chosen"], parsed=T.format_conversation(F.col("chosen"))
    )
    # Both join sides share the shuffles that assemble the conversations. They
    # do as long as their plans are alike: a key that may be null would bring
    # its own null filter to this side.
    before = F.coalesce("conv_id", F.lit(0)) - 1
    other = whole.select(before.alias("conv_id"), T.last_response(F.col("chosen")).alias("other"))
    rejected = F.concat(
        F.lit(T.BLANK_LINE), "parsed.prompt", F.lit(T.BLANK_LINE + T.ASSISTANT + " "),
        F.coalesce("other", "parsed.response"),
    )
    return sides.join(other, "conv_id", "left").select(
        F.col("conv_id").alias("row_id"), "chosen", rejected.alias("rejected")
    )


def edge_pairs(pairs: DataFrame) -> DataFrame:
    """The same rows, with `chosen` bent in eight ways so that edge cases occur."""
    text = F.col("chosen")
    bare = T.strip(text)

    def breaks(by: str) -> Column:
        return F.replace(text, F.lit(T.BLANK_LINE), F.lit(by))

    lowered = F.replace(
        F.replace(text, F.lit(T.HUMAN), F.lit("human:")), F.lit(T.ASSISTANT), F.lit("assistant:")
    )
    bent = [
        text,
        F.concat(F.lit("preamble\n\n"), bare),
        F.concat(text, F.lit("\n\nHuman: trailing")),
        breaks("\n\n\n\n"),
        lowered,
        breaks("\r\n\r\n"),
        F.concat(text, F.lit("\n\nAssistant:")),
        F.concat(F.lit(" 　"), text, F.lit(" 　\u001c")),
    ]
    kind = F.pmod(F.col("row_id"), F.lit(len(bent)))
    chosen = F.lit(None).cast("string")
    for number, value in enumerate(bent):
        chosen = F.when(kind == number, value).otherwise(chosen)
    return pairs.withColumn("chosen", chosen)


_stored: dict[tuple[str, str], str] = {}


def stored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the given tables, assembled and written once per application.

    Later queries then are plain columnar scans, as over an ingested table.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_dir(spark) + "/pairs"
        pairs_from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")).write.parquet(path)
        _stored[key] = path
    return spark.read.schema("row_id bigint, chosen string, rejected string").parquet(_stored[key])
