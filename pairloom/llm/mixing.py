"""Mixing sources to target weights by Efraimidis-Spirakis sampling, all in native columns.

Each source gets a token target by its weight, at most so many passes over it.
Whole passes come first; the rest of a target is sampled without replacement:
every document draws the exponential key -ln(u) / quality, and documents are
taken in key order until their sizes reach the rest. No source is ever sorted in
one task: sizes are summed by leading digits of the key, twice, and only the
documents that share all digits with the border are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch

_LEAST_QUALITY = 1e-6
_DIGITS = (10, 20)  # bits of the key after the point that the two rounds look at


def word_count(text: Column) -> Column:
    """Words of a text: runs of characters other than space and 09-0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sampling_key(key: Column, quality: Column, seed: str) -> Column:
    """-ln(u) / quality, u from a hash of seed and key: the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double")
    weight = F.greatest(F.coalesce(quality, F.lit(_LEAST_QUALITY)), F.lit(_LEAST_QUALITY))
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def _digits(bits: int) -> Column:
    return F.floor(F.col("draw") * float(1 << bits)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, passes: float
) -> DataFrame:
    """(source, source_size, target): weights go round the sources by code point, null last.

    A target stops at `passes` times its source's size; what is over goes to the
    other sources by weight until none is above. In order of limit per weight the
    sources that stop come first, so running sums give the final level at once.
    One row per source: the windows are as small as the list of sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * float(passes))
    )
    all_rows = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(all_rows) * float(share)
    ranked = ranked.withColumn(
        "level",
        (total - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("stops", F.col("most") / F.col("weight") <= F.col("level"))
    first_open = F.struct(F.col("most") / F.col("weight"), F.col("place"), F.col("level"))
    level = F.min(F.when(~F.col("stops"), first_open)).over(all_rows)["level"]
    target = F.when(F.col("stops"), F.col("most")).otherwise(level * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _border(sums: DataFrame, sources: DataFrame, digit: str) -> DataFrame:
    """Per source the digits at which its running size passes the rest, and the size before."""
    run = Window.partitionBy("source").orderBy(digit)
    return (
        sums.withColumn("after", F.sum("s").over(run))
        .join(sources.withColumnRenamed("source", "src"), F.expr("source <=> src"))
        .withColumn("before", F.col("base") + F.col("after") - F.col("s"))
        .where("before <= rest AND rest < base + after")
        .select("source", digit, "before")
    )


def mixing_plan(
    sized: DataFrame, scratch: Scratch, weights: tuple[float, ...], share: float, passes: float
) -> DataFrame:
    """One row per source: its size and target, whole passes, and the border of the rest."""
    targets = source_targets(sized, weights, share, passes)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = scratch.put(
        targets.withColumn("whole", whole.cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("base", F.lit(0.0)),
        "sources",
    )
    high, low = (_digits(bits) for bits in _DIGITS)
    sums = sized.groupBy("source", high.alias("high")).agg(F.sum("size").alias("s"))
    first = scratch.put(_border(sums, sources, "high"), "first")
    keys = F.expr("source <=> src")
    near = sized.join(first.withColumnRenamed("source", "src"), keys).where(high == F.col("high"))
    sums = near.groupBy("source", low.alias("low")).agg(F.sum("size").alias("s"))
    based = sources.drop("base").join(
        first.select(F.col("source").alias("src"), F.col("before").alias("base"), "high"), keys
    )
    second = scratch.put(_border(sums, based.drop("src"), "low"), "second")
    last = sized.join(second.withColumnRenamed("source", "src"), keys).where(low == F.col("low"))
    run = Window.partitionBy("source").orderBy("draw", "tie")
    middle = F.col("before") + F.sum("s").over(run) - F.col("s") / 2
    cut = (
        last.groupBy("source", "before", "draw", "tie")
        .agg(F.sum("size").alias("s"))
        .withColumn("middle", middle)
        .join(sources.select(F.col("source").alias("src"), "rest"), keys)
        .where("middle <= rest")
        .groupBy("source")
        .agg(F.max(F.struct("draw", "tie")).alias("cut"))
    )

    def also(plan: DataFrame, more: DataFrame) -> DataFrame:
        return plan.join(more.withColumnRenamed("source", "src"), keys, "left").drop("src")

    plan = also(sources.drop("base"), first.select("source", "high"))
    return scratch.put(also(also(plan, second.select("source", "low")), cut), "plan")


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: DataFrame | Column | None = None,
    columns: list[str] | None = None,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    passes: float = 2,
    seed: str = "mix",
) -> DataFrame:
    """All rows of docs with size, source_size, target, taken and copies.

    size is the number of words (null text: 0); taken is copies times size. The
    draw of a document depends on seed and key alone, so reruns agree; rows of one
    key have one draw and are taken together, as are rows with a null key. quality
    scales the draws: a column of docs, or a table (id, weight; one row per id) that
    is joined after the texts are counted; a document it lacks weighs 1, a weight
    that is null or not positive next to nothing. columns: those of docs to return,
    all if not given; with a table of weights, name no wide ones. The last document of a
    source is taken if that brings the source nearer to its target. Sources of
    size 0 get nothing, an empty table gives an empty result. Columns of docs with
    the names of the result are replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    added = ["size", "source_size", "target", "taken", "copies"]
    if columns is None:
        columns = [c for c in docs.columns if c not in added or c in (key, source)]
    tie = F.coalesce(F.col(key).cast("string"), F.lit(""))
    facts = docs.select(
        *columns, F.col(source).alias("__from"), word_count(F.col(text)).alias("__size"), tie.alias("__tie"),
        F.col(key).alias("__key"), (quality if isinstance(quality, Column) else F.lit(1.0)).alias("__weigh"),
    )
    if isinstance(quality, DataFrame):
        table = quality.select(F.col("id").alias("__id"), F.col("weight").cast("double").alias("__weight"))
        weigh = F.when(F.col("__id").isNull(), F.lit(1.0)).otherwise(F.col("__weight"))
        facts = facts.join(table, F.col("__key") == F.col("__id"), "left").withColumn("__weigh", weigh)
    draw = sampling_key(F.col("__key"), F.col("__weigh"), seed)
    staged = scratch.put(facts.select(*columns, "__from", "__size", "__tie", draw.alias("__draw")), "sized")
    sized = staged.select(
        F.col("__from").alias("source"), *[F.col(f"__{n}").alias(n) for n in ("size", "draw", "tie")]
    )
    plan = mixing_plan(sized, scratch, weights, share, passes)
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    digits = [F.floor(F.col("__draw") * float(1 << bits)).cast("long") for bits in _DIGITS]
    draw = F.struct(F.col("__draw").alias("draw"), F.col("__tie").alias("tie"))
    in_rest = (
        F.col("__high").isNull()
        | (digits[0] < F.col("__high"))
        | ((digits[0] == F.col("__high")) & (digits[1] < F.col("__low")))
        | ((digits[1] == F.col("__low")) & (draw <= F.col("__cut")))
    )
    copies = F.col("__whole") + F.coalesce(in_rest, F.lit(False)).cast("long")
    return staged.join(plan, F.col("__from").eqNullSafe(F.col("__source"))).select(
        *columns,
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (copies * F.col("__size")).alias("taken"),
        copies.alias("copies"),
    )


MIX_SQL = r"""
WITH quality AS (
    SELECT doc_id AS id, CASE WHEN avg(quality) >= 0.5 THEN 2.0 ELSE 0.5 END::DOUBLE AS w
    FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5)
            / 4503599627370496.0) / coalesce(w, 1.0) AS draw
    FROM documents LEFT JOIN quality ON doc_id = id
), sources AS (
    SELECT *, 2.0 * source_size AS most,
        [3.0, 1.0, 2.0][((place - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size,
            row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
        FROM sized GROUP BY source)
), levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most::DOUBLE) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, CASE WHEN most / weight <= level THEN most::DOUBLE ELSE weight *
        (SELECT level FROM levels WHERE most / weight > level ORDER BY most / weight, place LIMIT 1)
        END AS target
    FROM levels
), rest AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
)
SELECT doc_id, size, source_size, target,
    ((whole + (middle <= target - whole * source_size)::INT) * size)::BIGINT AS taken
FROM (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING)
        - size / 2.0 AS middle FROM sized) s
JOIN rest r ON s.source IS NOT DISTINCT FROM r.source
"""
