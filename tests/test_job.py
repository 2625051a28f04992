"""Both tables from one pass, counts on the way, and the job over a stream."""

import json

import pytest
from pyspark.sql import functions as F

import pairloom as P
from conftest import SF
from pairloom.operators.funnel import Funnel
from pairloom.operators.limits import first_prepared
from pairloom.operators.prepare import only, prepare_both
from pairloom.plans.catalog import MAX_LENGTH, MAX_PROMPT_LENGTH, NATIVE, _plain_python_tokenizer
from pairloom.plans.fixtures import edge_pairs, stored_pairs
from pairloom.sources.writers import read_keyed, write_formats, write_keyed
from pairloom.streaming import job as stream_job


@pytest.fixture(scope="module")
def edges(spark):
    odd = [(900, "", ""), (901, "no turns", "\n\nAssistant: r"), (902, "\n\nAssistant:", "\n\nAssistant: r")]
    more = spark.createDataFrame(odd, "row_id bigint, chosen string, rejected string")
    return edge_pairs(stored_pairs(spark, SF)).unionByName(more)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"tokenizer": NATIVE, "max_length": MAX_LENGTH, "max_prompt_length": MAX_PROMPT_LENGTH},
        {"tokenizer": NATIVE, "max_length": MAX_LENGTH, "max_prompt_length": None, "use_chat_template": False},
        {"tokenizer": NATIVE, "max_length": None},
        {"tokenizer": _plain_python_tokenizer(), "max_length": MAX_LENGTH},
    ],
)
def test_both_formats_equal_the_single_ones(edges, options):
    both = prepare_both(edges, **options)
    sft = {k: v for k, v in options.items() if k != "max_prompt_length"}
    dpo = {k: v for k, v in options.items() if k != "use_chat_template"}
    assert same(only(both, "sft"), P.prepare_for_sft(edges, **sft))
    assert same(only(both, "dpo"), P.prepare_for_dpo(edges, **dpo))


def test_both_formats_from_one_read_and_one_parse(spark, tmp_path):
    rows = [{"chosen": f"\n\nHuman: {k}?\n\nAssistant: {k}!", "rejected": "\n\nAssistant: no"} for k in range(50)]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "train.json").write_text("\n".join(map(json.dumps, rows)))
    text = plan(prepare_both(P.load_pairs(spark, str(tmp_path))))
    assert text.count("Scan json") == 1 and text.count("split(") == 1


def test_nulls_of_both_formats(spark):
    pairs = spark.createDataFrame(
        [(1, None, "\n\nAssistant: r"), (2, "\n\nAssistant: c", None), (3, None, None), (4, "\n\nAssistant: c", "\n\nAssistant: r")],
        "row_id bigint, chosen string, rejected string",
    )
    both = prepare_both(pairs, on_null="drop")
    assert sorted((r.row_id, r.format) for r in both.collect()) == [(2, "sft"), (4, "dpo"), (4, "sft")]
    with pytest.raises(Exception, match="holds a null"):
        prepare_both(pairs).collect()
    assert prepare_both(pairs.limit(0)).collect() == []


def test_formats_are_written_apart(spark, edges, tmp_path):
    paths = P.save_paths(str(tmp_path / "new" / "x.json"), "both")
    write_formats(prepare_both(edges), paths)
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == ["x.dpo.json", "x.sft.json"]
    sft, dpo = P.prepare_for_sft(edges), P.prepare_for_dpo(edges)
    assert same(spark.read.schema(sft.schema).json(paths["sft"]), sft)
    assert same(spark.read.schema(dpo.schema).json(paths["dpo"]), dpo)
    lines = spark.read.text(paths["dpo"]).collect()
    assert {tuple(json.loads(r.value)) for r in lines} == {("row_id", "prompt", "chosen", "rejected")}
    with pytest.raises(ValueError, match="already exists"):
        write_formats(prepare_both(edges), paths)
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == ["x.dpo.json", "x.sft.json"]
    none = P.save_paths(str(tmp_path / "none.json"), "both")
    write_formats(prepare_both(edges.limit(0)), none)
    assert spark.read.schema(dpo.schema).json(none["dpo"]).count() == 0


def test_sides_are_written_by_key(spark, edges, tmp_path):
    split = P.with_split(P.prepare_for_dpo(edges), 0.2)
    path = str(tmp_path / "sides")
    write_keyed(split, path, "split")
    schema = "row_id bigint, prompt string, chosen string, rejected string"
    for side in ("train", "validation"):
        got = read_keyed(spark, path, "split", side, schema)
        assert same(got, split.where(F.col("split") == side).drop("split"))
        assert f"split={side}" not in plan(got) and "PartitionFilters" in plan(got)
    with pytest.raises(Exception, match="already exists"):
        write_keyed(split, path, "split")


def test_funnel_of_pairs(spark, edges):
    funnel = Funnel()
    prepared = P.prepare_for_dpo(edges, NATIVE, MAX_LENGTH, MAX_PROMPT_LENGTH, funnel=funnel)
    assert plan(prepared).count("split(") == 1
    prepared.write.format("noop").mode("overwrite").save()
    got = funnel.get
    rows = edges.count()
    unparsed = edges.where(F.size(P.parse_conversation(F.col("chosen"))) == 0).count()
    filled = P.prepare_for_dpo(edges).count()
    kept = P.prepare_for_dpo(edges, NATIVE, MAX_LENGTH, MAX_PROMPT_LENGTH).count()
    assert unparsed >= 2 and kept < filled < rows
    assert got == {
        "rows_in": rows, "nulls": 0, "unparsed": unparsed, "empty": rows - unparsed - filled,
        "over_length": filled - kept, "kept": kept,
    }
    assert sum(v for k, v in got.items() if k != "rows_in") == rows
    with pytest.raises(ValueError, match="new one"):
        P.prepare_for_dpo(edges, funnel=funnel)


def test_funnel_of_text_and_of_nulls(spark, edges):
    funnel = Funnel()
    P.prepare_for_sft(edges, NATIVE, MAX_LENGTH, funnel=funnel).write.format("noop").mode("overwrite").save()
    kept = P.prepare_for_sft(edges, NATIVE, MAX_LENGTH).count()
    assert (funnel.get["kept"], funnel.get["over_length"]) == (kept, edges.count() - kept)
    assert funnel.get["unparsed"] >= 2 and funnel.get["empty"] == 0
    nulls = spark.createDataFrame([(1, None, "x"), (2, "\n\nAssistant: c", None)], "row_id bigint, chosen string, rejected string")
    funnel = Funnel()
    P.prepare_for_dpo(nulls, on_null="drop", funnel=funnel).collect()
    assert funnel.get == {"rows_in": 2, "nulls": 2, "unparsed": 0, "empty": 0, "over_length": 0, "kept": 0}


def test_first_prepared_rows(spark, edges):
    starts = []

    def first(size):
        starts.append(size)
        return P.first_rows(edges, size)

    want = [tuple(r) for r in P.prepare_for_dpo(edges).orderBy("row_id").limit(5).collect()]
    got = first_prepared(first, P.prepare_for_dpo, 5, start=6)
    assert [tuple(r) for r in got.orderBy("row_id").collect()] == want and starts[0] == 6
    # All rows of the first start drop out, so that a longer one is looked at.
    none = edges.withColumn("chosen", F.when(F.col("row_id") > 60, F.col("chosen")).otherwise(""))
    got = first_prepared(lambda k: P.first_rows(none, k), P.prepare_for_dpo, 2, start=10)
    assert [r.row_id for r in got.collect()] == [r.row_id for r in P.prepare_for_dpo(none).orderBy("row_id").limit(2).collect()]
    assert first_prepared(first, P.prepare_for_dpo, 0).collect() == []
    capped = first_prepared(lambda k: P.first_rows(none, k), P.prepare_for_dpo, 2, start=10, most=20)
    assert capped.collect() == []
    # What is read to find the start is the key alone.
    assert "split(" not in plan(edges.select("row_id"))


def test_hash_split_stays_when_rows_are_added(spark, tmp_path):
    rows = spark.range(20_000).withColumnRenamed("id", "row_id")
    few = {r.row_id: r.split for r in P.with_hash_split(rows.where("row_id % 3 = 0")).collect()}
    all_ = {r.row_id: r.split for r in P.with_hash_split(rows.repartition(7)).collect()}
    assert all(all_[k] == side for k, side in few.items())
    share = sum(side == "validation" for side in all_.values()) / len(all_)
    assert 0.04 < share < 0.06
    other = {r.row_id: r.split for r in P.with_hash_split(rows, seed=7).collect()}
    assert other != all_
    third = P.with_hash_split(rows, 1 / 3).where("split = 'validation'")
    assert 0.31 < third.count() / 20_000 < 0.36 and "Exchange" not in plan(third)
    odd = spark.createDataFrame([("a",), (None,)], "row_id string")
    assert [r.split for r in P.with_hash_split(odd, 0.999).collect()] == ["validation", "train"]
    for size in (0, 1, 1.5):
        with pytest.raises(ValueError):
            P.with_hash_split(rows, size)
    # A stream gives the same sides.
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = P.with_hash_split(spark.readStream.schema("row_id bigint").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = {r.row_id: r.split for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == all_


def test_prompt_mismatch(spark):
    a, b = "\n\nHuman: q", "\n\nAssistant: r"
    pairs = [
        (1, a + b, a + "\n\nAssistant: other"),  # equal prompts
        (2, a + b, "\n\nHuman: Q" + b),
        (3, a + b + a + "2" + b, a + b),  # the rejected prompt ends first
        (4, a + b, a + b + a + b),
        (5, a, a),  # no reply: all is prompt
        (6, "none", a + b),
        (7, "none", "  "),
        (8, b + a + b, a + b),
    ]
    rows = spark.createDataFrame(pairs, "row_id bigint, chosen string, rejected string")
    found = P.prompt_mismatch(rows)
    assert plan(found).count("split(") == 2
    got = {r.row_id: tuple(r)[1:] for r in found.collect()}
    assert got == {
        2: (1, "user", "q", "user", "Q"),
        3: (2, "assistant", "r", None, None),
        4: (2, None, None, "assistant", "r"),
        6: (1, None, None, "user", "q"),
        8: (1, "assistant", "r", "user", "q"),
    }
    assert P.prompt_mismatch(rows.limit(0)).collect() == []
    nulls = spark.createDataFrame([(1, None, a)], "row_id bigint, chosen string, rejected string")
    assert P.prompt_mismatch(nulls, on_null="drop").collect() == []
    with pytest.raises(Exception, match="holds a null"):
        P.prompt_mismatch(nulls).collect()


@pytest.fixture
def stream_root(tmp_path):
    (tmp_path / "in" / "s").mkdir(parents=True)

    def add(number, names):
        rows = [{"chosen": f"\n\nHuman: {n}?\n\nAssistant: {n}!", "rejected": "\n\nAssistant: no" if n != "e" else ""} for n in names]
        (tmp_path / "in" / "s" / f"train-{number}.json").write_text("\n".join(map(json.dumps, rows)))

    for number, names in enumerate(["abc", "de", "f", "ghij"]):
        add(number, names)
    return tmp_path, add


def test_stream_job_restarted_in_the_middle(spark, stream_root, monkeypatch):
    """A batch that failed after its rows were written is done again and repeats none."""
    tmp_path, add = stream_root
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        pairs = P.stream_pairs(spark, str(tmp_path / "in"), files_per_trigger=1)
        query = stream_job.start_job(pairs, out, checkpoint, keep=["subset"])
        query.awaitTermination()

    written = []
    real = stream_job.write_keyed

    def failing(both, path, key, **options):
        assert plan(both).count("Scan ") == 1 and plan(both).count("split(") == 1
        real(both, path, key, **options)
        written.append(path)
        if len(written) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(stream_job, "write_keyed", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run()
    assert stream_job.job_output(spark, out, "sft").count() in (5, 4)
    run()
    assert len(written) == 5 and written[1] == written[2]

    def rows(kind, column):
        return sorted(r[column] for r in stream_job.job_output(spark, out, kind, "subset string").collect())

    assert len(rows("sft", "text")) == 10 and len(set(rows("sft", "text"))) == 10
    assert rows("dpo", "chosen") == sorted(f"{n}!" for n in "abcdfghij")
    counts = stream_job.job_counts(spark, out).orderBy("batch").collect()
    assert [r.batch for r in counts] == [0, 1, 2, 3]
    assert [sum(r[c] for r in counts) for c in ("pairs", "sft", "dpo")] == [10, 10, 9]
    add(9, "kl")
    run()
    assert len(rows("sft", "text")) == 12 and rows("sft", "subset") == ["s"] * 12
