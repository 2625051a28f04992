import gzip
import json

import pytest
from pyspark.sql import functions as F

import pairloom as P
from conftest import SF
from pairloom.plans.fixtures import edge_pairs, stored_pairs
from pairloom.plans.job import PrepareConfig, lines, parse_args, run_prepare
from pairloom.sources import pairs as pairs_module
from pairloom.sources import rows
from pairloom.sources.prepared import require_columns


def talk(name):
    return f"\n\nHuman: {name}?\n\nAssistant: {name}!"


def write_lines(path, names, opener=open):
    path.parent.mkdir(parents=True, exist_ok=True)
    with opener(path, "wt", encoding="utf-8") as out:
        for name in names:
            row = {"chosen": talk(name), "rejected": talk(name.upper()), "other": 1}
            out.write(json.dumps(row) + "\n")


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("pairs")
    write_lines(root / "kind a" / "train.jsonl.gz", [f"a{i}" for i in range(40)], gzip.open)
    write_lines(root / "kind a" / "test.jsonl", ["ta0", "ta1"])
    write_lines(root / "kind-b" / "train.jsonl", [f"b{i}" for i in range(30)])
    write_lines(root / "kind-b" / "test" / "part-1.json", ["tb0"])
    write_lines(root / "kind-b" / "test" / "part-2.json", ["tb1", "tb2"])
    return str(root)


def names(df):
    rows = df.orderBy("row_id").select(P.format_conversation(F.col("chosen"))["response"]).collect()
    return [r[0].rstrip("!") for r in rows]


def test_load_all_in_file_order(spark, root):
    df = P.load_pairs(spark, root)
    assert df.columns == ["row_id", "chosen", "rejected", "subset", "split"]
    assert names(df) == [
        "ta0", "ta1", *[f"a{i}" for i in range(40)], "tb0", "tb1", "tb2", *[f"b{i}" for i in range(30)],
    ]
    assert df.select("row_id").distinct().count() == 75
    got = {tuple(r) for r in df.groupBy("subset", "split").count().collect()}
    assert got == {
        ("kind a", "train", 40), ("kind a", "test", 2), ("kind-b", "train", 30), ("kind-b", "test", 3),
    }


def test_load_subset_split_and_first_rows(spark, root):
    assert names(P.load_pairs(spark, root, "test", "kind-b")) == ["tb0", "tb1", "tb2"]
    assert names(P.load_pairs(spark, root, "train", "kind a", 3)) == ["a0", "a1", "a2"]
    assert names(P.load_pairs(spark, root, "train", max_samples=42))[-2:] == ["b0", "b1"]
    each = P.load_pairs(spark, root, max_samples=2)
    assert {tuple(r) for r in each.groupBy("split").count().collect()} == {("train", 2), ("test", 2)}
    assert P.load_pairs(spark, root, "train", max_samples=0).count() == 0
    with pytest.raises(ValueError):
        P.load_pairs(spark, root, "validation")


def test_packed_files_are_spread(spark, tmp_path):
    for i in range(12):
        write_lines(tmp_path / "s" / f"train-{i:02}.json.gz", [f"f{i}"] * (i + 1), gzip.open)

    def shuffled():
        df = P.load_pairs(spark, str(tmp_path), "train")
        assert df.select("row_id").distinct().count() == 78
        assert names(df) == [f"f{i}" for i in range(12) for _ in range(i + 1)]
        return "REBALANCE" in df._jdf.queryExecution().executedPlan().toString()

    assert shuffled()
    write_lines(tmp_path / "s" / "test-00.json", ["plain"])
    plain = P.load_pairs(spark, str(tmp_path), "test")
    assert "REBALANCE" not in plain._jdf.queryExecution().executedPlan().toString()


def test_row_ids_of_cut_files(spark, tmp_path):
    # Many small blocks per file, so that one file spans tasks.
    for name in ("one", "two"):
        write_lines(tmp_path / "s" / f"train-{name}.json", [f"{name}{i}" for i in range(3000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = P.load_pairs(spark, str(tmp_path), "train")
        assert df.rdd.getNumPartitions() > 10
        assert names(df) == [f"{n}{i}" for n in ("one", "two") for i in range(3000)]
        df.select("chosen", "rejected").write.parquet(str(tmp_path / "s" / "test.parquet"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    columnar = P.load_pairs(spark, str(tmp_path), "test", file_format="parquet")
    assert columnar.select("row_id").distinct().count() == 6000


def test_stream_equals_batch(spark, root, tmp_path):
    pairs = P.load_pairs(spark, root)
    for kind, prepare in (("sft", P.prepare_for_sft), ("dpo", P.prepare_for_dpo)):
        stream = P.stream_pairs(spark, root, files_per_trigger=2)
        assert stream.isStreaming
        out = str(tmp_path / kind)
        query = P.start_preparation(stream, kind, out, str(tmp_path / f"{kind}-checkpoint"), keep=[])
        query.awaitTermination()
        batch = prepare(pairs, keep=[])
        streamed = spark.read.schema(batch.schema).json(out)
        assert streamed.count() == 75
        assert streamed.exceptAll(batch).count() == 0


def test_json_round_trip(spark, tmp_path):
    pairs = edge_pairs(stored_pairs(spark, SF))
    dpo, sft = P.prepare_for_dpo(pairs), P.prepare_for_sft(pairs)
    P.write_json(dpo, str(tmp_path / "new" / "dpo"))
    P.write_json(sft, str(tmp_path / "new" / "sft"), compression="gzip")
    again = P.load_preference_data(spark, str(tmp_path / "new" / "dpo"))
    assert again.columns == dpo.columns
    assert again.exceptAll(dpo).count() == 0 and again.count() == dpo.count()
    text = P.load_training_text(spark, str(tmp_path / "new" / "dpo"))
    assert text.columns == ["row_id", "text"]
    assert text.exceptAll(sft.select("row_id", "text")).count() == 0
    read = spark.read.schema(sft.schema).json(str(tmp_path / "new" / "sft"))
    assert read.exceptAll(sft).count() == 0 and read.count() == 100
    with pytest.raises(Exception, match="already exists"):
        P.write_json(dpo, str(tmp_path / "new" / "dpo"))


def test_nulls_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "row_id bigint, text string")
    P.write_json(df, str(tmp_path / "out"), keep_row_id=False)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"text":null}']


def test_required_columns(spark, tmp_path):
    require_columns(["a", "prompt", "chosen", "rejected"], ["prompt", "chosen", "rejected"])
    (tmp_path / "x.json").write_text('{"prompt": "p", "chosen": "c", "score": 2}\n')
    with pytest.raises(ValueError, match="rejected"):
        P.load_preference_data(spark, str(tmp_path / "x.json"))
    text = P.load_training_text(spark, str(tmp_path / "x.json"))
    assert [r.text for r in text.collect()] == ["p\n\nAssistant: c"]
    (tmp_path / "y.json").write_text('{"rejected": "r", "prompt": "p", "chosen": "c", "score": 2}\n')
    full = P.load_preference_data(spark, str(tmp_path / "y.json"), "all")
    assert full.columns == ["row_id", "prompt", "chosen", "rejected", "score"]
    assert tuple(full.first())[1:] == ("p", "c", "r", "2")
    # A field that only a late line has is found, or left out on request.
    line = '{"rejected": "r", "prompt": "p", "chosen": "c"}\n'
    (tmp_path / "z.json").write_text(line * 500 + line.replace("}", ', "late": "x"}'))
    late = P.load_preference_data(spark, str(tmp_path / "z.json"), "all")
    assert late.columns[-1] == "late" and late.where("late = 'x'").count() == 1
    few = P.load_preference_data(spark, str(tmp_path / "z.json"))
    assert few.columns == ["row_id", "prompt", "chosen", "rejected"] and few.count() == 501
    few.write.parquet(str(tmp_path / "p"))
    again = P.load_preference_data(spark, str(tmp_path / "p"), file_format="parquet")
    assert again.exceptAll(few).count() == 0
    bare = few.drop("row_id")
    bare.write.parquet(str(tmp_path / "q"))
    numbered = P.load_preference_data(spark, str(tmp_path / "q"), file_format="parquet")
    assert numbered.select("row_id").distinct().count() == 501


def test_late_fields_and_nulls_of_prepared_tables(spark, tmp_path):
    """Whether a field is there is judged over all lines, alike in both readers."""
    bare, full = '{"rejected": "r"}\n', '{"rejected": "r", "prompt": "p", "chosen": "c"}\n'
    (tmp_path / "late.json").write_text(bare * 100 + full * 50 + "not json\n")
    for read in (P.load_training_text, P.load_preference_data):
        with pytest.raises(Exception, match="null in a needed column"):
            read(spark, str(tmp_path / "late.json")).collect()
        assert read(spark, str(tmp_path / "late.json"), on_null="drop").count() == 50
        with pytest.raises(ValueError, match="on_null"):
            read(spark, str(tmp_path / "late.json"), on_null="keep")


def test_row_ids_hold_when_the_scan_is_cut_anew(spark, tmp_path):
    for i in range(3):
        write_lines(tmp_path / "s" / f"train-{i}.json", [f"{i}-{k}" for k in range(2000)])
    order = [f"{i}-{k}" for i in range(3) for k in range(2000)]
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum")}
    try:
        # Several blocks in each task.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.maxPartitionNum", "3")
        staged = P.ingest_pairs(spark, str(tmp_path), str(tmp_path / "staged"), "train")
        first = P.load_pairs(spark, str(tmp_path), "train", max_samples=3500)
        split = P.with_split(staged, 0.5)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.unset("spark.sql.files.maxPartitionNum")
        assert names(first) == order[:3500]
        assert sorted(r.row_id for r in staged.collect()) == list(range(6000))
        assert names(staged) == order
        assert sorted(r["count"] for r in split.groupBy("split").count().collect()) == [3000, 3000]
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_files_are_ranked_without_moving_text(spark, tmp_path):
    for i in range(40):
        write_lines(tmp_path / "s" / f"train-{'x' * 90}{i:02}.json", [f"{i}"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.load_pairs(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_save_paths():
    assert P.save_paths("d/x.json", "both") == {"sft": "d/x.sft.json", "dpo": "d/x.dpo.json"}
    assert P.save_paths("s3://b/d.1/x", "both")["sft"] == "s3://b/d.1/x.sft.json"
    assert P.save_paths("x.json", "dpo") == {"dpo": "x.json"}


def test_job(spark, root, tmp_path):
    target = str(tmp_path / "out" / "train.json")
    report = run_prepare(spark, PrepareConfig(root, save_path=target, max_samples=50))
    assert report.loaded == 50
    assert report.statistics["sft"]["num_examples"] == 50
    assert report.statistics["dpo"]["columns"] == ["prompt", "chosen", "rejected"]
    assert [r.chosen for r in report.examples["dpo"]] == ["a0!", "a1!", "a2!"]
    assert report.raw_sample == talk("a0") + "..."
    dpo = P.load_preference_data(spark, report.saved["dpo"])
    assert report.saved["dpo"].endswith("out/train.dpo.json") and dpo.count() == 50
    stats = P.get_dataset_statistics(dpo)
    assert stats == report.statistics["dpo"]
    assert any("mean" in line for line in lines(report))
    # Statistics only; no examples asked for.
    quiet = run_prepare(spark, PrepareConfig(root, split="test", format="dpo", show_examples=0))
    assert quiet.loaded == 5 and quiet.examples == {"dpo": []} and not quiet.saved
    with pytest.raises(ValueError):
        run_prepare(spark, PrepareConfig(root, format="csv"))


def test_job_arguments():
    config = parse_args(["--input", "in"])
    assert (config.split, config.format, config.show_examples) == ("train", "both", 3)
    assert config.max_samples is None and config.save_path is None
    with pytest.raises(SystemExit):
        parse_args(["--input", "in", "--split", "validation"])


def test_long_conversation_is_joined_in_order(spark):
    turns = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    whole = P.assemble_conversations(turns.repartition(5)).where("conv_id = 7").first().chosen
    expected = [i for i in range(2000) if i % 3 == 0 or i == 7]
    label = ("Human", "Assistant")
    assert whole == "".join(f"\n\n{label[i % 2]}: t{i}" for i in expected)


def test_prepared_json_ids_hold_when_the_cut_changes(spark, tmp_path):
    lines = [json.dumps({"prompt": f"p{n}", "chosen": "c" * 50, "rejected": "r"}) for n in range(400)]
    (tmp_path / "prepared.json").write_text("\n".join(lines))
    table = P.load_preference_data(spark, str(tmp_path / "prepared.json"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sides = P.create_train_val_split(table)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        rows = {side: [(r.row_id, r.prompt) for r in t.collect()] for side, t in sides.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows["validation"]) == 20
    assert sorted(rows["train"] + rows["validation"]) == [(n, f"p{n}") for n in range(400)]


def with_conf(spark, values, action):
    """The result of an action under other settings."""
    old = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        return action()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_split_and_first_rows_of_loaded_text_are_exact(spark, tmp_path):
    """Ids of a plain text load move with the cut; the border must not."""
    for i in range(2):
        write_lines(tmp_path / "s" / f"train-{i}.json", [f"{i}-{k}" for k in range(10_000)])
    small = {"spark.sql.files.maxPartitionBytes": "30000"}
    split = with_conf(spark, small, lambda: P.with_split(P.load_pairs(spark, str(tmp_path)), 0.5))
    assert sorted(r["count"] for r in split.groupBy("split").count().collect()) == [10_000, 10_000]
    pairs = P.load_pairs(spark, str(tmp_path))
    sides = with_conf(spark, small, lambda: P.create_train_val_split(P.prepare_for_dpo(pairs), 0.25))
    rows = {side: {r.chosen for r in t.collect()} for side, t in sides.items()}
    assert len(rows["validation"]) == 5000 and len(rows["train"]) == 15_000
    assert not rows["validation"] & rows["train"]
    first = with_conf(spark, small, lambda: P.first_rows(pairs, 12_345))
    assert names(first) == [f"{i}-{k}" for i in range(2) for k in range(10_000)][:12_345]


@pytest.fixture
def few_blocks(monkeypatch):
    """At most four blocks looked up at once, so that staging takes many rounds."""
    monkeypatch.setattr(rows, "BLOCKS", 4)


def test_ingest_in_rounds_opens_in_a_new_session(spark, tmp_path, few_blocks):
    write_lines(tmp_path / "in" / "s b" / "train-x.json.gz", [f"z{k}" for k in range(500)], gzip.open)
    for i in range(12):
        write_lines(tmp_path / "in" / "s" / f"train-{i:02}.json", [f"{i}-{k}" for k in range(400)])
    target = str(tmp_path / "staged")
    cut = {"spark.sql.files.maxPartitionBytes": "9000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with_conf(spark, cut, lambda: P.ingest_pairs(spark, str(tmp_path / "in"), target))
    table = P.open_pairs(spark.newSession(), target)
    want = [f"z{k}" for k in range(500)] + [f"{i}-{k}" for i in range(12) for k in range(400)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    got = table.orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(len(want)))
    assert {(r.subset, r.split) for r in got} == {("s", "train"), ("s b", "train")}
    # File order is that of the full names, in which a blank is written %20.
    assert names(table) == want


def test_ingest_is_repeatable_and_refuses_other_files(spark, tmp_path, monkeypatch):
    write_lines(tmp_path / "in" / "s" / "train.json", ["a", "b"])
    root, target = str(tmp_path / "in"), str(tmp_path / "staged")
    with pytest.raises(ValueError, match="no complete table"):
        P.open_pairs(spark, target)
    # Broken off before the manifest: nothing is open, and a second run succeeds.
    monkeypatch.setattr(pairs_module, "MANIFEST_COLUMNS", ("gone",))
    with pytest.raises(KeyError):
        P.ingest_pairs(spark, root, target)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no complete table"):
        P.open_pairs(spark, target)
    assert names(P.ingest_pairs(spark, root, target)) == ["a", "b"]
    files = sorted(str(p) for p in (tmp_path / "staged").rglob("*"))
    assert names(P.ingest_pairs(spark, root, target)) == ["a", "b"]
    assert sorted(str(p) for p in (tmp_path / "staged").rglob("*")) == files
    write_lines(tmp_path / "in" / "s" / "test.json", ["c"])
    with pytest.raises(ValueError, match="other files"):
        P.ingest_pairs(spark, root, target)
    assert names(P.open_pairs(spark, target)) == ["a", "b"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        P.ingest_pairs(spark, str(tmp_path / "none"), target)


def test_prepared_json_is_read_once(spark, tmp_path, monkeypatch):
    """Presence is judged by counts of the one staging pass; ids that some rows lack are refused."""
    lines = [json.dumps({"prompt": f"p{n}", "chosen": "c", "rejected": "r"}) for n in range(50)]
    (tmp_path / "a.json").write_text("\n".join(lines))
    table = P.load_preference_data(spark, str(tmp_path / "a.json"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "json" not in plan.lower() and "Join" not in plan
    assert sorted(tuple(r)[:2] for r in table.collect()) == [(n, f"p{n}") for n in range(50)]
    mixed = [json.dumps({"row_id": 1, "prompt": "p", "chosen": "c", "rejected": "r"}), *lines[:2]]
    (tmp_path / "b.json").write_text("\n".join(mixed))
    for read in (P.load_preference_data, P.load_training_text):
        with pytest.raises(ValueError, match="row_id is null in 2 of 3 rows"):
            read(spark, str(tmp_path / "b.json"))
    # A malformed line has no id, but no other value either.
    (tmp_path / "c.json").write_text(mixed[0] + "\nnot json\n")
    rows = P.load_preference_data(spark, str(tmp_path / "c.json"), on_null="drop").collect()
    assert [tuple(r) for r in rows] == [(1, "p", "c", "r")]
    nulls = spark.createDataFrame([(1, "p", "c", "r"), (None, "p", "c", "r")], "row_id bigint, prompt string, chosen string, rejected string")
    nulls.write.parquet(str(tmp_path / "d"))
    with pytest.raises(ValueError, match="row_id is null"):
        P.load_preference_data(spark, str(tmp_path / "d"), file_format="parquet")
    (tmp_path / "none").mkdir()
    assert P.load_preference_data(spark, str(tmp_path / "none")).collect() == []
    (tmp_path / "e.json").write_text("")
    assert P.load_preference_data(spark, str(tmp_path / "e.json")).collect() == []


def test_other_fields_pass_through_as_variants(spark, tmp_path):
    records = [
        {"prompt": "p", "chosen": "c", "rejected": "r", "score": 2, "tags": ["a", {"b": None}], "prompt.x": 1.5},
        {"prompt": "p2", "chosen": "c", "rejected": "r", "row": {"x": [True]}, "extra": "own", "t\"q": "é\n"},
        {"prompt": "p3", "chosen": "c", "rejected": "r"},
    ]
    (tmp_path / "x.json").write_text("\n".join(json.dumps(r) for r in records) + "\n\n")
    table = P.load_preference_data(spark, str(tmp_path / "x.json"), "variant")
    assert table.dtypes == [("row_id", "bigint"), ("prompt", "string"), ("chosen", "string"), ("rejected", "string"), ("extra", "map<string,variant>")]
    got = {r.row_id: json.loads(r.extra) for r in table.select("row_id", F.to_json("extra").alias("extra")).collect()}
    others = [{k: v for k, v in r.items() if k not in ("prompt", "chosen", "rejected")} for r in records]
    assert got == dict(enumerate(others))
    value = F.try_variant_get(F.col("extra")["score"], "$", "int")
    assert table.where(value == 2).count() == 1
    P.write_json(table, str(tmp_path / "out"), keep_row_id=False)
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(written, key=lambda r: r["prompt"]) == records
    again = P.load_preference_data(spark, str(tmp_path / "out"), "variant")
    assert again.count() == 3
    side = P.create_train_val_split(table, 1)["validation"]
    assert side.count() == 1 and "extra" in side.columns
    with pytest.raises(ValueError, match="variant"):
        P.load_preference_data(spark, str(tmp_path), "variant", file_format="parquet")


def test_too_many_fields_are_refused(spark, tmp_path, monkeypatch):
    from pairloom.sources import prepared

    monkeypatch.setattr(prepared, "MAX_FIELDS", 5)
    record = {"prompt": "p", "chosen": "c", "rejected": "r"} | {f"f{k}": k for k in range(3)}
    (tmp_path / "x.json").write_text(json.dumps(record))
    with pytest.raises(ValueError, match="variant"):
        P.load_preference_data(spark, str(tmp_path / "x.json"), "all")
    assert P.load_preference_data(spark, str(tmp_path / "x.json"), "variant").count() == 1
