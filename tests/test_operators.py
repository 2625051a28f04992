import math
from functools import cache

import pytest
from pyspark.sql import functions as F

import pairloom as P
from conftest import SF
from pairloom.operators import selection
from pairloom.operators.statistics import data_columns
from pairloom.plans.fixtures import edge_pairs, stored_pairs


@pytest.fixture(scope="module")
def pairs(spark):
    return stored_pairs(spark, SF)


@pytest.fixture(scope="module")
def edges(pairs):
    return edge_pairs(pairs)


def keyed(df):
    return {r.row_id: r for r in df.collect()}


# Preparation


def test_known_counts(pairs, edges):
    assert pairs.count() == 100
    dpo = P.prepare_for_dpo(pairs)
    assert dpo.columns == ["row_id", "prompt", "chosen", "rejected"]
    stats = P.get_dataset_statistics(dpo)
    assert stats["num_examples"] == 96
    assert stats["prompt_length"] == {"mean": 1705.2708333333333, "min": 48, "max": 4811}
    assert stats["chosen_length"] == {"mean": 1039.40625, "min": 100, "max": 1837}
    assert stats["rejected_length"] == {"mean": 1048.6354166666667, "min": 100, "max": 1837}
    tokens = dpo.agg(F.sum(P.native_tokenizer().count(F.col("prompt"))))
    assert tokens.first()[0] == 26864
    kept = P.prepare_for_dpo(edges).groupBy((F.col("row_id") % 8).alias("k")).count()
    assert {r.k: r["count"] for r in kept.collect()} == {0: 13, 1: 13, 2: 13, 3: 12, 7: 12}
    tight = P.prepare_for_dpo(edges, P.native_tokenizer(), 300, 100)
    assert tight.count() == 11


def test_sft_keeps_every_row_and_every_turn(spark, edges):
    sft = keyed(P.prepare_for_sft(edges))
    assert len(sft) == 100
    for row_id, row in sft.items():
        if row_id % 8 == 4:  # no markers
            assert (row.text, row.messages) == ("\n\nAssistant: ", [])
        if row_id % 8 == 2:  # a turn after the last reply
            assert row.messages[-1] == ("user", "trailing") and "trailing" not in row.text


def test_reloaded_text_is_sft_text(edges):
    dpo = P.prepare_for_dpo(edges)
    again = keyed(P.sft_text_from_pairs(dpo))
    plain = keyed(P.prepare_for_sft(edges))
    assert again and all(plain[k].text == again[k].text for k in again)


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_partitioning_does_not_matter(edges, parts):
    again = edges.repartition(parts)
    assert keyed(P.prepare_for_dpo(again)) == keyed(P.prepare_for_dpo(edges))
    assert keyed(P.with_split(again.select("row_id"))) == keyed(P.with_split(edges.select("row_id")))


LIMITS = [
    ((1024, 1024, 1024), 2048, 1024, True, True),
    ((1025, 1, 1), 2048, 1024, True, False),
    ((1025, 1, 1), 2048, None, True, True),
    ((1000, 1048, 1049), 2048, 1024, True, False),
    ((1000, 1049, 1048), 2048, 1024, True, False),
    ((5000, 5000, 5000), None, 1024, True, True),
    ((5000, 5000, 5000), 2048, 1024, False, True),
]


@pytest.mark.parametrize("sizes,max_length,max_prompt,counted,kept", LIMITS)
def test_dpo_limits(spark, sizes, max_length, max_prompt, counted, kept):
    p, c, r = sizes
    prompt = "Human: " + "w " * (p - 1)
    df = spark.createDataFrame(
        [(1, f"{prompt}\n\nAssistant: {'w ' * c}", f"{prompt}\n\nAssistant: {'w ' * r}")],
        "row_id bigint, chosen string, rejected string",
    )
    tokenizer = P.native_tokenizer() if counted else None
    assert P.prepare_for_dpo(df, tokenizer, max_length, max_prompt).count() == int(kept)


def test_sft_limit_is_inclusive_and_optional(spark):
    df = spark.createDataFrame([(1, "Human: a\n\nAssistant: b c")], "row_id bigint, chosen string")
    tok = P.native_tokenizer()

    def rows(**options):
        return P.prepare_for_sft(df, **options).count()

    # "Human: a / Assistant: b c" is five tokens.
    assert rows(tokenizer=tok, max_length=5, use_chat_template=False) == 1
    assert rows(tokenizer=tok, max_length=4, use_chat_template=False) == 0
    assert rows(tokenizer=tok, max_length=None, use_chat_template=False) == 1
    assert rows(max_length=1) == 1
    special = P.native_tokenizer(special_per_call=1)
    assert rows(tokenizer=special, max_length=5, use_chat_template=False) == 0


def test_length_filter_is_monotone(edges):
    kept = [
        {r.row_id for r in P.prepare_for_dpo(edges, P.native_tokenizer(), n, None).collect()}
        for n in (0, 200, 400, 800, 10**6)
    ]
    assert all(a <= b for a, b in zip(kept, kept[1:], strict=False))
    assert not kept[0] and kept[-1] == set(keyed(P.prepare_for_dpo(edges)))


# Hooks


class Words:
    """A tokenizer object with the usual call interface."""

    def __call__(self, texts, truncation):
        assert isinstance(texts, list) and truncation is False
        return {"input_ids": [list(range(len(t.split()))) for t in texts]}

    def apply_chat_template(self, messages, tokenize, add_generation_prompt):
        assert tokenize is False
        body = "".join(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in messages)
        return body + ("<|im_start|>assistant\n" if add_generation_prompt else "")


@cache
def load_words():
    return Words()


def test_python_hooks_equal_native(edges):
    hook, native = P.python_tokenizer(load_words), P.native_tokenizer()
    m = P.parse_conversation(F.col("chosen"))
    for generation in (False, True):
        both = edges.select(
            hook.render(m, generation).alias("a"), native.render(m, generation).alias("b")
        )
        assert both.where("a <> b or a is null").count() == 0
    assert edges.select(hook.count(F.col("rejected")).alias("n")).agg(F.sum("n")).first()[0] == (
        edges.select(native.count(F.col("rejected")).alias("n")).agg(F.sum("n")).first()[0]
    )
    assert keyed(P.prepare_for_sft(edges, hook, 300)) == keyed(P.prepare_for_sft(edges, native, 300))
    assert keyed(P.prepare_for_dpo(edges, hook, 300, 100)) == (
        keyed(P.prepare_for_dpo(edges, native, 300, 100))
    )


def test_subword_tokenizer_library(edges):
    tokenizers = pytest.importorskip("tokenizers")

    def load():
        inner = tokenizers.Tokenizer(tokenizers.models.WordLevel({"?": 0}, unk_token="?"))
        inner.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        return lambda texts, truncation: {"input_ids": [e.ids for e in inner.encode_batch(texts)]}

    count = P.python_tokenizer(load).count
    both = edges.select(
        count(F.col("rejected")).alias("a"), P.native_tokenizer().count(F.col("rejected")).alias("b")
    )
    assert both.where("a <> b or a is null").count() == 0


def test_chat_templates(spark):
    df = spark.createDataFrame([("\n\nHuman: Hi\n\nAssistant: Hello",), ("",)], "t string")
    m = P.parse_conversation(F.col("t"))
    rows = df.select(
        P.CHATML.render(m), P.CHATML.render(m, True), P.INST.render(m)
    ).collect()
    chat = "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nHello<|im_end|>\n"
    ask = "<|im_start|>assistant\n"
    assert [tuple(r) for r in rows] == [
        (chat, chat + ask, "<s>[INST] Hi [/INST] Hello</s>"),
        ("", ask, "<s>"),
    ]


# Statistics


def test_statistics_follow_the_columns(spark, pairs):
    raw = P.get_dataset_statistics(pairs)
    assert raw == {"num_examples": 100, "columns": ["chosen", "rejected"]}
    both = spark.createDataFrame(
        [("ab", "c", "", "😀e")], "text string, prompt string, chosen string, rejected string"
    )
    stats = P.get_dataset_statistics(both)
    assert stats["text_length"] == {"mean": 2.0, "min": 2, "max": 2}
    assert stats["rejected_length"] == {"mean": 2.0, "min": 2, "max": 2}
    with pytest.raises(KeyError):
        P.dataset_statistics(spark.createDataFrame([("a",)], "prompt string"))


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, messages array<string>")
    assert P.get_dataset_statistics(empty) == {
        "num_examples": 0,
        "columns": ["text", "messages"],
        "text_length": {"mean": None, "min": None, "max": None},
    }


def test_observed_statistics(edges):
    dpo = P.prepare_for_dpo(edges)
    watched, seen = P.observe_statistics(dpo, "dpo")
    watched.write.format("noop").mode("overwrite").save()
    plain = P.dataset_statistics(dpo).first().asDict()
    assert plain.pop("columns") == ",".join(data_columns(dpo)) == "prompt,chosen,rejected"
    assert dict(seen.get) == plain


# First n, split


@pytest.mark.parametrize("direct", [3, 10_000])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 50, 98, 99, 100, 5000])
def test_first_rows(pairs, n, direct):
    got = sorted(r.row_id for r in P.first_rows(pairs, n, direct=direct).select("row_id").collect())
    assert got == list(range(min(n, 100)))


@pytest.mark.parametrize("n", [1, 700, 30_000, 199_999])
def test_first_rows_of_wide_ids(spark, n):
    ids = spark.range(200_000).select(
        # Negative, sparse and large ids, out of order.
        ((F.col("id") * 46_116_860_141_293 - 4_611_686_018_427_387_904)).alias("row_id")
    )
    got = P.first_rows(ids.repartition(7), n, direct=100)
    low, high, count = got.agg(F.min("row_id"), F.max("row_id"), F.count("*")).first()
    start = -4_611_686_018_427_387_904
    assert (low, high, count) == (start, start + (n - 1) * 46_116_860_141_293, n)


def test_first_rows_per_split(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split")
    )
    got = P.first_rows(df, 5, splits=("train", "test"), direct=2)
    assert {(r.split, r.row_id) for r in got.collect()} == {
        *(("test", i) for i in (0, 3, 6, 9, 12)),
        *(("train", i) for i in (1, 2, 4, 5, 7)),
    }
    with pytest.raises(ValueError):
        P.first_rows(df, -1)


@pytest.mark.parametrize("direct", [10, 10_000])
@pytest.mark.parametrize("val_size", [0.05, 0.333, 7])
def test_split_is_exact_and_a_disjoint_cover(spark, val_size, direct):
    df = spark.range(100_003).withColumnRenamed("id", "row_id")
    sides = P.create_train_val_split(df, val_size, direct=direct)
    held_out = val_size if isinstance(val_size, int) else math.ceil(100_003 * val_size)
    assert list(sides) == ["train", "validation"]
    assert sides["validation"].count() == held_out
    assert sides["train"].count() == 100_003 - held_out
    assert sides["train"].intersect(sides["validation"]).count() == 0
    by_hash = df.orderBy(
        F.md5(F.concat(F.lit("42:"), F.col("row_id").cast("string")).cast("binary")), "row_id"
    ).limit(held_out)
    assert sides["validation"].exceptAll(by_hash).count() == 0


def test_split_depends_on_the_seed_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")

    def held_out(seed):
        return {r.row_id for r in P.create_train_val_split(df, 0.1, seed)["validation"].collect()}

    assert held_out(1) == held_out(1) != held_out(2)
    for wrong in (0.0, 1.0, -0.2, 1000, 0):
        with pytest.raises(ValueError):
            P.create_train_val_split(df, wrong)


def test_key_text_order(spark):
    ids = [-(2**63), -5, -1, 0, 1, 9, 10, 2**42, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "i bigint")
    keys = [r.k for r in df.select(selection.ordered_hex(F.col("i")).alias("k")).collect()]
    assert keys == sorted(keys) and {len(k) for k in keys} == {16}
    assert [selection.from_ordered_hex(k) for k in keys] == ids


# Previews


def test_previews(spark):
    df = spark.createDataFrame([("abcde",), ("abcdef",), ("abc",)], "t string")
    rows = df.select(P.shorten(F.col("t"), 5), P.excerpt(F.col("t"), 5)).collect()
    assert [tuple(r) for r in rows] == [
        ("abcde", "abcde..."), ("abcde...", "abcde..."), ("abc", "abc..."),
    ]


# Plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_parse_runs_once(pairs):
    dpo = plan_of(P.prepare_for_dpo(pairs))
    assert dpo.count("split(") == 1 and "Exchange" not in dpo
    assert plan_of(P.prepare_for_sft(pairs)).count("split(") == 1
    counted = plan_of(P.prepare_for_dpo(pairs, P.native_tokenizer()))
    assert counted.count("split(") == 1 and counted.count("regexp_replace(") == 3
    chat = plan_of(P.prepare_for_sft(pairs, P.native_tokenizer()))
    hooked = plan_of(P.prepare_for_dpo(pairs, P.python_tokenizer(load_words)))
    assert hooked.count("ArrowEvalPython") == 1
    assert chat.count("split(") == 1 and chat.count("im_end") == 1


def test_sft_scan_skips_rejected(pairs):
    plan = plan_of(P.prepare_for_sft(pairs))
    assert "ReadSchema: struct<row_id:bigint,chosen:string>" in plan and "Exchange" not in plan


def test_row_filters_reach_the_scan(pairs):
    plan = plan_of(P.first_rows(P.prepare_for_dpo(pairs), 5))
    assert "LessThanOrEqual(row_id," in plan and "Exchange" not in plan


def test_bound_spares_the_counter(edges):
    native = P.native_tokenizer()
    everything = P.Tokenizer(native.count_all, native.render)
    for limits in ((300, 100), (2048, 1024), (900, None)):
        bounded, full = (P.prepare_for_dpo(edges, t, *limits) for t in (native, everything))
        assert keyed(bounded) == keyed(full)
        assert keyed(P.prepare_for_sft(edges, native, limits[0])) == (
            keyed(P.prepare_for_sft(edges, everything, limits[0]))
        )

    def load():
        def check(texts, truncation):
            assert all(len(t) > 20 for t in texts)
            return {"input_ids": [t.split() for t in texts]}

        return check

    hook = P.python_tokenizer(load, lambda text: F.length(text))
    df = edges.select("row_id", F.expr("concat('Human: a\n\nAssistant: ', repeat('b ', row_id))").alias("chosen"))
    kept = P.prepare_for_sft(df, hook, 21, use_chat_template=False)
    # "Human: a / Assistant: " and row_id times "b".
    assert sorted(keyed(kept)) == list(range(0, 19))


def test_native_bound_holds(spark):
    df = spark.createDataFrame([(t,) for t in ("", " ", "a", "a b", " a b ", "a b c", "ab c")], "t string")
    tok = P.native_tokenizer(special_per_call=2)
    rows = df.select(tok.count(F.col("t")).alias("n"), tok.most(F.col("t")).alias("most")).collect()
    assert [r.n for r in rows] == [2, 2, 3, 4, 4, 5, 4]
    assert all(r.n <= r.most for r in rows)


@pytest.mark.parametrize("direct", [2, 1000])
def test_repeated_keys_are_refused(spark, direct):
    df = spark.createDataFrame([(k % 4,) for k in range(40)], "row_id bigint")
    with pytest.raises(ValueError, match="not unique"):
        P.first_rows(df, 5, direct=direct).collect()
    with pytest.raises(ValueError, match="not unique"):
        P.with_split(df, 0.3, direct=direct).collect()
