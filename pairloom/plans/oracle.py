"""DuckDB SQL with the same results as the registered queries.

Written apart from the Spark code: it cuts text by string split and lists, and
ranks by window functions over the whole table.
"""

from __future__ import annotations

# Code points that count as blank, as in the text functions.
_BLANKS = [
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
]
_WS = " || ".join(f"chr({c})" for c in _BLANKS)
_NL2 = "chr(10) || chr(10)"


def _strip(x: str) -> str:
    return f"trim({x}, w.blanks)"


def _messages(x: str) -> str:
    marked = (
        f"string_split(regexp_replace({_strip(x)}, '\\n\\n(Human:|Assistant:)', "
        "chr(1) || '\\1', 'g'), chr(1))"
    )
    turns = f"list_transform({marked}, lambda t: {_strip('t')})"
    kept = (
        f"list_filter({turns}, lambda t: starts_with(t, 'Human:') OR starts_with(t, 'Assistant:'))"
    )
    return (
        f"list_transform({kept}, lambda t: CASE WHEN starts_with(t, 'Human:') "
        f"THEN {{'role': 'user', 'content': {_strip('substr(t, 7)')}}} "
        f"ELSE {{'role': 'assistant', 'content': {_strip('substr(t, 11)')}}} END)"
    )


def _rebuilt(m: str) -> str:
    return (
        f"coalesce(array_to_string(list_transform({m}, lambda x: "
        "CASE WHEN x.role = 'user' THEN 'Human: ' ELSE 'Assistant: ' END || x.content), "
        f"{_NL2}), '')"
    )


def _side(name: str, column: str, source: str) -> str:
    """CTE `<name>_side`: messages, prompt and response of a column of `source`."""
    roles = "list_transform(m, lambda x: x.role)"
    return f"""
{name}_m AS (SELECT row_id, {_messages(column)} AS m FROM {source}, consts AS w),
{name}_i AS (
  SELECT *, len(m) + 1 - list_position(list_reverse({roles}), 'assistant') AS last_reply
  FROM {name}_m),
{name}_side AS (
  SELECT row_id, m, {_rebuilt("m[1:coalesce(last_reply - 1, len(m))]")} AS prompt,
         CASE WHEN last_reply IS NULL THEN '' ELSE m[last_reply].content END AS response
  FROM {name}_i)"""


_PAIRS = f"""
consts AS (SELECT {_WS} AS blanks),
conv AS (
  SELECT conv_id AS row_id, {_NL2} || string_agg(
           CASE WHEN role = 'user' THEN 'Human: ' ELSE 'Assistant: ' END || text,
           {_NL2} ORDER BY turn, role, text) AS chosen
  FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id),
{_side("conv", "chosen", "conv")},
pairs AS (
  SELECT conv.row_id, conv.chosen,
         {_NL2} || a.prompt || {_NL2} || 'Assistant: ' || coalesce(b.response, a.response) AS rejected
  FROM conv JOIN conv_side AS a USING (row_id) LEFT JOIN conv_side AS b ON b.row_id = conv.row_id + 1)"""

_EDGES = f"""
edges AS (
  SELECT row_id, rejected, CASE ((row_id % 8) + 8) % 8
    WHEN 0 THEN chosen
    WHEN 1 THEN 'preamble' || {_NL2} || {_strip("chosen")}
    WHEN 2 THEN chosen || {_NL2} || 'Human: trailing'
    WHEN 3 THEN replace(chosen, {_NL2}, {_NL2} || {_NL2})
    WHEN 4 THEN replace(replace(chosen, 'Human:', 'human:'), 'Assistant:', 'assistant:')
    WHEN 5 THEN replace(chosen, {_NL2}, chr(13) || chr(10) || chr(13) || chr(10))
    WHEN 6 THEN chosen || {_NL2} || 'Assistant:'
    ELSE chr(160) || chr(12288) || chosen || ' ' || chr(12288) || chr(28) END AS chosen
  FROM pairs, consts AS w)"""


def _parsed(source: str) -> str:
    """CTEs down to `sft` and `dpo` over `source`."""
    return f"""{_side("chosen", "chosen", source)},{_side("rejected", "rejected", source)},
extracted AS (
  SELECT c.row_id, c.prompt, c.response AS chosen, r.response AS rejected
  FROM chosen_side AS c JOIN rejected_side AS r USING (row_id)),
sft AS (
  SELECT row_id, prompt || {_NL2} || 'Assistant: ' || response AS text, m AS messages
  FROM chosen_side),
dpo AS (SELECT * FROM extracted WHERE length(chosen) > 0 AND length(rejected) > 0)"""


def _with(select: str, source: str = "pairs", parsed: bool = True) -> str:
    parts = [_PAIRS]
    if source == "edges":
        parts.append(_EDGES)
    if parsed:
        parts.append(_parsed(source))
    return "WITH " + ",".join(parts) + "\n" + select


def _tokens(x: str) -> str:
    # Fixed value: a native token is a run of anything but ASCII blanks.
    return f"CAST(len(regexp_extract_all({x}, '[^ \\t\\n\\r\\f\\v]+')) AS BIGINT)"


def _chat(generation: bool = False) -> str:
    tail = " || '<|im_start|>assistant' || chr(10)" if generation else ""
    return (
        "coalesce(array_to_string(list_transform(m, lambda x: '<|im_start|>' || x.role || chr(10) "
        f"|| x.content || '<|im_end|>' || chr(10)), ''), ''){tail}"
    )


def _lengths(columns: list[str]) -> str:
    return ", ".join(
        f"CAST(sum(length({c})) AS DOUBLE) / count(*) AS {c}_mean, "
        f"CAST(min(length({c})) AS BIGINT) AS {c}_min, CAST(max(length({c})) AS BIGINT) AS {c}_max"
        for c in columns
    )


def _stats(source: str, columns: list[str], listed: str) -> str:
    return f"SELECT count(*) AS num_examples, {_lengths(columns)}, '{listed}' AS columns FROM {source}"


def _short(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) > {n} THEN left({c}, {n}) || '...' ELSE {c} END AS {c}"


# Messages as flat text: one row per message, or roles and contents joined.
_FLAT_MESSAGES = (
    "coalesce(array_to_string(list_transform(messages, lambda x: x.role || '=' || x.content), "
    "chr(30)), '') AS messages"
)

_POSITIONED = """
SELECT row_id, CAST(pos - 1 AS BIGINT) AS pos, m[pos].role AS role, m[pos].content AS content
FROM (SELECT row_id, m, unnest(range(1, len(m) + 1)) AS pos FROM chosen_side)"""

_FITS = f"""
SELECT row_id, prompt, chosen, rejected FROM (
  SELECT *, {_tokens("prompt")} AS p, {_tokens("chosen")} AS c, {_tokens("rejected")} AS r FROM dpo)
WHERE p + c <= {{most}} AND p + r <= {{most}}"""

_SPLIT = """
SELECT row_id, CASE WHEN rn <= ceil(n * 0.05) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT row_id, count(*) OVER () AS n,
             row_number() OVER (ORDER BY md5('42:' || row_id), row_id) AS rn FROM dpo)"""

# How the raw files are laid out; see the catalog.
_PLACED = """
SELECT row_id, chosen, rejected,
       CASE WHEN length(chosen) > 2500 THEN 'long' ELSE 'short' END AS subset,
       CASE WHEN chosen < rejected THEN 'test' ELSE 'train' END AS split
FROM pairs"""

# Rows of the raw files, numbered in file order.
_INGESTED = f"""
SELECT row_number() OVER (ORDER BY subset, split, row_id) - 1 AS row_id, chosen, rejected, subset, split
FROM ({_PLACED})"""

# The two prompts of each pair, and the number of the first message that differs.
_MISMATCH = f"""
WITH {_PAIRS}, {_EDGES}, {_parsed("edges")},
prompts AS (
  SELECT row_id, a.m[1:coalesce(a.last_reply - 1, len(a.m))] AS x, b.m[1:coalesce(b.last_reply - 1, len(b.m))] AS y
  FROM chosen_i AS a JOIN rejected_i AS b USING (row_id)),
places AS (SELECT *, unnest(range(1, greatest(len(x), len(y)) + 1)) AS turn FROM prompts)
SELECT row_id, turn, x[turn].role AS chosen_role, x[turn].content AS chosen_content,
       y[turn].role AS rejected_role, y[turn].content AS rejected_content
FROM places WHERE x[turn] IS DISTINCT FROM y[turn]
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY turn) = 1"""

# The raw files of the training split, as the job reads them.
_JOB = f"""WITH {_PAIRS}, files AS (SELECT * FROM ({_PLACED}) WHERE split = 'train'), {_parsed("files")}"""


def _job_stats() -> str:
    parts = [("sft", "text"), *(("dpo", c) for c in ("prompt", "chosen", "rejected"))]
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS format, '{c}' AS column, count(*) AS num_examples, "
        f"CAST(sum(length({c})) AS DOUBLE) / count(*) AS mean, CAST(min(length({c})) AS BIGINT) AS min, "
        f"CAST(max(length({c})) AS BIGINT) AS max FROM {kind}"
        for kind, c in parts
    )


def oracle_sql() -> dict[str, str]:
    dpo = "SELECT row_id, prompt, chosen, rejected FROM dpo"
    sft = f"SELECT row_id, text, {_FLAT_MESSAGES} FROM sft"
    extract = (
        "SELECT row_id, prompt, chosen AS chosen_response, rejected AS rejected_response "
        "FROM extracted"
    )
    halves = "SELECT row_id, prompt, response FROM chosen_side"
    rebuilt = f"SELECT row_id, {_rebuilt('m')} AS text FROM chosen_side"
    trainer_text = (
        f"SELECT row_id, prompt || {_NL2} || 'Assistant: ' || chosen AS text FROM dpo"
    )
    raw = "SELECT row_id, chosen, rejected FROM pairs"
    loaded = f"SELECT chosen, rejected, subset, split FROM ({_PLACED})"
    chat = f"SELECT row_id, {_chat()} AS text FROM chosen_side"
    tight = _FITS.format(most=300)
    sql = {
        # Sources and sinks
        "load_pairs": _with(loaded, parsed=False),
        "load_subset": _with(f"{loaded} WHERE subset = 'long'", parsed=False),
        "load_split": _with(f"{loaded} WHERE split = 'test'", parsed=False),
        "load_max_samples": _with(
            f"{loaded} WHERE subset = 'short' AND split = 'train' ORDER BY row_id LIMIT 12",
            parsed=False,
        ),
        "ingest_pairs": _with(_INGESTED, parsed=False),
        "split_loaded": f"""WITH {_PAIRS}, files AS ({_INGESTED}), {_parsed("files")}
SELECT row_id, prompt, chosen, rejected, CASE WHEN rn <= ceil(n * 0.05) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42:' || row_id), row_id) AS rn FROM dpo)""",
        "pair_count": _with("SELECT count(*) AS pairs FROM pairs", parsed=False),
        "json_roundtrip": _with(dpo, "edges"),
        "json_roundtrip_sft": _with(sft, "edges"),
        "trainer_sft": _with(trainer_text),
        "trainer_dpo": _with(dpo),
        "stream_sft": _with(f"SELECT text, {_FLAT_MESSAGES} FROM sft"),
        "stream_dpo": _with("SELECT prompt, chosen, rejected FROM dpo"),
        # Projections
        "parse_messages": _with(_POSITIONED),
        "parse_messages_edge": _with(_POSITIONED, "edges"),
        "prompt_response": _with(halves),
        "prompt_response_edge": _with(halves, "edges"),
        "reconstruct": _with(rebuilt),
        "reconstruct_edge": _with(rebuilt, "edges"),
        "extract_pair": _with(extract),
        "extract_pair_edge": _with(extract, "edges"),
        "chat_render": _with(chat, "edges"),
        "chat_render_generation": _with(
            f"SELECT row_id, {_chat(True)} AS text FROM chosen_side", "edges"
        ),
        "chat_render_hook": _with(chat, "edges"),
        "prepare_sft": _with(sft),
        "prepare_sft_edge": _with(sft, "edges"),
        "prepare_sft_chat": _with(
            f"SELECT row_id, text, {_FLAT_MESSAGES} FROM "
            f"(SELECT row_id, m AS messages, {_chat()} AS text FROM chosen_side) "
            f"WHERE {_tokens('text')} <= 2048",
            "edges",
        ),
        "prepare_dpo": _with(dpo),
        "prepare_dpo_edge": _with(dpo, "edges"),
        "sft_text_from_pairs": _with(trainer_text, "edges"),
        # Filters
        "dropped_empty": _with(
            "SELECT row_id, prompt, chosen, rejected FROM extracted "
            "WHERE length(chosen) = 0 OR length(rejected) = 0",
            "edges",
        ),
        "sft_length_filter": _with(f"{sft} WHERE {_tokens('text')} <= 300", "edges"),
        "dpo_length_filter": _with(f"{tight} AND p <= 100", "edges"),
        "dpo_length_noprompt": _with(tight, "edges"),
        "dpo_length_off": _with(dpo, "edges"),
        "dpo_length_hook": _with(f"{tight} AND p <= 100", "edges"),
        "token_count": _with(
            f"SELECT row_id, {_tokens('prompt')} AS prompt_tokens, "
            f"{_tokens('chosen')} AS chosen_tokens, {_tokens('rejected')} AS rejected_tokens FROM dpo"
        ),
        "token_count_documents": f"SELECT doc_id, {_tokens('text')} AS tokens FROM documents",
        # Aggregates
        "stats_raw": _with(
            "SELECT count(*) AS num_examples, 'chosen,rejected' AS columns FROM pairs", parsed=False
        ),
        "stats_sft": _with(_stats("sft", ["text"], "text,messages"), "edges"),
        "stats_dpo": _with(
            _stats("dpo", ["prompt", "chosen", "rejected"], "prompt,chosen,rejected"), "edges"
        ),
        "stats_documents": _stats("documents", ["text"], "text"),
        # First rows, previews, split
        "max_samples": _with(f"{raw} ORDER BY row_id LIMIT 40", parsed=False),
        "max_samples_per_split": _with(
            "SELECT row_id, chosen, rejected, split FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY split ORDER BY row_id) AS rn FROM ({_PLACED})) WHERE rn <= 15",
            parsed=False,
        ),
        "preview_raw": _with(
            "SELECT row_id, left(chosen, 500) || '...' AS chosen FROM pairs ORDER BY row_id LIMIT 1",
            parsed=False,
        ),
        "preview_sft": _with(
            f"SELECT row_id, {_short('text', 500)} FROM sft ORDER BY row_id LIMIT 3", "edges"
        ),
        "preview_dpo": _with(
            f"SELECT row_id, {_short('prompt', 300)}, {_short('chosen', 200)}, "
            f"{_short('rejected', 200)} FROM dpo ORDER BY row_id LIMIT 3",
            "edges",
        ),
        "preview_trainer_dpo": _with(
            "SELECT row_id, left(prompt, 100) || '...' AS prompt, left(chosen, 50) || '...' AS chosen, "
            "left(rejected, 50) || '...' AS rejected FROM dpo ORDER BY row_id LIMIT 1"
        ),
        "split_exact": _with(_SPLIT),
        "split_counts": _with(
            f"SELECT split, count(*) AS rows FROM ({_SPLIT}) GROUP BY split"
        ),
    }
    sql["trainer_dpo_extra"] = _with(
        "SELECT *, '{\"size\":' || length(prompt) || ',\"kind_' || ((row_id % 3 + 3) % 3) || "
        "'\":{\"a\":[1,null]}}' AS extra FROM dpo"
    )
    inst = (
        "'<s>' || coalesce(array_to_string(list_transform(m, lambda x: CASE WHEN x.role = 'user' "
        "THEN '[INST] ' || x.content || ' [/INST]' ELSE ' ' || x.content || '</s>' END), ''), '')"
    )
    sql["assemble"] = _with("SELECT row_id AS conv_id, chosen FROM conv", parsed=False)
    sql["chat_render_inst"] = _with(f"SELECT row_id, {inst} AS text FROM chosen_side", "edges")
    sql["prepare_sft_nulls"] = _with(f"{sft} WHERE row_id % 5 <> 0", "edges")
    sql["prepare_dpo_nulls"] = _with(f"{dpo} WHERE row_id % 5 <> 0 AND row_id % 7 <> 0", "edges")
    for name, text, most in (("chat", _chat(), 300), ("special", inst, 298)):
        sql[f"sft_{name}_length_filter"] = _with(
            f"SELECT row_id, text, {_FLAT_MESSAGES} FROM (SELECT row_id, m AS messages, {text} AS text "
            f"FROM chosen_side) WHERE {_tokens('text')} <= {most}",
            "edges",
        )
    # Each of two texts that are counted together has two marker tokens.
    sql["dpo_special_length_filter"] = _with(_FITS.format(most=296) + " AND p <= 98", "edges")
    other = _SPLIT.replace("ceil(n * 0.05)", "ceil(n * 0.3)").replace("'42:'", "'7:'")
    sql["split_other_seed"] = _with(other)
    sql["split_rows"] = _with(_SPLIT.replace("ceil(n * 0.05)", "17"))
    sql["split_hash"] = _with(
        "SELECT row_id, CASE WHEN substr(md5('42:' || row_id), 1, 8) < '0ccccccc' "
        "THEN 'validation' ELSE 'train' END AS split FROM dpo"
    )
    sql["split_saved"] = _with(
        f"SELECT dpo.* FROM dpo JOIN ({_SPLIT}) AS s USING (row_id) WHERE s.split = 'validation'"
    )
    sql["prompt_mismatch"] = _MISMATCH
    fits = _FITS.format(most=300) + " AND p <= 100"
    sql["funnel"] = _with(
        "SELECT n AS rows_in, 0::BIGINT AS nulls, u AS unparsed, n - u - f AS empty, f - k AS over_length, "
        "k AS kept FROM (SELECT (SELECT count(*) FROM edges) AS n, "
        "(SELECT count(*) FROM chosen_side WHERE len(m) = 0) AS u, (SELECT count(*) FROM dpo) AS f, "
        f"(SELECT count(*) FROM ({fits})) AS k)",
        "edges",
    )
    sql["job_sft"] = f"{_JOB} SELECT text, {_FLAT_MESSAGES} FROM sft"
    sql["job_dpo"] = f"{_JOB} SELECT prompt, chosen, rejected FROM dpo"
    sql["job_stats"] = f"{_JOB} {_job_stats()}"
    sql["job_stream"] = _with(
        f"SELECT 'sft' AS format, text, {_FLAT_MESSAGES}, NULL AS prompt, NULL AS chosen, NULL AS rejected "
        "FROM sft UNION ALL SELECT 'dpo', NULL, NULL, prompt, chosen, rejected FROM dpo"
    )
    sql["entry"] = sql["prepare_dpo"]
    return sql
