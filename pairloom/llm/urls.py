"""URL rules judged with Bloom filter cascades: exact membership without a join.

A URL can only be fitted by rules made of a suffix of its host labels and a prefix
of its path. Those candidate keys, over all URLs, are the universe. For the rules
of each verdict a cascade is built: level 1 encodes the listed keys, level 2 the
keys of the universe that level 1 takes for listed, level 3 the listed keys that
level 2 takes for those, and so on until a level has no false positives. A key is
listed if the first level that misses it is an even one. Only filters, whose size
follows the list and not the corpus, are broadcast.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch
from .words import mix

_HASHES = "h1 long, h2 long"


def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, times: int) -> np.ndarray:
    """Bits of keys in a level's filter, one row per key; levels hash independently."""
    salt = np.uint64(2 * level + 1)
    a = mix(mix(h1.view(np.uint64) ^ salt) + h2.view(np.uint64))
    b = mix(a ^ h2.view(np.uint64)) >> np.uint64(20)
    a = a >> np.uint64(20)
    return ((a[:, None] + np.arange(times, dtype=np.uint64) * (b[:, None] | np.uint64(1))) % np.uint64(bits)).astype(np.int64)


@dataclass
class Cascade:
    """levels: (bits, hash functions, filter bytes), of listed and of false keys in turn."""

    levels: list[tuple[int, int, bytes]] = field(default_factory=list)

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, times, packed = self.levels[level]
        at = positions(h1, h2, level, bits, times)
        table = np.frombuffer(packed, np.uint8)
        return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe the cascade was built on."""
        out = np.zeros(len(h1), bool)
        open_keys = np.arange(len(h1))
        for level in range(len(self.levels)):
            out[open_keys] = level % 2 == 1
            open_keys = open_keys[self.passes(level, h1[open_keys], h2[open_keys])]
        out[open_keys] = len(self.levels) % 2 == 1
        return out


def _filter_of(keys: DataFrame, count: int, rate: float, level: int, most_bytes: int) -> tuple[int, int, bytes]:
    """A Bloom filter of so many keys, its words gathered by OR."""
    times = max(1, math.ceil(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(count * times / math.log(2) / 64))
    if bits // 8 > most_bytes:
        raise ValueError(f"a filter of {bits // 8} bytes is over {most_bytes}; judge the rules in parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(positions(*(batch.column(c).to_numpy() for c in ("h1", "h2")), level, bits, times))
            heads = np.flatnonzero(np.r_[True, (at[1:] >> 6) != (at[:-1] >> 6)]) if len(at) else at
            each = np.uint64(1) << (at & 63).astype(np.uint64)
            words = np.bitwise_or.reduceat(each, heads) if len(at) else each
            yield pa.record_batch([pa.array(at[heads] >> 6), pa.array(words.view(np.int64))], names=["word", "marks"])

    packed = bytearray(bits // 8)
    words = keys.select("h1", "h2").mapInArrow(run, "word long, marks long")
    for row in words.groupBy("word").agg(F.bit_or("marks").alias("marks")).toLocalIterator():
        packed[8 * row["word"] : 8 * row["word"] + 8] = row["marks"].to_bytes(8, "little", signed=True)
    return bits, times, bytes(packed)


def _passing(keys: DataFrame, cascade: Cascade) -> DataFrame:
    """Keys that the last level takes for its own."""
    shared = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            hit = pa.array(shared.value.passes(len(shared.value.levels) - 1, h1, h2))
            yield pa.record_batch([c.filter(hit) for c in batch.columns], schema=batch.schema)

    return keys.select("h1", "h2").mapInArrow(run, _HASHES)


def build_cascade(
    listed: DataFrame, universe: DataFrame, scratch: Scratch, most_bytes: int = 1 << 28
) -> Cascade:
    """A cascade of listed keys (h1, h2), exact over them and the universe (h1, h2, repeats allowed)."""
    cascade = Cascade()
    own = scratch.put(listed.distinct(), "listed")
    count = own.count()
    if not count:
        return cascade
    everyone = universe.agg(F.approx_count_distinct("h1", 0.02)).first()[0]
    rate = min(0.5, max(1e-6, count * 0.5**0.5 / max(everyone, 1)))
    cascade.levels.append(_filter_of(own, count, rate, 0, most_bytes))
    false = _passing(universe, cascade).distinct().join(own, ["h1", "h2"], "left_anti")
    false = scratch.put(false, "false")
    while count := false.count():
        cascade.levels.append(_filter_of(false, count, 0.5, len(cascade.levels), most_bytes))
        own, false = false, scratch.put(_passing(own, cascade), "false")
    return cascade


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; empty without ://."""
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Host suffixes by label, joined with path prefixes of these lengths; longest first."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    keys = F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(
                fitting,
                lambda n: F.struct(
                    (-F.length(h) - n).alias("less"),
                    (-F.length(h)).alias("host"),
                    F.concat(h, F.substring(path, F.lit(1), n)).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    most_bytes: int = 1 << 28,
) -> DataFrame:
    """pages with host, path, rule (host and path of the rule that fits, or null), verdict.

    rules: (host, path, verdict), verdict allow or block. A rule fits its host and
    all subdomains if the path of the URL starts with that of the rule; the longest
    rule wins, of equally long ones that with the longer host, of equal ones block.
    A URL that no rule fits gets the default: no cascade lists any of its keys. A
    null URL, or one without ://, has an empty host and path. Rules with a null part
    are left out. Columns of pages with the names of the result are replaced; the
    others stay. Repeated rows stay repeated.
    """
    scratch = Scratch(pages.sparkSession)
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    names = ["host", "path", "rule", "verdict"]
    own = pages.select(*[c for c in pages.columns if c not in names or c == url])
    keyed = (
        own.withColumn("__host", url_host(F.col(url)))
        .withColumn("__path", url_path(F.col(url)))
        .withColumn("__keys", candidate_keys(F.col("__host"), F.col("__path"), lengths or [0]))
        .withColumn("__h1", F.transform("__keys", lambda k: F.xxhash64(k)))
        .withColumn("__h2", F.transform("__keys", lambda k: F.xxhash64(F.lit(1), k)))
    )
    pairs = keyed.select(F.explode(F.arrays_zip("__h1", "__h2")).alias("k"))
    universe = scratch.put(pairs.select(F.col("k.__h1").alias("h1"), F.col("k.__h2").alias("h2")).distinct(), "universe")
    key = F.concat("host", "path")
    hashed = rules.select("verdict", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    cascades = {
        v: build_cascade(hashed.where(F.col("verdict") == v).drop("verdict"), universe, scratch, most_bytes)
        for v in ("block", "allow")
    }
    shared = pages.sparkSession.sparkContext.broadcast(cascades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("__h1")
            h1, h2 = (batch.column(c).flatten().to_numpy() for c in ("__h1", "__h2"))
            owner = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
            found = np.full(len(batch), -1)
            verdict = np.full(len(batch), default, dtype=object)
            for v in ("allow", "block"):  # of an equal key block comes last and stays
                at = np.flatnonzero(shared.value[v].listed(h1, h2))[::-1]
                best = np.full(len(batch), -1)
                best[owner[at]] = nth[at]  # in reverse, so the first key of a URL stays
                better = (best >= 0) & ((found < 0) | (best <= found))
                found[better], verdict[better] = best[better], v
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("__h1", "__h2")]
            left = [n for n in batch.schema.names if n not in ("__h1", "__h2")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found), pa.array(verdict, pa.string())], names=[*left, "__at", "__verdict"]
            )

    schema = keyed.drop("__h1", "__h2").withColumn("__at", F.lit(0).cast("long")).withColumn("__verdict", F.lit("")).schema
    judged = keyed.mapInArrow(run, schema)
    return judged.select(
        *own.columns,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.when(F.col("__at") >= 0, F.get("__keys", F.col("__at").cast("int"))).alias("rule"),
        F.col("__verdict").alias("verdict"),
    )


URL_SQL = r"""
WITH parts AS (
    SELECT page_id, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS named,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), hosts AS (
    SELECT page_id, path,
        translate(named, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts
), rules(rule_host, rule_path, says) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, says,
        row_number() OVER (PARTITION BY page_id
            ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) AS nth
    FROM hosts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM fits WHERE nth = 1
"""
