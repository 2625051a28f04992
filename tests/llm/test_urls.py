"""URL rules against a loop over all rules; cascades against sets."""

import random
import re

import numpy as np
import pytest

from pairloom.llm.tables import Scratch
from pairloom.llm.urls import build_cascade, judge_urls


def model(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_verdicts_match_a_loop_over_rules(spark):
    rng = random.Random(4)
    hosts = ["a", "b.a", "c.b.a", "x.a", "ba", "A.b", "", "a..b", "é.a"]
    paths = ["/", "/p", "/p/q", "/p/q/r", "", "//", "/é"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h in hosts[:6] for p in paths[:4] if rng.random() < 0.6}.values())
    rules += [("a", "/p", "block"), ("a", "/p", "allow")]
    urls = [None, "", "no", "://", "x://a", "http://B.A/p?://z", "a://b://c", "x://" + "y." * 300 + "a/" + "p" * 5000]
    urls += [f"{rng.choice(['http', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q', '#f', '/z'])}" for _ in range(400)]
    rows = [(i % 350, u, "was", i) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, n long")
    table = spark.createDataFrame([*rules, ("q", None, "block"), (None, "/", "allow")], "host string, path string, verdict string")
    got = judge_urls(pages, table)
    assert got.columns == ["page_id", "url", "n", "host", "path", "rule", "verdict"]
    have = sorted((r.n, r.host, r.path, r.rule, r.verdict) for r in got.collect())
    assert have == [(n, *model(u, rules)) for _, u, _, n in rows]
    assert judge_urls(pages.where("false"), table).collect() == []
    none = judge_urls(pages, table.where("false")).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")}


@pytest.mark.parametrize("listed, others", [(0, 50), (40, 4000), (600, 500), (50, 0)])
def test_cascade_is_exact(spark, listed, others):
    rng = np.random.default_rng(listed)
    keys = rng.integers(-(2**63), 2**63 - 1, (listed + others, 2))
    frame = lambda x: spark.createDataFrame(x.tolist(), "h1 long, h2 long")
    cascade = build_cascade(frame(keys[:listed]), frame(keys), Scratch(spark))
    got = cascade.listed(np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1]))
    assert got.tolist() == [k < listed for k in range(len(keys))]
    if listed == 600:
        with pytest.raises(ValueError, match="parts"):
            build_cascade(frame(keys[:listed]), frame(keys), Scratch(spark), most_bytes=16)
