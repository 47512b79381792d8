"""URL filter against a plain search through all rules, with odd urls and rules."""

import random

import pyarrow as pa

from odd import both
from tidemark.llm import urls

ODD = [
    None, "", "no scheme", "://", "http://", "https://COM", "http://com/", "http://.com/x", "http://com./x", "http://Www.Example.COM/en/a?b#c",
    "http://example.com/en", "http://example.com?/en/", "http://example.com#/en/", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/é",
    "x://y://net/es/", "http://a.net/" + "q" * 300_000, "http://" + "a." * 2_000 + "net/es/", "ÀÉ://ÉXAMPLE.com/en/",
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for h, p, said in rules:
        p = p or ""
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p):
            rank = (len(h + p), len(h), said == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, said)
    return host, path, best[1] if best else None, best[2] if best else default


def test_nested_rules(spark):
    rng = random.Random(2)
    labels, steps = ["a", "b", "com", "net"], ["", "/", "/x", "/x/", "/x/y", "/z"]
    hosts = [".".join(rng.choices(labels, k=rng.choice([1, 2, 3, 4]))) for _ in range(40)]
    rules = [(rng.choice(hosts), rng.choice(steps), rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [("com", None, "block"), (None, "/x", "block"), ("", "/x", "block"), ("B.net", "/x", "allow"), rules[0]]
    # A third of all urls have one host.
    rows = [(i, f"http://{rng.choice(hosts) if i % 3 else 'b.a.com'}{rng.choice(steps)}{rng.choice(['', '/x/y/z', '?q', '#f'])}") for i in range(900)]
    rows += [(1000 + i, u) for i, u in enumerate(ODD)] + [(None, "http://a.com/x"), rows[3], rows[3]]
    shape = "page_id long, url string, host int, path int, rule int, verdict int, key int, piece int, id int"
    df = spark.createDataFrame([(i, u, *[0] * 7) for i, u in rows], shape).repartition(5)
    ruled = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = [tuple(r) for r in urls.judge_urls(df, ruled).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted([(i, *brute(u, rules)) for i, u in rows], key=key)
    assert urls.judge_urls(df.limit(0), ruled).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(df, ruled.limit(0), default="block").collect()} == {"block"}


def test_query_on_odd_urls(spark, tmp_path):
    n = len(ODD)
    table = pa.table({"page_id": pa.array([*range(n - 1), None], pa.int64()), "url": pa.array(ODD, pa.string()), "rule": ["x"] * n})
    got, want = both(spark, tmp_path, "op1_url_filter", "pages", table)
    assert got == want and len(got) == n
    got, want = both(spark, tmp_path, "op1_url_filter", "pages", table.slice(0, 0))
    assert got == want == []
