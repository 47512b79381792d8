"""Page extraction, outcomes, merge and line diffs."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pages
from tidemark.operators import bodies

DOC = """<html><head><title>x</title></head><body><nav>menu</nav>
<main><h1>Big  <i>title</i></h1><!-- note -->
<p>One <b>bold</b> and <code>code</code>,<br>next <a href="../up.html">link</a></p>
<ul><li>first</li><li>second &amp; last</li></ul><div style="display: none">hidden</div><span style="DISPLAY:NONE">gone</span>
<button>go</button><script>var a = "</p>";</script></main></body></html>"""


def test_article_text(one):
    got = one(pages.article_text(F.lit(DOC)))
    assert got == "# Big title\n\nOne bold and code,\nnext link\n\n- first\n- second & last"
    assert one(pages.article_text(F.lit("plain &lt;x&gt;"))) == "plain <x>"
    assert one(pages.article_text(F.lit(None).cast("string"))) is None
    deep = "<body>" + "<div>" * 3000 + "<b>deep</b> <span style='display:none'>secret</span><i>x</i>" + "</div>" * 3000 + "</body>"
    assert one(pages.article_text(F.lit(deep))) == "deep x"


def test_nested_elements_of_hidden_and_dropped_ones(one):
    text = pages.page_text
    assert text('<div style="display:none"><div>a</div>SECRET</div><p>ok text</p>') == "ok text"
    assert text("<nav>a<nav>b</nav>c</nav>d<aside><form>e</form>f<aside>g</aside>h</aside>i") == "di"
    assert text("<section STYLE='x; Display : none'>a<div>b</section>c</div>d") == "c\n\nd"
    assert text("<p style='display:none'>a<p>b</p>c") == "b\n\nc"
    assert text("<header>a<nav>b</header>c</nav>d") == "d"
    assert one(pages.article_text(F.lit("<nav><nav>x</nav>y</nav>z"))) == "z"


def test_what_is_never_closed_stays():
    text = pages.page_text
    assert text("<nav>a<p>b") == "a\n\nb" and text("a<!-- b <i>c</i>") == "a<!-- b c".replace("<!-- b ", "")
    assert text("a<script>b</p>c") == "ab\n\nc" and text("a < b") == "a < b" and text("a<b") == "a<b"
    assert text("</nav>a</div>b<main>c") == "a\n\nbc" and text("") == ""
    assert text("<!-- <nav> -->a<script>'<nav>'</script>b</nav>c") == "abc"


def test_regions():
    text = pages.page_text
    assert text("x<article>a</article>y<main>b</main>z<main>c</main>w") == "bzc"
    assert text("x<main></main><article>a</article>y") == "a" and text("<main><nav>n</nav></main><body>b</body>") == "b"
    assert text("<nav><main>n</main></nav><body>b<main>m</main></body>") == "m" and text("a</main>b<main>c") == "abc"


def test_pages_of_unclosed_tags_take_linear_time():
    import time

    for tag in ("<nav>", "<nav", "<!--", "<script>", '<div style="display:none">', "<nav></nav>", "</nav>"):
        begun = time.process_time()
        pages.page_text(tag * (2_000_000 // len(tag)))
        assert time.process_time() - begun < 20, tag


def test_scan_and_patterns_agree_on_random_flat_pages():
    """The SQL's patterns are another way to the same text where no element stands in one of its kind."""
    import duckdb

    r, made = random.Random(4), []
    for _ in range(300):
        parts = []
        for _ in range(r.randrange(12)):
            tag = r.choice([*pages.DROPPED[2:], *pages.HIDDEN, "li", "h2", "b", "ul", "td"])
            hidden = r.choice(["", "", " style='display:none'", " class=x"])
            parts.append(r.choice(["t &lt; u", " a\n b ", "<br>", "<!-- c <nav> -->", "<hr/>", f"<{tag}{hidden}>in <i>side</i> </{tag}>", "<script>a<b>c</script>"]))
        made.append(r.choice(["%s", "<body>%s</body>", "x<main>%s</main>y", "<article> %s</article>"]) % "".join(parts))
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?::VARCHAR[]) AS html", [made])
    for html, want in con.execute(f"SELECT html, {pages.article_text_sql('html')} FROM t").fetchall():
        assert pages.page_text(html) == want, html


# ── the job ──

LONG = "word " * 20


@pytest.fixture
def results(spark):
    page = lambda body: f"<html><body><main>{body}</main></body></html>"
    data = [
        ("Manual", "ok", "https://d.example/a/x.html", None, page(LONG)),
        ("Manual", "short", "https://d.example/a/x.html", None, page("tiny")),
        ("Manual", "soft", "https://d.example/a/x.html", None, page("<h1>404 - Page Not Found</h1>" + LONG)),
        ("Manual", "soft2", "https://d.example/a/x.html", None, page("Sorry, The page you are looking for does not exist. " + LONG)),
        ("Manual", "moved", "https://d.example/a/x.html", "https://d.example/a/", page(LONG)),
        ("Manual", "stays", "https://d.example/a/x", "https://d.example/a/y/", page(LONG)),
        ("Manual", "kb", "https://d.example/a/x.html", "https://kb.example/s/article/K77?x", page(LONG)),
        ("Manual", "js", "https://js.example/x", None, page(LONG)),
        ("Manual", "nolink", "", None, None),
        ("Manual", "nopage", "https://d.example/x", None, None),
        ("Manual", "next", "https://n.example/x", None,
         '<script id="__NEXT_DATA__" type="application/json">' + json.dumps(
             {"props": {"pageProps": {"docData": {"compiledSource": f"/*import a*/x/* {LONG} */y/*{LONG}*/"}}}}) + "</script>"),
        ("Manual", "next2", "https://n.example/x", None, page(LONG) + '<script id="__NEXT_DATA__" type="application/json">{bad</script>'),
    ]
    work = spark.createDataFrame(data, "type_key string, id string, url string, final_url string, html string")
    out = bodies.extract_bodies(work, ("n.example",))
    return bodies.with_outcome(out, ["js.example"], "kb.example")


def test_outcomes(results):
    got = {r.id: (r.outcome, r.body_error) for r in results.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "ok": "ok", "short": "too-short", "soft": "soft-404", "soft2": "soft-404", "moved": "moved", "stays": "ok", "kb": "in-kb",
        "js": "js-rendered", "nolink": "no-link", "nopage": "raised", "next": "ok", "next2": "ok",
    }
    assert got["short"][1] == "extracted body too short (4 chars)"
    assert got["kb"][1].endswith("K77") and got["nopage"][1] == "no page landed"
    assert all((err is None) == (kind == "ok") for kind, err in got.values())
    body = {r.id: r.body_text for r in results.collect()}
    assert body["next"] == LONG.strip() + "\n\n" + LONG.strip()
    assert body["next2"] == LONG.strip() and body["kb"] is None


def test_report(spark, results):
    skipped = spark.createDataFrame([("Manual",), ("Old",)], "type_key string")
    got = sorted(tuple(r) for r in bodies.enrich_report(results, skipped).collect())
    assert got == [("Manual", 4, 8, 1, 13, 0), ("Old", 0, 0, 1, 1, 0)]


def test_work_selection_and_merge(spark):
    docs = ['{"body_text":"b","keep":1}', '{"bodyError":"e","sections":{"a":"b"},"keep":2}', '{"body_text":" "}', "{}"]
    df = spark.createDataFrame([("A", str(i), d) for i, d in enumerate(docs)], "type_key string, id string, j string").select(
        "type_key", "id", F.parse_json("j").alias("content"), F.lit("x").alias("body_text"), F.lit("x").alias("body_error"))
    due = lambda **kw: sorted(r.id for r in df.filter(bodies.due(df, **kw)).collect())
    assert due() == ["2", "3"] and due(refetch_errors=True) == ["1", "2", "3"] and due(refetch=True) == ["0", "1", "2", "3"]
    res = spark.createDataFrame(
        [("A", "1", "new", {"S": "t"}, None, "u1"), ("A", "3", None, None, "soft 404", "u3")],
        "type_key string, id string, body_text string, sections map<string,string>, body_error string, final_url string")
    out = bodies.merge_bodies(df, res, F.lit("now"))
    got = {r.id: r.j for r in out.select("id", F.to_json("content").alias("j")).collect()}
    assert got == {
        "0": docs[0], "1": '{"bodySource":"u1","body_text":"new","fetchedAt":"now","keep":2,"sections":{"S":"t"}}',
        "2": docs[2], "3": '{"bodyError":"soft 404","bodySource":"u3","fetchedAt":"now"}',
    }


def test_api_page(spark):
    spec = {"info": {"title": "T", "description": "D"}, "paths": {"/b": {"post": {"x-displayname": "N"}, "parameters": []},
            "/a": {"get": {"summary": "S", "description": "G"}, "head": {"summary": "no"}}, "/c": 5}}
    html = '<script id="__NEXT_DATA__" type="application/json">' + json.dumps({"props": {"pageProps": {"docData": {"swaggerFile": spec}}}}) + "</script>"
    df = spark.createDataFrame([(html,), ("<p>none</p>",), ("",)], "html string")
    got = [r.b for r in bodies.with_embedded_body(df, "b").collect()]
    assert got == ["# T\n\nD\n\n## GET /a\n\n**S**\n\nG\n\n## POST /b\n\n**N**", "", ""]


def test_repo_bodies(spark):
    import base64

    data = [
        ("issue", json.dumps({"body": " text \n"})), ("pull", json.dumps({"body": None})), ("file", "# raw\n"),
        ("readme", json.dumps({"encoding": "base64", "content": base64.b64encode("héllo".encode()).decode() + "\n"})),
    ]
    out = bodies.repo_body(spark.createDataFrame(data, "kind string, payload string"))
    assert [(r.kind, r.body_text, r.body_error) for r in out.collect()] == [
        ("issue", "text", None), ("pull", None, "empty repository pull body (no description)"), ("file", "# raw", None), ("readme", "héllo", None),
    ]


# ── line diffs ──


def test_line_delta(spark):
    rnd = random.Random(5)
    texts = []
    for i in range(40):
        old = [rnd.choice("abcd") * 3 for _ in range(rnd.randrange(60))]
        new = [x for x in old if rnd.random() < 0.95]
        if rnd.random() < 0.7:
            new.insert(rnd.randrange(len(new) + 1), "added")
        texts.append(("A", str(i), "\n".join(old), "\n".join(new)))
    df = spark.createDataFrame(texts, "type_key string, id string, old string, new string")
    side = lambda c: df.select("type_key", "id", F.col(c).alias("body_text"))
    delta = {r.id: (r.added, r.removed) for r in bodies.line_delta(side("old"), side("new")).collect()}
    for _, key, old, new in texts:
        a, b = Counter(old.split("\n")), Counter(new.split("\n"))
        want = (sum((b - a).values()), sum((a - b).values()))
        assert delta.get(key, (0, 0)) == want
