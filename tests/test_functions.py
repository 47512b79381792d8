"""Column functions on the awkward values."""

import hashlib
import json
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.functions import canon, health, hierarchy, risk, text, urls


def lit(v, kind="string"):
    return F.lit(v).cast(kind)


@pytest.mark.parametrize(
    "raw, name",
    [("K1/a b", "K1_a_b"), ("__x__", "x"), ("a---b", "a---b"), ("é", ""), ("a__b", "a_b"), ("", "")],
)
def test_sanitize(one, raw, name):
    assert one(text.sanitize_name(lit(raw))) == name


def test_stable_id_falls_through_falsy(one):
    assert one(text.stable_id(lit(None), lit(""), lit("U 9"), lit("t"))) == "U_9"
    assert one(text.stable_id(lit(None), lit(""))) == "article"
    assert one(F.length(text.stable_id(lit("x" * 500)))) == 120


def test_base_id(one):
    assert one(text.base_id(lit("K1__2")), text.base_id(lit("K1__x")), text.base_id(lit("K__3__12"))) == (
        "K1", "K1__x", "K__3",
    )


@pytest.mark.parametrize("raw", [" a ", "  x\x1c", "\n\t", "", "a b", "\x85q　", "​z"])
def test_strip_is_unicode_aware(one, raw):
    assert one(text.strip(lit(raw))) == raw.strip()
    assert one(text.is_blank(lit(raw))) == (raw.strip() == "")


def test_squeeze(one):
    assert one(text.squeeze(lit(" a\n\n b \tc "))) == "a b c"


@pytest.mark.parametrize(
    "raw", ["short", "x" * 200, "x" * 201, "a " * 3000, " " * 2500 + "y" * 300, "z" + " " * 5000 + "w" * 10, "é\n" * 900]
)
def test_sample_same_as_whole_text(one, raw):
    flat = " ".join(raw.split())
    want = flat[:200] + "…" if len(flat) > 200 else flat
    assert one(text.sample_of(lit(raw))) == want


def test_dates(one):
    ms = lit(1709294706000, "bigint")
    assert one(text.filter_date(ms)) == "2024/03/01@12:05:06"
    assert one(text.display_date(ms)) == "Mar 1, 2024"
    assert one(text.display_date(lit(0, "bigint")), text.display_date(lit(None, "bigint"))) == ("", "")
    assert one(text.file_stamp(F.timestamp_millis(ms))) == "2024-03-01T12-05-06-000000Z"


def test_cells(one):
    assert one(text.csv_cell(lit('a"b\nc'))) == '"a""b c"'
    assert one(text.csv_cell(lit(None))) == '""'
    assert one(text.md_cell(lit("a|b\nc"))) == "a\\|b c"


# ── canonical form ──


def test_canonical_sorts_every_level(one):
    v = F.parse_json(F.lit('{"b":[{"z":1,"a":2}],"a":{"y":null,"x":"é"}}'))
    assert one(canon.canonical_json(v)) == '{"a":{"x":"é","y":null},"b":[{"a":2,"z":1}]}'


def test_ascii_hash_is_byte_exact(spark):
    doc = {"b": 1.0, "a": ["é", {"d": None, "c": True}], "n": 10}
    want = hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    df = spark.createDataFrame([(json.dumps(doc, ensure_ascii=False),), (None,)], "t string")
    assert [r[0] for r in df.select(canon.ascii_hash("t")).collect()] == [want, None]
    native = df.limit(1).select(canon.canonical_hash(F.parse_json("t"))).first()[0]
    assert native != want


def test_content_hash_ignores_fetch_time(one):
    a = F.parse_json(F.lit('{"body_text":"x","fetchedAt":"1","bodySource":"u"}'))
    b = F.parse_json(F.lit('{"fetchedAt":"2","body_text":"x"}'))
    assert one(canon.content_hash(a)) == one(canon.content_hash(b))
    assert one(canon.content_hash(F.lit(None).cast("variant"))) == hashlib.sha256(b"{}").hexdigest()


def test_struct_hash_equals_variant_hash(one):
    s = canon.sorted_struct_hash(b=F.lit("é\n\"q\""), a=F.lit(3), c=lit(None))
    v = canon.canonical_hash(F.parse_json(F.lit('{"b":"é\\n\\"q\\"","a":3}')))
    assert one(s) == one(v)


@pytest.mark.parametrize(
    "doc, tracked, settled",
    [
        ('{}', False, False), ('{"body_text":"  "}', False, False), ('{"body_text":"x"}', True, True),
        ('{"fetchedAt":"x","bodySource":"y"}', False, False), ('{"bodyError":"e"}', False, True),
        ('{"sections":{}}', True, False), ('{"a":null}', False, False), ('{"n":0}', True, False),
        ('{"bodyError":5}', False, False), ('{"body_text":7}', True, False),
    ],
)
def test_two_body_readings(one, doc, tracked, settled):
    v = F.parse_json(F.lit(doc))
    assert one(canon.has_body(v), canon.body_settled(v)) == (tracked, settled)


@pytest.mark.parametrize(
    "doc, want", [('{"d":7}', 7), ('{"d":"7"}', None), ('{"d":null}', None), ('{}', None), ('{"d":7.9}', 7), ('{"d":true}', None),
                  ('{"d":1725000000000}', 1725000000000)]
)
def test_number_field_rejects_strings(one, doc, want):
    assert one(canon.number_field(F.parse_json(F.lit(doc)), "d")) == want


@pytest.mark.parametrize(
    "doc, want",
    [("null", "null"), ("true", "boolean"), ("1", "number"), ("1.5", "number"), ("1e30", "number"), ('"a"', "string"),
     ("[1]", "list"), ('[{"a":"(<"}]', "list"), ('{"a":[1]}', "object"), ("[]", "list"), ("{}", "object")],
)
def test_type_names(one, doc, want):
    assert one(canon.type_name(F.parse_json(F.lit(doc)))) == want


def test_body_text_prefers_current_key(one):
    v = lambda s: F.parse_json(F.lit(s))
    assert one(canon.body_text(v('{"bodyText":"old","body_text":"new"}'))) == "new"
    assert one(canon.body_text(v('{"bodyText":"old","body_text":3}'))) == "old"
    assert one(canon.consumer_body(v('{"body_text":" ","html":"<p>"}'), F.lit("html"))) == "<p>"


# ── risk ──


def flags(one, live, live_has, live_chars, has, chars, error=None):
    i = lambda v: lit(v, "int")
    return one(risk.risk_flags(F.lit(live), i(live_has), i(live_chars), i(has), i(chars), lit(error)))


def test_risk_flags(one):
    assert flags(one, False, None, None, 0, 0, "HTTP 404") == []
    assert flags(one, True, 1, 100, 0, 0) == ["body-dropped"]
    assert flags(one, True, 1, 100, 0, 0, "boom") == ["body-error", "body-dropped"]
    assert flags(one, True, 1, 100, 1, 50) == []
    assert flags(one, True, 1, 100, 1, 49) == ["body-shrank-51%"]
    assert flags(one, True, 1, 8, 1, 3) == ["body-shrank-62%"]  # 62.5 rounds half to even
    assert flags(one, True, 1, 0, 1, 0) == []  # HTML fields have no length here
    assert flags(one, True, 0, 0, 0, 0, "") == []


def test_flag_names_match_magnitudes(one):
    r = F.array(F.lit("body-shrank-42%"))
    assert one(risk.has_flag(r, "body-shrank")) is True
    assert one(risk.has_flag(r, "body")) is True
    assert one(risk.has_flag(r, "body-shr")) is False
    assert one(risk.is_held(r)) is False
    assert one(risk.is_held(F.array(F.lit("body-error")))) is True


@pytest.mark.parametrize(
    "msg, klass",
    [("HTTP 404", "not-found"), ("403 Forbidden", "forbidden"), ("Unauthorized", "forbidden"), ("read timed out", "timeout"),
     ("HTTP 429", "rate-limited"), ("failed to generate", "rate-limited"), ("HTTP 503", "server-error"), ("port 5033", "other"),
     ("no body sections extracted", "parse/empty"), ("Connection reset", "network"), ("?", "other"), ("fetch 404", "not-found")],
)
def test_error_classes(one, msg, klass):
    assert one(risk.classify_error(lit(msg))) == klass


def test_change_kind_and_body_op(one):
    k = lambda *p: one(risk.change_kind(F.array(*[F.lit(x) for x in p]).cast("array<string>")))
    assert [k("metadata", "content"), k("metadata"), k("content"), k()] == [
        "metadata+content", "metadata-only", "content-only", "no-op",
    ]
    assert one(risk.body_change_op(lit("e"), F.lit(True))) == "body-error"
    assert one(risk.body_change_op(lit(None), F.lit(True))) == "body-changed"
    assert one(risk.body_change_op(lit(""), F.lit(False))) == "body-added"


# ── health ──


def test_ages(one):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert one(health.age_hours(lit("2024-01-01T00:00:00Z"), now)) == 24.0
    assert one(health.age_hours(lit("junk"), now)) == 0.0
    assert one(health.age_seconds(lit("junk"), now, float("inf"))) == float("inf")
    t = lambda ms: one(health.age_text(lit(ms, "bigint")))
    assert [t(None), t(42_000), t(120_000), t(5_400_000), t(129_600_000)] == [
        "?", "42s ago", "2m ago", "1.5h ago", "1.5d ago",
    ]


def test_health_and_stall(one):
    h = lambda s, p: one(health.health_label(lit(s, "double"), F.lit(p)))
    assert [h(8 * 86400, True), h(60, True), h(None, False), h(7 * 86400, False)] == ["STALE", "PARTIAL", "OK", "OK"]
    s = lambda o, q, a, r: one(health.stall_class(F.lit(o), F.lit(q), lit(a, "double"), F.lit(r)))
    assert [s(False, False, 0.1, 9), s(True, False, None, 0), s(True, True, 0.5, 0), s(True, True, None, 3), s(True, True, 1.0, 0)] == [
        "orphan", "skip_active", "skip_active", "cap", "redrive",
    ]


def test_run_mode_status_phase(one):
    d = F.lit("2024-01-07").cast("date")  # a Sunday
    assert one(health.run_mode(d), health.run_mode(d, lit(" Incremental ")), health.run_mode(d, lit("x"))) == (
        "full", "incremental", "full",
    )
    st = lambda full, limited, exp, got, werr, fail: one(
        health.run_status(F.lit(full), F.lit(limited), lit(exp, "int"), F.lit(got), F.lit(werr), F.lit(fail))
    )
    assert [st(True, False, 5, 4, 0, False), st(True, True, 5, 4, 0, False), st(False, False, 5, 4, 0, False),
            st(False, False, None, 4, 1, False), st(True, False, 5, 5, 0, True)] == ["partial", "ok", "ok", "partial", "failed"]
    f = F.lit(False)
    assert one(health.run_phase(lit(""), f, F.lit(True), f, f)) == "approve"
    assert one(health.run_phase(lit("scrape"), F.lit(True), f, f, f)) == "scrape"


# ── urls, hierarchy ──


def test_urls(one):
    u = lit("https://Docs.Example.com/a/b.html?q=1#x")
    assert one(urls.host(u), urls.path(u), urls.first_segment(u)) == ("docs.example.com", "/a/b.html", "a")
    for raw in ("not a url", "", None, "https://u:p@h.example:8080/a b/c?x=/y#/z", "//h.example/p", "mailto:x@y"):
        p = urlparse(raw or "")
        assert one(urls.path(lit(raw))) == p.path
        if raw != "//h.example/p":
            assert one(urls.host(lit(raw))) == (p.hostname or "")


@pytest.mark.parametrize(
    "path, want",
    [
        ("/o/r", ("readme", "o", "r", None)), ("/o/r/issues/5", ("issue", "o", "r", "5")), ("/o/r/pull/6/files", ("pull", "o", "r", "6")),
        ("/o/r/blob/main/a/b.md", ("file", "o", "r", "a/b.md")), ("/o/r/issues", (None, "o", "r", None)), ("/o", (None, None, None, None)),
    ],
)
def test_repo_targets(one, path, want):
    t = one(urls.repo_target(lit("https://code.example" + path)))
    assert (t.kind, t.owner, t.repo, t.target) == want
    assert (t.error is None) == (want[0] is not None)


def test_item_url(one):
    assert one(urls.item_url(lit("12"), "https://x.example/ID{}.html", lit("l"))) == "https://x.example/ID12.html"
    assert one(urls.item_url(lit(""), "https://x.example/ID{}.html", lit("l"))) == "l"


def test_hierarchy(one):
    assert one(F.array(*hierarchy.path_levels(lit("A|17|17.1"), 4))) == ["A", "17", "17.1", None]
    assert one(hierarchy.path_prefixes(lit("A|17|17.1"))) == ["A", "A|17", "A|17|17.1"]
    assert one(hierarchy.comma_list(lit("1, 2,, 3.X "))) == ["1", "2", "3.X"]
    rows = one(hierarchy.applies_to(lit('[{"Product":"A"},{"Versions":["1","2"],"Product":"B"}]')))
    assert [(r.Product, r.Versions) for r in rows] == [("A", None), ("B", ["1", "2"])]
    assert one(hierarchy.applies_to(lit("junk"))) is None
