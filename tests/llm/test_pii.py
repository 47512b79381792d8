"""Patterns, contexts and disclosure against plain regular expressions and counts."""

import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

ALPHABET = st.text(alphabet="aZ9.@_%+-4 1(é", max_size=40)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_patterns(text):
    want = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            want.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            want.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            want.append((m.start(), 3, m.end()))
    assert pii.base_spans(text) == sorted(want)


def test_luhn_and_long_runs():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.base_spans("1" * 300_000 + "@" + "a" * 300_000) == []
    assert pii.base_spans("a" * 100_000 + "@b.c_d@e.f") == [(0, 0, 100_004), (100_004, 0, 100_010)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, c long, t string")


def test_terms(spark):
    rows = [(i, f"note {'abcdefghijk'[i]} Zorblax mail joe@x.org now {i}", 1, "x") for i in range(5)]
    rows += [(10 + i, f"plain mail now {i} text", 1, "x") for i in range(40)]
    rows += [(90, None, 1, "x"), (91, "", 1, "x"), (None, "call +1 202 555 0100 22", 1, "x"), (0, rows[0][1], 1, "x")]
    got = {}
    for r in pii.find_private(frame(spark, rows).repartition(3), ["doc_id"]).collect():
        got.setdefault(r["doc_id"], []).append(sorted((s["start"], s["kind"], s["end"]) for s in r["spans"]))
    assert len(rows) == sum(map(len, got.values()))
    text = rows[0][1]
    at = text.index("Zorblax")
    assert (at, 4, at + 7) in got[0][0] and got[0][0] == got[0][1]
    # Brute force over the corpus: which terms reach the threshold?
    near = [t for t in ("note", "zorblax", "mail", "now") for _ in range(1)]
    docs = [(r[1] or "").lower() for r in rows]
    n, n_c = len(docs), sum("joe@x.org" in d for d in docs)
    for t in near:
        n_t = sum(bool(re.search(rf"\b{t}\b", d)) for d in docs)
        n_ct = sum("joe@x.org" in d and bool(re.search(rf"\b{t}\b", d)) for d in docs)
        told = math.log2(n_ct * n / (n_c * n_t)) >= math.log2(n / n_c) / pii.ALPHA
        spans = Counter(text[s:e].lower() for s, k, e in got[0][0] if k == 4)
        assert (t in spans) == told, t
    assert got[10] == [[]] and got[90] == [[]] and got[91] == [[]] and got[None][0][0][1] == 3


def test_sanitise(spark):
    rows = [(i, f"note {i} Zorblax mail joe@x.org", 1, "x") for i in range(5)] + [(7, None, 1, "x"), (8, "no data", 1, "x")]
    rows += [(20 + i, f"mail {i}", 1, "x") for i in range(30)]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert out[3].endswith("mail [EMAIL]") and "Zorblax" not in out[3] and "[NAME]" in out[3]
    assert out[7] is None and out[8] == "no data" and out[21] == "mail 1"
    assert pii.sanitise(frame(spark, [])).count() == 0
    assert pii.find_private(frame(spark, []), ["doc_id"]).count() == 0


def test_terms_far_from_their_entity(spark):
    """A name 300 characters away, in every document of an address, and again at the end, is found; brute force over all words."""
    far = " ".join(["plain words of a long text"] * 12)
    rows = [(i, f"Quixley wrote {'abcde'[i] * 3} {far} mail joe@x.org {far} then Quixley left", 1, "x") for i in range(4)]
    rows += [(10 + i, f"{far} plain mail now {i} wrote then left", 1, "x") for i in range(60)]
    rows += [(80, "only here bob@y.org with Onceword", 1, "x"), rows[0]]
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in pii.find_private(frame(spark, rows).repartition(3), ["doc_id"]).collect()}
    words = [set(re.findall(r"\w{2,}", r[1].lower())) for r in rows]
    has = ["joe@x.org" in r[1] for r in rows]
    n, n_c = len(rows), sum(has)
    told = set()
    for t in set().union(*(w for w, h in zip(words, has) if h)) - {"joe", "org"}:
        n_t, n_ct = sum(t in w for w in words), sum(t in w and h for w, h in zip(words, has))
        texts = len({r[1] for r, w, h in zip(rows, words, has) if h and t in w})
        if texts >= pii.MIN_TEXTS and math.log2(n_ct * n / (n_c * n_t)) >= math.log2(n / n_c) / pii.ALPHA:
            told.add(t)
    assert "quixley" in told
    for d, text, *_ in rows[:4]:
        want = [(m.start(), 4, m.end()) for m in re.finditer(r"\w{2,}", text) if m.group().lower() in told]
        assert [s for s in got[d] if s[1] == 4] == want and len(want) >= 2
    assert [s[1] for s in got[80]] == [0] and got[10] == []
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert "Quixley" not in out[2] and out[2].count("[NAME]") == 2 and "Onceword" in out[80]


def test_address_with_a_long_run_of_zeros():
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [(0, 1, 5006)]
    assert pii.base_spans("0" * 5000 + "256.1.1.1") == []
