"""Sanitising beside plain patterns and plain counts."""

import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotloom.llm import queries, sanitise
from spotloom.llm.rows import ROW, with_row

from .conftest import ODD_ROWS

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(c) for c in digits[::-1][::2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def plain_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        found = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(m.span())
        out[kind] = found
    return out


PIECES = ["a@b.c", "x.y+z@mail-1.example.org", "@", ".", "1.2.3.4", "300.1.1.1", "0001.2.3.255.7.7.7.7", "4111 1111 1111 1111", "4111111111111111",
          "5500-0000-0000-0004", "+1 (743) 555-3824", "+", "12", " ", "-", "é", "日本", "word", "\n", "(", "1", "+49 30 1234567"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_match_the_patterns(text):
    assert sanitise.base_spans(text) == plain_spans(text)


def test_long_runs_are_read_in_one_pass():
    for unit in ("a", "1", "1.", "+(", "a@", "@", "1 ", ".9"):
        text = unit * (400_000 // len(unit))
        found = sanitise.base_spans(text + " me@here.org")
        assert found["email"][-1][1] == len(text) + 12


def corpus():
    """Texts in which a nickname and a number reveal an address, and others do not."""
    filler = [f"common{i % 7} plain{i % 5} usual{i % 3}" for i in range(400)]
    rows = []
    for i, f in enumerate(filler):
        text = f"{f} words about thing{i} and matter{i * 7}"
        if i % 40 == 0:
            text = f"alpha{i} beta{i} write zorbulator or magenta{i} to jo.doe@mail.example.com about gamma{i} gamble{i}"
        elif i % 40 == 1:
            text = f"delta{i} ring Rosebud77 on +1 (743) 555-3824 {f} rosette"
        elif i % 10 == 2:
            text = f"{f} rosemary ring and write about roses{i} today"
        rows.append((i, text, "en", "s", len(text)))
    rows += [(1000 + i, "copied silverfish jane@copy.example.org lantern", "en", "s", 1) for i in range(30)]
    return rows


def expected_actions(texts, threshold=0.9, support=3, window=8, stem=3):
    near, own = {}, {}
    for text in texts:
        spans = plain_spans(text)
        plain = list(text)
        for kind in spans:
            for a, b in spans[kind]:
                plain[a:b] = " " * (b - a)
        words = [(m.start(), m.group().lower()) for m in re.finditer(r"\w{3,}", "".join(plain))]
        only = [w for _, w in words]
        seen = set()
        for i, w in enumerate(only):
            for t in {w, w[:stem] + "*" if len(w) > stem else w}:
                if t not in seen:
                    seen.add(t)
                    own.setdefault(t, set()).add(" ".join(only[max(0, i - window) : i + window + 1]))
        here = {}
        for kind in spans:
            for a, b in spans[kind]:
                c = sanitise.entity(kind, text[a:b])
                left = [w for p, w in words if p < a][-window:]
                right = [w for p, w in words if p >= b][:window]
                around = sanitise._around(left + right)
                for w in left + right + [""]:
                    for t in {w, w[:stem] + "*" if len(w) > stem else w}:
                        here[c, t] = min(around, here.get((c, t), around))
        for key, around in here.items():
            near.setdefault(key, set()).add(around)
    n = len(set(texts))
    shown = set()
    for (c, t), arounds in near.items():
        if t and len(arounds) >= support:
            n_c, n_ct, n_t = len(near[c, ""]), len(arounds), len(own[t])
            if n > n_c and math.log2(min(n_ct, n_t) * n / (n_c * n_t)) / math.log2(n / n_c) >= threshold:
                shown.add(t)
    return {
        t: "generalised" if len(t) > stem and t[:stem] + "*" not in shown else "removed" for t in shown if not t.endswith("*")
    }


@pytest.mark.parametrize("shipped", [10_000, 1])
def test_terms_that_reveal_an_entity(spark, documents, shipped):
    rows = corpus()
    docs = documents(rows).repartition(4)
    want = expected_actions([r[1] for r in rows])
    got = {r["t"]: r["action"] for r in sanitise.disclosing(docs, shipped=shipped).collect()}
    assert got == want and got["zorbulator"] == "removed" and got["rosebud77"] == "generalised"
    assert "write" not in got and "about" not in got and "silverfish" not in got
    found = {r["doc_id"]: r for r in sanitise.sanitise(docs, "doc_id", shipped=shipped).collect()}
    assert found[0]["text"].startswith("alpha0 beta0 write [...] or")
    assert "[email]" in found[0]["text"] and "zorbulator" not in found[0]["text"]
    assert "ring Ros* on [phone]" in found[1]["text"]
    assert all(found[r[0]]["text"] == r[1] for r in rows if r[0] < 1000 and r[0] % 40 > 1)
    assert found[1000]["text"] == "copied silverfish [email] lantern"
    for r in rows:
        own = [tuple(s) for s in found[r[0]]["spans"]]
        base = [(k, *s) for k, v in plain_spans(r[1]).items() for s in v]
        assert own[: len(base)] == base and all(k in ("generalised", "removed") for k, *_ in own[len(base) :])


def test_query_gives_the_base_of_every_text(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op11(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        spans = plain_spans(text or "")
        base = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in spans[k])
        row = got[doc_id]
        assert [row[f"n_{k}"] for k in PATTERNS] == [len(spans[k]) for k in PATTERNS]
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and row["spans"].startswith(base)


def test_odd_rows_and_clashing_columns(spark, documents):
    odd = with_row(documents(ODD_ROWS).repartition(3))
    got = sanitise.sanitise(odd).collect()
    texts = {r[ROW]: r["text"] for r in odd.collect()}
    assert len(got) == len(ODD_ROWS) and all(r["spans"] == [] and r["text"] == texts[r[ROW]] for r in got)
    more = odd.withColumns({c: F.lit("x@y.zz") for c in ("spans", "t", "c", "n", "_id", "own", "action")})
    assert sorted(map(str, sanitise.sanitise(more).collect())) == sorted(map(str, got))
    assert sanitise.sanitise(with_row(documents([]))).collect() == []
    some = documents([(1, "x +1 (743) 555-3824 and 1.2.3.4", "en", "s", 1)] * 2)
    assert [r["text"] for r in sanitise.sanitise(with_row(some)).collect()] == ["x [phone] and [ip]"] * 2
