"""Spans against Python's regular expressions."""

import hashlib
import random

import brute
from estrato.llm import pii

LONG = ["a" * 100_000 + "@", "1." * 50_000, "1 " * 50_000, "+" + "1 " * 50_000, "a@b" + ".c" * 30_000, "+1" * 3_000]


def _report(df):
    return {r.doc_id: r for r in pii.report(df).collect()}


def test_base_spans(docs, texts):
    draw = random.Random(1)
    parts = ["a", "b.c", "@", "@x.y", ".", "-", "_", "+", "1", "255", "256", "0", "é", "😀", " ", "4111 1111 1111 1111", "+1 (555) 123-4567", "10.0.0.1", "(", ")", "a@b.c", "%", "\n", "4"]
    table = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(2000)] + [None, "", *LONG] + [t for _, t in texts("0.01")]
    found = _report(docs(list(enumerate(table))))
    for i, text in enumerate(table):
        spans = brute.base_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert [found[i][f"n_{k}"] for k in brute.PII] == [sum(s.startswith(k + ":") for s in spans) for k in brute.PII]
        assert [s for s in found[i].spans.split(",") if s.split(":")[0] in brute.PII] == spans


def test_checksums_and_context(docs):
    found = _report(docs([(1, "DE89370400440532013000 and DE88370400440532013000"), (2, "IBAN DE89 3704 0044 0532 0130 00."), (3, "ssn 123-45-6789"), (4, "part 123-45-6789"), (5, "call +1 555 123 4567"), (6, "on +1 555 123 4567")]))
    assert found[1].spans == "iban:0:22" and found[2].spans.startswith("iban:5:")
    assert found[3].n_ssn == 1 and found[4].n_ssn == 0
    assert float(found[5].scores) > float(found[6].scores)


def test_redact(docs):
    table = [(1, "x a@b.c y"), (2, None), (3, ""), (4, "none"), (4, "none"), (None, "10.0.0.1😀+1 (555) 123-4567"), (7, "4111 1111 1111 1111")]
    df = docs(table)
    out = pii.redact(df)
    assert out.columns == df.columns
    assert sorted((r.text or "" for r in out.collect())) == sorted(["x <EMAIL> y", "", "", "none", "none", "<IP>😀<PHONE>", "<CARD>"])


def test_overlapping_spans_go_together(docs):
    text = "+4111 1111 1111 111 1.2.3.4"
    clean = pii.redact(docs([(1, text)])).first().text
    assert not any(c.isdigit() for c in clean) or brute.base_spans(clean) == []


def test_only_dataframe_functions(docs):
    for df in (pii.report(docs([])), pii.redact(docs([]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and df.count() == 0


def test_many_spans_in_one_long_text(docs):
    """Positions and cuts of thousands of spans, in time that grows with the text."""
    text = " é ".join(f"user{i}@mail.example.org tel +49 30 1234{i % 10000:04d}5 漢" for i in range(6000))
    df = docs([(1, text), (2, "é" * 50_000 + " a@b.de " + "漢" * 50_000), (3, None), (4, "")])
    found = {r.doc_id: [s for s in r.spans.split(",") if s.split(":")[0] in brute.PII] for r in pii.report(df.select("doc_id", "text")).collect()}
    assert sorted(found[1]) == sorted(brute.base_spans(text)) and found[2] == ["email:50001:50007"]
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[1] == " é ".join(["<EMAIL> tel <PHONE> 漢"] * 6000) and clean[2] == "é" * 50_000 + " <EMAIL> " + "漢" * 50_000
    assert (clean[3], clean[4]) == (None, "")
