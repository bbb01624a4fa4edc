"""Fill-in-the-middle documents against plain Python over code points."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estrato.llm import fim
from estrato.llm.common import text_buffers


def _plain(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = [int(x, 16) for x in re.findall("." * 8, hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest())[:4]]
    p, q = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (units[:p], units[p:q], units[q:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=100, deadline=None)
@drawn(st.lists(st.integers(0, 7), max_size=300), st.integers(0, 8))
def test_wavelet_matrix(values, bound):
    matrix = fim.WaveletMatrix(np.array(values, np.uint8), 4)
    places = np.arange(len(values) + 1)
    assert matrix.below(places, bound).tolist() == [sum(v < bound for v in values[:i]) for i in places]


@settings(max_examples=200, deadline=None)
@drawn(st.lists(st.text(alphabet=st.sampled_from(list("abZ 1.\né漢🙂́")), max_size=30), min_size=1, max_size=6), st.data())
def test_cuts(texts, data):
    raw, offsets = text_buffers(pa.array(texts))
    units = fim.Units(raw, offsets)
    found = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert units.count.tolist() == [len(u) for u in found]
    wanted = [data.draw(st.integers(0, len(u))) for u in found]
    ends = units.cuts(np.array(wanted))
    heads = ["".join(u[:n]) for u, n in zip(found, wanted)]
    assert (ends - offsets[:-1]).tolist() == [len(h.encode()) for h in heads]
    assert units.chars(offsets[:-1], ends).tolist() == [len(h) for h in heads]


def test_table(spark, docs):
    rows = [(i, t) for i, t in enumerate([None, "", "a", "漢字 and words\r\n" * 40, "<P> inside", "x<S", "<", "word " * 200_000, "no<M>", "…" * 50_000, "a\x00b"])]
    rows += [(i, "one two <three> é 4") for i in range(20, 220)] + [(None, "no id at all"), (None, None)] + [(7, "word " * 200_000)] * 2
    found = fim.transform(docs(rows).selectExpr("*", "'old' AS form"))
    assert found.columns.count("form") == 1 and "score" in found.columns
    back = found.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(map(str, [(r.doc_id, *tuple(r)[2:7]) for r in back])) == sorted(map(str, [(d, *_plain(d, t)) for d, t in rows]))
    assert all(r.back == (r.text or "") for r in back)
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    assert fim.transform(docs([])).count() == 0
