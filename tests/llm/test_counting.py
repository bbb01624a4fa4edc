"""Token counts against the library's encoding of whole texts."""

import numpy as np
import pytest
import sentencepiece
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from estrato.llm import counting
from estrato.llm.queries import PIECES, QUERIES


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_model_allows_cuts():
    assert counting.loaded(PIECES)[1]


@settings(max_examples=300, deadline=None)
@drawn(st.text(alphabet=st.sampled_from(list("ab  \t\n▁é漢🙂<s>/unk0.")) | st.characters(exclude_categories=["Cs"]), max_size=60), st.integers(1, 9))
def test_pieces_have_the_tokens_of_the_whole(text, size):
    processor = counting.loaded(PIECES)[0]
    parts = counting.pieces(text, size)
    assert " ".join(parts) == text
    assert sum(len(processor.encode(p)) for p in parts) == len(processor.encode(text))


def test_balanced():
    sizes = np.array([5] * 100 + [400] + [0, 0])
    places = counting.balanced(sizes, 300)
    assert places[0] == 0 and places[-1] == len(sizes) and (np.diff(places) > 0).all() and len(places) == 4
    assert counting.balanced(np.zeros(0, np.int64), 300).tolist() == [0]


def test_table(spark, docs, library):
    long = "word " * 30_000 + "x" * 100_000 + "  tail  "
    rows = [(1, None), (2, ""), (3, " "), (4, "   two  words "), (5, long), (5, long), (6, "<s> </s> <unk>"), (7, "漢字" * 50_000), (None, "no id"), (8, "\x00 a")]
    found = counting.token_counts(docs(rows).selectExpr("*", "'old' AS n_tokens"), PIECES)
    assert found.columns[:2] == ["doc_id", "text"] and found.columns.count("n_tokens") == 1
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect())
    counts = [len(library.encode(t or "")) for _, t in rows]
    assert got == sorted((d or 0, len((t or "").encode()), n, n > 4096) for (d, t), n in zip(rows, counts))
    assert counting.token_counts(docs([]), PIECES).count() == 0


def test_query(spark, given, texts, library):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op12_token_counts"](spark, given("0.01")).collect()}
    want = {}
    for doc, text in texts("0.01"):
        n = len(library.encode(text or ""))
        want[doc] = (len((text or "").encode()), n, n > 4096)
    assert found == want
