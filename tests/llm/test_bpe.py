"""Coding and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from estrato.llm import coding, packing
from estrato.llm.bpe import Bpe
from estrato.llm.queries import TOKENIZER

EDGES = [(1, None), (2, ""), (3, " "), (None, "null id"), (5, "twice"), (5, "twice"), (6, "<|endoftext|> x"), (7, "a" * 60_000), (8, " " * 40_000 + "b"), (9, "ab1'" * 20_000), (10, "é漢😀\x1c  　 x")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def test_tree_concatenation_is_exact(library):
    """Tiny pieces and windows on texts that hardly split."""
    coder, draw = Bpe(TOKENIZER, whole=24, window=2), random.Random(3)
    parts = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "'re", "é", "1", "22", "...", "!", "漢", "\xa0", " ", "\x1c", "<|endoftext|>", "😀", "s", "t", "ing"]
    for _ in range(3000):
        some = draw.sample(parts, draw.choice([1, 2, 3, 5, len(parts)]))
        text = "".join(draw.choice(some) for _ in range(draw.randint(0, 300)))
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == want, text
        assert coder.decode(np.array(want, np.uint32)) == library.decode(want, skip_special_tokens=False)


def test_long_unsplit_run(library):
    text = "".join(random.Random(1).choices("abcdefghij", k=200_000))
    assert Bpe(TOKENIZER).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_digests(docs, texts, library, rows):
    table = texts("0.001") + EDGES
    found = rows(coding.digests(docs(table), TOKENIZER))
    want = []
    for doc, text in table:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert found == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_round_trip_keeps_other_columns(docs, rows):
    there = coding.decode(coding.encode(docs(EDGES), TOKENIZER), TOKENIZER, text="back")
    assert there.filter("back <> coalesce(text, '')").count() == 0
    assert set(docs(EDGES).columns) < set(there.columns) and there.count() == len(EDGES)


def _check(pieces, table, library, size):
    """Every id in one piece, sequences without gaps, little padding."""
    want = {}
    for doc, text in table:
        want.setdefault(doc, []).append(library.encode(text or "", add_special_tokens=False).ids + [0])
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for doc, found in by_doc.items():
        left = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in found)
        for ids in want[doc]:
            at = 0
            while at < len(ids):
                nxt = next(x for x in left if x[0] == at and x[3] == len(ids) and zlib.crc32(np.array(ids[at : at + x[1]], "<u4").tobytes()) == x[2])
                left.remove(nxt)
                at += nxt[1]
            assert at == len(ids)
        assert not left
    padding = 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing(docs, texts, library):
    table = texts("0.001") + EDGES
    assert _check(packing.pack(docs(table), TOKENIZER).collect(), table, library, 1024) == 0
    assert _check(packing.pack(docs(EDGES), TOKENIZER, size=16).collect(), EDGES, library, 16) == 0


def test_sum_of_squares_rule():
    """The level chosen is the one that a plain sum of squares would choose."""
    draw, packer = random.Random(5), packing.Packer(32)
    for i in range(2000):
        need = draw.randint(1, 31)

        def cost(level):
            counts = packer.counts.copy()
            counts[level] -= level > 0
            counts[level + need] += level + need < 32
            return int((counts[1:32] ** 2).sum())

        open_levels = [0] + [h for h in range(1, 33 - need) if packer.counts[h]]
        assert cost(packer._level(need)) == min(map(cost, open_levels))
        list(packer.add(i, np.zeros(need, np.uint32)))


def test_empty_table(docs):
    assert coding.digests(docs([]), TOKENIZER).count() == 0
    assert packing.pack(docs([]), TOKENIZER).count() == 0
