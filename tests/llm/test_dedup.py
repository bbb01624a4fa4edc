"""Passages, lines and near-duplicates against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from estrato.llm import bagminhash, linetemplates, neardup, substring
from estrato.llm.components import components

BIG = 10**9


def _sorted(found):
    return sorted((tuple(r) for r in found), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_covers():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_repeated_passages(docs, texts):
    table = texts("0.001") + [(None, None), (1, ""), (5, "a " * 100), (6, "a " * 35), (7, "a b " * 36), (7, "a b " * 36), (8, " \n\t "), (9, "x y " * 40), (10, "w " * 30_000)]
    assert _sorted(substring.repeated_passages(docs(table)).collect()) == _sorted(brute.repeated_passages(table))


@pytest.mark.parametrize("period", [7, 13, 31])
def test_other_periods(docs, period):
    draw = random.Random(period)
    passage = [f"p{i}" for i in range(40)]
    table = [(i, " ".join([draw.choice("ab") + str(draw.random()) for _ in range(draw.randint(0, 50))] + passage[: draw.randint(30, 40)])) for i in range(30)]
    assert _sorted(substring.repeated_passages(docs(table), 35, period).collect()) == _sorted(brute.repeated_passages(table))


def test_lines(docs, texts):
    made = [(BIG + i, f"User u{i} logged in from host h{i} via ssh\nbody {chr(97 + i % 26) * 3} x{chr(97 + i % 7)} y\n\nAlpha beta gamma {chr(97 + i % 26)} delta epsilon") for i in range(60)]
    table = texts("0.01") + made + [(BIG, None), (BIG, ""), (None, "User u1 logged in from host h9 via ssh\r\nq"), (7, "\n\n"), (8, "solo line\n" * 5_000)]
    df = docs(table)
    out = linetemplates.drop_recurring(df, dropped="gone")
    assert out.columns == [*df.columns, "gone"]
    found, want = _sorted(out.select("doc_id", "text", "gone").collect()), _sorted(brute.without_lines(table))
    assert found == want and sum(r[2] for r in want) > 100


def test_variable_words_are_generalised(docs):
    """The field holds a new word each time, without a digit."""
    names = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(30)]
    table = [(i, f"sent on behalf of {name} by the list\nown text {name}") for i, name in enumerate(names)]
    found = {r.doc_id: r.text for r in linetemplates.drop_recurring(docs(table)).collect()}
    assert found[0] == table[0][1] and all(found[i] == f"own text {names[i]}" for i in range(1, 30))


def test_signatures_are_unbiased():
    a = [f"w{i}" for i in range(60)]
    table = [" ".join(a), " ".join(a[:40] + [f"z{i}" for i in range(20)]), " ".join(a[:10] * 6), " ".join(a[:10] * 3 + a[:20])]
    doc, hashes, weights = bagminhash.bags(pa.array(table), 1)
    signatures = bagminhash.signatures(doc, hashes, weights, 4, 20_000)
    bags = [bagminhash.elements(hashes[doc == i], weights[doc == i]) for i in range(4)]
    for i in range(4):
        for j in range(i):
            both = len(np.intersect1d(bags[i], bags[j]))
            assert (signatures[i] == signatures[j]).mean() == pytest.approx(both / (len(bags[i]) + len(bags[j]) - both), abs=0.02)


def test_near_duplicates(docs, texts):
    draw = random.Random(2)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(200)]
    near = []
    for i in range(60):  # copies that are near the base, not each other
        words = base[:]
        for _ in range(draw.randint(1, 3)):
            words[draw.randrange(200)] = f"n{draw.random()}"
        near.append((BIG + 100 + i, " ".join(words)))
    table = texts("0.01") + near + [(BIG, None), (BIG + 1, ""), (BIG + 2, " "), (BIG + 3, "a b"), (BIG + 4, "a b"), (BIG + 4, "a b"), (BIG + 5, "a"), (None, "x y z u v w"), (BIG + 7, "x y z u v w"), (None, None)]
    df = docs(table)
    found = _sorted(neardup.classes(df).select("doc_id", "class_id").collect())
    assert found == _sorted(brute.near_classes(table))
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns
    words = [r for r in kept.select("doc_id", "text").collect() if (r.text or "").strip()]
    assert sorted(r.doc_id for r in words) == sorted({c for (_, c), (_, t) in zip(brute.near_classes(table), table) if (t or "").strip()})
    assert kept.count() == len(words) + 4


def test_blocks_leave_no_pair_out(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    words = [f"w{i}" for i in range(100)]
    table = [(i, " ".join(words[:50] + [f"x{i}"] + words[50:])) for i in range(40)]
    assert {r.class_id for r in neardup.classes(docs(table)).collect()} == {0}


@pytest.mark.parametrize("block", [2, 5, 16, 1024])
def test_chains_and_clusters_in_blocks(docs, monkeypatch, block):
    """Many texts share bands with a least text that they are not linked with: chains, clusters and strangers."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    draw = random.Random(block)
    words = [f"w{i}" for i in range(300)]
    table = [(i, " ".join([f"c{j}" for j in range(6 * i)] + words[6 * i :])) for i in range(30)]  # each near the next only
    for group in range(3):
        base = words[:150] + [f"g{group}_{i}" for i in range(60)]
        for _ in range(15):
            text = base[:]
            text[draw.randrange(150, 210)] = f"n{draw.random()}"
            table.append((len(table), " ".join(text)))
    draw.shuffle(table)
    assert _sorted(neardup.classes(docs(table)).select("doc_id", "class_id").collect()) == _sorted(brute.near_classes(table))


def test_overlap_with_and_without_bits(monkeypatch):
    draw = np.random.default_rng(0)
    bags = [np.unique(draw.integers(0, 400, 150)).astype(np.uint64) for _ in range(20)]
    for i in range(20):
        others = np.array([j for j in range(20) if j != i])
        want = [len(np.intersect1d(bags[i], bags[j])) for j in others]
        assert neardup.overlap(bags)(i, others).tolist() == want
        with monkeypatch.context() as patch:
            patch.setattr(neardup, "BITS", 0)
            assert neardup.overlap(bags)(i, others).tolist() == want


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 101), (100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(51)} | {(100, 100), (101, 100)}


def test_empty_tables(docs):
    for found in (substring.repeated_passages(docs([])), linetemplates.drop_recurring(docs([])), neardup.classes(docs([])), neardup.one_of_each(docs([]))):
        assert found.count() == 0
