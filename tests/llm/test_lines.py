"""Lines that go and lines that stay, case by case."""

import random

from estrato.llm import linetemplates

WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"]


def _word(*key):
    return "".join(random.Random(repr(key)).choices("abcdefghijkl", k=8))


def _kept(docs, table):
    return {r.doc_id: r.text for r in linetemplates.drop_recurring(docs(table)).collect()}


def test_short_prose_stays(docs):
    table = [(i, f"I want to {_word(i)}\n{_word(i, 1)} {_word(i, 2)} {_word(i, 3)} of {_word(i, 4)}\nGo to the {_word(i, 5)} {_word(i, 6)}") for i in range(40)]
    assert _kept(docs, table) == dict(table)


def test_rows_of_numbers_stay_but_for_equal_ones(docs):
    table = [(i, f"{i} {i + 7} {i * 3}\n{1900 + i}\n{i} {i} {i} {i} {i} {i} {i}\n1 2 3 4 5 6 7") for i in range(40)]
    found = _kept(docs, table)
    assert found[0] == table[0][1] and all(found[i] == table[i][1].removesuffix("\n1 2 3 4 5 6 7") for i in range(1, 40))


def test_agreement_of_the_path_alone_is_not_enough(docs):
    table = [(i, "the house of " + " ".join(_word(i, j) for j in range(3))) for i in range(40)]
    assert _kept(docs, table) == dict(table)


def test_a_leaf_holds_several_templates(docs):
    """Mixtures of 60/40, of thirds, and of a template among prose, all of one token count and path."""
    one, two, three = ("sent on behalf {} by the list of friends", "sent on behalf to {} all members who asked", "sent on behalf as reply from our {} office")
    shares = [[one] * 60 + [two] * 40, [one, two, three] * 40]
    for forms in shares:
        table = [(i, form.format(_word(i)) + f"\nown {_word(i, 1)}") for i, form in enumerate(forms)]
        found, firsts = _kept(docs, table), {forms.index(form) for form in set(forms)}
        assert all(found[i] == (text if i in firsts else text.split("\n")[1]) for i, text in table)
    prose = [(i, "sent on behalf " + " ".join(random.Random(i).choices(WORDS, k=6))) for i in range(200)]
    table = prose + [(1000 + i, one.format(_word(i))) for i in range(30)]
    found = _kept(docs, table)
    assert all(found[i] == text for i, text in prose)
    assert found[1000] == table[200][1] and all(found[1000 + i] == "" for i in range(1, 30))


def test_two_variable_words_in_a_mixture(docs):
    """The values of a field are frequent, but no pair of them is.  Text 64 is a copy of the first one."""
    a = [f"user {WORDS[i % 8]} has sent {WORDS[100 + i // 8 % 8]} to the office" for i in range(128)]
    b = [f"user {_word(i)} has lost the old key yesterday" for i in range(100)]
    table = list(enumerate(["request from host " + x for x in a] + ["request from host " + x for x in b]))
    found = _kept(docs, table)
    assert {i for i in found if found[i]} == {0, 64, 128}


def test_a_field_that_templates_share_does_not_tear_them_apart(docs):
    """Three templates of one path and length, all with a field of two names, which is the most frequent token."""
    forms = ("the daily report {} says {} that payment number was not received", "the daily report {} says {} how often somebody opened our door", "the daily report {} says {} all seven members voted against it")
    table = [(3 * i + k, form.format(("anna", "bert")[i % 2], _word(i, k))) for i in range(36) for k, form in enumerate(forms)]
    found = _kept(docs, table)
    assert {i for i in found if found[i]} == {0, 1, 2}


def test_crowded_leaves_get_longer_paths(docs):
    forms = [f"sent on behalf {WORDS[k]} by {{}} of the list" for k in range(40)]
    table = [(100 * k + i, form.format(_word(i, k))) for k, form in enumerate(forms) for i in range(20)]
    for shapes in (4096, 20):
        found = {r.doc_id: r.text for r in linetemplates.drop_recurring(docs(table), linetemplates.Rule(shapes=shapes)).collect()}
        assert {i for i in found if found[i]} == ({0} if shapes == 4096 else {100 * k for k in range(40)})


def test_many_different_lines_of_one_text_go(docs):
    lines = [" ".join(_word(i, j) for j in range(20)) for i in range(3000)]
    table = [(1, "\n".join(lines)), (2, "own\n" + "\n".join(lines) + "\nend")]
    assert _kept(docs, table) == {1: table[0][1], 2: "own\nend"}


def test_long_equal_lines_go_from_the_second_text_on(docs):
    long, short = " ".join(_word("l", i) for i in range(50)), " ".join(_word("s", i) for i in range(10))
    digits = " ".join(_word("d", i) for i in range(49))
    table = [(i, f"own {_word(i)}\n{long}\n{short}\n{digits} {i}") for i in range(2)] + [(9, f"own\n{long} more")]
    found = _kept(docs, table)
    assert found[0] == table[0][1] and found[9] == table[2][1]
    assert found[1] == f"own {_word(1)}\n{short}\n{digits} 1"
