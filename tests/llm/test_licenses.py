"""Template automata against regular expressions made from the same markup, and defined results."""

import random
import re

import pytest

from millrace.llm import licenses
from millrace.llm.licenses import Any, Automaton, hash_of, parse, pattern

MARKUP = [
    "a b c",
    "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d",
    "<<beginOptional>>a b<<endOptional>> c <<var;name=\"x\";words=\"0-2\">> a",
    "<<var;name=\"x\";words=\"0-1\">> b <<var;name=\"y\";words=\"2-3\">> c <<beginOptional>>a<<endOptional>>",
    "a <<beginOptional>>a<<endOptional>> <<beginOptional>>a<<endOptional>> b",
    "c",
]


def plain(words, markup):
    """The longest accepted stretches, each searched behind the one before."""
    accepts = re.compile(pattern(parse(markup))).fullmatch
    out, i = [], 0
    while i < len(words):
        ends = [j for j in range(i + 1, len(words) + 1) if accepts("".join(w + " " for w in words[i:j]))]
        if ends:
            out.append((i, ends[-1]))
        i = ends[-1] if ends else i + 1
    return out


@pytest.mark.parametrize("markup", MARKUP)
def test_equals_regular_expressions(spark, markup):
    r = random.Random(markup)
    texts = [" ".join(r.choices("abcz", k=r.randint(0, 14))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = licenses.scan(docs, templates={"x": markup}, phrases={"p": "b c"}).collect()
    for row in got:
        words = texts[row.doc_id].split()
        assert [(m.start, m.end) for m in row.found] == plain(words, markup)
        assert [b.start for b in row.base] == [i for i in range(len(words)) if words[i : i + 2] == ["b", "c"]]


def rendered(r, items):
    """A text that a template accepts."""
    words = []
    for item in items:
        if isinstance(item, list):
            words += rendered(r, item) if r.random() < 0.5 else []
        elif isinstance(item, Any):
            words += ["filled"] * r.randint(item.least, item.most)
        else:
            words.append(item)
    return words


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_templates_accept_their_variants_and_nothing_with_another_wording(label):
    r = random.Random(label)
    items = parse(licenses.TEMPLATES[label])
    machine = Automaton.compile(label, licenses.TEMPLATES[label])
    mandatory = {w for w in items if isinstance(w, str)}
    for _ in range(30):
        words = rendered(r, items)
        hashes = [hash_of(w) for w in words]
        assert machine.longest(hashes, 0) == len(words)
        at = r.choice([i for i, w in enumerate(words) if w in mandatory])
        changed = re.fullmatch(pattern(items), "".join(w + " " for w in [*words[:at], "other", *words[at + 1 :]]))
        hashes[at] = hash_of("other")
        assert (machine.longest(hashes, 0) == len(words)) == bool(changed)


def test_markup_errors():
    for bad in ("<<beginOptional>>a", "a<<endOptional>>", "<<other>> a", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            Automaton.compile("x", bad)
    with pytest.raises(ValueError, match="mandatory"):
        Automaton.compile("x", '<<var;name="x";words="2-3">> a')


def test_documents(spark):
    mit = "Released under the\n* MIT   License."
    rows = [
        (1, mit, "x"), (1, mit, "x"), (2, None, "x"), (None, "", "x"), (3, "released under the, mit-licence", "x"),
        (4, "w " * 30_000 + "MIT License mit license. Licensed under the Apache License; Version 2.0", "x"),
        (5, "General Public License", "x"), (6, "under", "x"), (7, "mit", "x"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, found string").coalesce(1)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [tuple(m) for m in by_id[1].found] == [("mit-notice", 0, 5)] and [tuple(b) for b in by_id[1].base] == [("mit", 3)]
    assert all(by_id[i].found == [] and by_id[i].base == [] for i in (2, None, 3, 6, 7)) and by_id[2].n_words == 0
    assert [tuple(m) for m in by_id[4].found] == [("apache-2.0-notice", 30_004, 30_012)]
    assert [tuple(b) for b in by_id[4].base] == [("mit", 30_000), ("mit", 30_002), ("apache", 30_007)]
    assert [tuple(b) for b in by_id[5].base] == [("gpl", 0)]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
