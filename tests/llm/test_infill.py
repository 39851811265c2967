import hashlib
import re

import numpy as np
import pytest
from helpers import SF, awkward, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from hourweave.llm import infill


def plain(text, doc_id, units):
    """(n, form, prefix, middle, suffix) by the written rule, over code points."""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    parts = units(text)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100:
        return n, "plain", None, None, None
    return n, "spm" if h[3] % 100 < 50 else "psm", "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])


def lines(text):
    return re.findall("[^\n]*\n|[^\n]+", text)


def expected(text, doc_id, units=lines):
    n, form, p, m, s = plain(text, doc_id, units)
    if form == "plain":
        return n, form, None, None, text
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return n, form, len(p), len(m), out


def test_query_equals_the_rule(spark):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for i, t in documents():
        n, form, p, m, out = expected(t or "", i)
        want.append((i, n, form, p, m, sha(out), sha(t or "")))
    assert sorted(map(tuple, infill.op13_fill_in_middle(spark, SF).collect())) == want


@pytest.mark.parametrize("unit", ["line", "char"])
def test_awkward_documents(spark, unit):
    docs = awkward(spark)
    got = sorted(map(repr, (tuple(r) for r in infill.fill_in_middle(docs, unit).collect())))
    want = sorted(repr((r["doc_id"], *expected(r["text"] or "", r["doc_id"], lines if unit == "line" else list)))
                  for r in docs.collect())
    assert got == want
    assert infill.fill_in_middle(nothing(spark), unit).count() == 0


def test_texts_with_markers_stay_plain_and_rates_hold():
    for m in infill.MARKERS:
        assert infill.arrange(f"a{m}b\nc", 5)[1] == "plain"
    assert infill.arrange("a\nb", 5, rate=0)[1:] == ("plain", None, None, "a\nb")
    assert {infill.arrange("a\nb", i, spm_rate=100)[1] for i in range(30)} == {"spm"}
    with pytest.raises(ValueError):
        infill.check_markers(("<P>", "<P>x", "<M>"))
    with pytest.raises(ValueError):
        infill.check_markers(("aba", "S", "M"))


text = st.text(alphabet=st.sampled_from("ab<>PSM\n é你\U0001f600"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(text, st.integers(0, 10**6), st.sampled_from(["line", "char"]))
def test_round_trip(t, i, unit):
    n, form, p, m, out = infill.arrange(t, i, unit)
    assert (n, form, p, m, out) == expected(t, i, lines if unit == "line" else list)
    assert infill.restore(out, form) == t


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 7))
def test_index_converts_both_ways(t, size):
    infill.SLICE, whole = size, infill.SLICE  # slices of a few bytes cut inside characters
    try:
        data = t.encode()
        index = infill.Exceptions(data)
        assert index.chars == len(t)
        chars = np.arange(len(t) + 1)
        cuts = np.array([len(t[:k].encode()) for k in chars])
        assert list(np.broadcast_to(index.byte_of(chars), chars.shape)) == list(cuts)
        assert list(np.broadcast_to(index.char_of(cuts), cuts.shape)) == list(chars)
        assert len(index.at) == sum(ord(c) > 127 for c in t)
        ends = np.cumsum([len(x.encode()) for x in lines(t)])
        assert list(infill.line_ends(data)) == list(ends)
    finally:
        infill.SLICE = whole


def test_a_very_long_text():
    t = ("é" * 50 + "你\U0001f600 plain words\n") * 200_000  # 25 MB
    n, form, p, m, out = infill.arrange(t, 12)
    want = plain(t, 12, lines)
    assert (n, form, p, m) == (200_000, want[1], len(want[2]), len(want[3]))
    assert infill.restore(out, form) == t
