from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.core import splitting, tidying

TEXT = st.text(alphabet="ab。，\n 中🚀", max_size=120)


def test_short_and_blank_texts():
    assert splitting.split(None) == splitting.split("") == splitting.split("  \n ") == []
    assert splitting.split(" a ") == ["a"]


def test_limit_is_strict():
    assert splitting.split("x" * 999) == ["x" * 999]
    # a piece of exactly the limit is no short piece: it goes down to characters and comes back whole
    assert splitting.split("x" * 1000) == ["x" * 1000]
    assert [len(c) for c in splitting.split("x" * 2500)] == [1000, 1000, 900]


def test_separator_stays_at_the_start():
    assert splitting.split("一二三。四五六", 4, 0) == ["一二三", "。四五六"] or splitting.split("一二三。四五六", 5, 0) == ["一二三", "。四五六"]


def test_overlap_repeats_the_end():
    a, b = splitting.split("aaaa bbbb cccc", 10, 5)[:2]
    assert a.split()[-1] == b.split()[0]


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(4, 30))
def test_split_keeps_text(text, size):
    parts = splitting.split(text, size, 0)
    assert all(0 < len(p) <= size for p in parts)
    assert "".join("".join(parts).split()) == "".join(text.split())


def test_repeats():
    assert tidying.without_repeats("GVG报名GVG报名GVG报名") == "GVG报名"
    assert tidying.without_repeats("abcabcabcabcxy") == "abcxy"
    assert tidying.without_repeats("abcabc") == "abcabc"
    assert tidying.without_repeats(None) is None
    assert tidying.without_repeats("abababababab") == "abab"


def slow_repeats(text):
    if len(text) < 10:
        return text
    for p in range(3, len(text) // 2 + 1):
        k = 1
        while text[k * p : (k + 1) * p] == text[:p]:
            k += 1
        if k > 1 and k * p >= 0.6 * len(text):
            return text[:p] + text[k * p :]
    return text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab", max_size=40))
def test_repeats_against_plain_search(text):
    got = tidying.without_repeats(text)
    assert got == slow_repeats(text)
    assert len(got) <= len(text)


def plain_split(text, size, overlap, separators):
    """The rules of the splitter as they are told, piece by piece."""
    if not text:
        return []
    sep, rest = separators[-1], []
    for i, x in enumerate(separators):
        if x == "" or x in text:
            sep, rest = x, separators[i + 1 :]
            break
    found = list(text) if sep == "" else [y for y in [text.split(sep)[0], *[sep + y for y in text.split(sep)[1:]]] if y]
    out, held = [], []

    def merge():
        current, total = [], 0
        for y in held:
            if total + len(y) > size and current:
                out.append("".join(current).strip())
                while total > overlap or (total + len(y) > size and total > 0):
                    total -= len(current.pop(0))
            current.append(y)
            total += len(y)
        out.append("".join(current).strip())
        held.clear()

    for y in found:
        if len(y) < size:
            held.append(y)
            continue
        merge()
        out.extend(plain_split(y, size, overlap, rest) if rest else [y])
    merge()
    return [y for y in out if y]


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(3, 30), st.integers(0, 6))
def test_split_against_the_plain_rules(text, size, overlap):
    assert splitting.split(text, size, min(overlap, size - 1)) == plain_split(text, size, min(overlap, size - 1), splitting.SEPARATORS)
