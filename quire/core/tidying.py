"""Small text rules that need loops, and the fixed values of image names."""

from __future__ import annotations

# Words that make a good image name, its length, and the name of last resort.
KEYWORDS = ("图", "表", "示意", "流程", "结构", "架构", "模型", "界面", "截图")
NAME_LENGTH = 18
NO_NAME = "图片"


def prefix_matches(text: str) -> list[int]:
    """For each position how many characters from there equal the start of the text."""
    n = len(text)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def without_repeats(text: str | None, least_text: int = 10, least_pattern: int = 3, ratio: float = 0.6) -> str | None:
    """The text with its start kept once, if that start repeats in a row over at least `ratio` of it.  The shortest
    such start counts; short and null texts stay as they are."""
    if text is None or len(text) < least_text:
        return text
    z, n = prefix_matches(text), len(text)
    for p in range(least_pattern, n // 2 + 1):
        times = z[p] // p + 1
        if times > 1 and times * p >= n * ratio:
            return text[:p] + text[times * p :]
    return text
