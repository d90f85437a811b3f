"""Recursive splitting of text on a ranked list of separators, with overlap between neighbours."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

# Separators in order of preference, size limit and overlap in code points.
SEPARATORS = ("\n\n", "\n", "。", "！", "？", "；", "，", " ", "")
SIZE, OVERLAP = 1000, 200


def leading_pieces(text: str, separator: str) -> list[str]:
    """Pieces that each start with the separator (but for the first); single characters for an empty one."""
    if not separator:
        return list(text)
    head, *tail = text.split(separator)
    return [p for p in (head, *(separator + t for t in tail)) if p]


def windows(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Joins of consecutive pieces up to `size`; each keeps from the one before what fits the overlap."""
    first = used = 0
    for last, piece in enumerate(pieces):
        if used + len(piece) > size and last > first:
            if joined := "".join(pieces[first:last]).strip():
                yield joined
            while used > overlap or (used and used + len(piece) > size):
                used -= len(pieces[first])
                first += 1
        used += len(piece)
    if joined := "".join(pieces[first:]).strip():
        yield joined


def split(text: str | None, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of a text.  The first separator that occurs cuts it; pieces not shorter than `size` are cut on by the
    separators after it and come out whole if none is left.  Null and empty texts give no chunk."""
    if not text:
        return []
    rank = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    later, out, short = separators[rank + 1 :], [], []
    for piece in leading_pieces(text, separators[rank]):
        if len(piece) < size:
            short.append(piece)
            continue
        out += windows(short, size, overlap)
        short = []
        out += split(piece, size, overlap, later) if later else [piece]
    return [*out, *windows(short, size, overlap)]
