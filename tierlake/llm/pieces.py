"""Word pieces of many texts at once, as the public byte-level BPE pattern cuts them.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Its matches depend only on the class of each code point and of its neighbours, so the
cuts of a whole batch come from a few array operations instead of a regex walk.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

OTHER, LETTER, NUMBER, SPACE, BREAK = 0, 1, 2, 3, 4

# The code points with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(0x110000, np.uint8)
    known = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, known):
            out[ord(known[m.start()]) : ord(known[m.end() - 1]) + 1] = kind
    out[WHITE_SPACE] = SPACE
    return out


def cut(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The joined text, starts and ends of its pieces, and for each text the index of
    its first piece (one more entry at the end)."""
    joined = "\n".join([*texts, ""])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(cp)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    breaks = np.cumsum(lengths + 1) - 1
    kind = classes()[cp]
    kind[breaks] = BREAK
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[breaks] = True
    edge[breaks[:-1] + 1] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    run = kind[start]
    # A run of white space before a visible character gives up its last character: a
    # plain space opens the next piece, any other stands alone.
    after = np.append(run[1:], BREAK)
    ws = (run == SPACE) & (after != BREAK)
    last = end[ws] - 1
    edge[last] = True
    edge[last[cp[last] == 0x20] + 1] = False
    # Contractions: an apostrophe that opens a piece and is followed by s, t, m, d, re, ve, ll.
    ap = start[(run == OTHER) & (end - start == 1) & (cp[start] == 0x27)]
    ap = ap[edge[ap]]
    if len(ap):
        one = cp[np.minimum(ap + 1, n - 1)]
        two = cp[np.minimum(ap + 2, n - 1)]
        is_c = lambda a, c: a == ord(c)
        single = is_c(one, "s") | is_c(one, "t") | is_c(one, "m") | is_c(one, "d")
        double = (is_c(one, "r") | is_c(one, "v")) & is_c(two, "e") | is_c(one, "l") & is_c(two, "l")
        for at, size in ((ap[single], 2), (ap[double], 3)):
            edge[at + 1] = False
            edge[at + size] = True
    edge[breaks] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    real = kind[start] != BREAK
    start, end = start[real], end[real]
    first = np.append(0, np.searchsorted(start, breaks))
    return joined, start, end, first


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    joined, start, end, first = cut(texts)
    return [joined[a:b] for a, b in zip(start.tolist(), end.tolist())], first
