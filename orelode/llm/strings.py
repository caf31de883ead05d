"""String helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import unicodedata

#: Letters without a decomposition that are written with plain ones.
PLAIN = str.maketrans({"ß": "ss", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "æ": "ae", "œ": "oe", "đ": "d", "ı": "i"})


def ascii_fold(text: str) -> str:
    """Without accents, other characters kept."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.translate(PLAIN)) if not unicodedata.combining(c))


def squash(text: str) -> str:
    """Spelling habits levelled: doubled letters, ou/u, y/i, ph/f, c/k, w/v, z/s."""
    t = text.replace("ph", "f").replace("ou", "u").replace("sch", "sh").replace("ck", "k")
    t = re.sub(r"c(?!h)", "k", t).translate(str.maketrans("ywzq", "ivsk"))
    return re.sub(r"(.)\1+", r"\1", t)


def damerau(a: str, b: str, most: int = 99) -> int:
    """True Damerau-Levenshtein distance (a metric), or ``most`` + 1 once it must be larger.

    Only the band of ``most`` cells beside the diagonal is computed: what lies outside of it, a
    transposition across a longer gap included, costs more than ``most``.
    """
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m
    over = most + 1
    last: dict[str, int] = {}
    # row i holds the columns from max(0, i - most) on, framed so that both neighbours exist
    rows = [[over, *range(min(m, most) + 1), over]]
    for i in range(1, n + 1):
        low, high = max(0, i - most), min(m, i + most)
        x = a[i - 1]
        row = [over] * (high - low + 3)
        at = 1 - low  # of column 0 in this row
        up, up_at = rows[i - 1], 1 - max(0, i - 1 - most)
        seen, least = 0, over
        if not low:
            row[at] = least = i
        for j in range(max(1, low - over), high + 1):
            y = b[j - 1]
            if j >= low:
                above = up[up_at + j] if up_at + j < len(up) else over
                best = min(up[up_at + j - 1] + (x != y), row[at + j - 1] + 1, above + 1)
                k = last.get(y, 0)
                if k and seen:
                    far = seen - 1 - max(0, k - 1 - most) + 1
                    if 0 < far < len(rows[k - 1]):
                        best = min(best, rows[k - 1][far] + i - k + j - seen - 1)
                row[at + j] = best
                if best < least:
                    least = best
            if x == y:
                seen = j
        if least > most:
            return over
        rows.append(row)
        last[x] = i
    low = max(0, n - most)
    return min(rows[n][m - low + 1], over) if m >= low else over


def deletions(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out."""
    found = level = {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found
