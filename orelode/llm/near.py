"""All pairs of near strings and of near readings of names, inside one group that fits a task."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import cache
from itertools import combinations

import numpy as np

from orelode.llm.strings import damerau, deletions

#: Longer strings meet by their ends, of which one has at most half of the edits.
LONG, END = 32, 16
_RND = np.random.default_rng(1)
_LETTER, _PLACE = (_RND.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (1 << 8, LONG + 1))


@cache
def _kept(n: int, d: int) -> np.ndarray:
    """The positions that are left of ``n`` by ``d`` left out, one row each way."""
    return np.array(list(combinations(range(n), n - d)), np.int16).reshape(-1, n - d)


def _hashes(codes: np.ndarray, d: int) -> np.ndarray:
    """Hashes of what is left of each of some strings of one length by ``d`` letters left out."""
    kept = _kept(codes.shape[1], d)
    out = np.zeros((len(codes), len(kept)), np.uint64)
    for j in range(kept.shape[1]):
        out += _LETTER[codes[:, kept[:, j]]] * _PLACE[j]
    return out


def near_strings(strings: list[str], most: Callable[[int, int], int], asked: list[bool]) -> set[tuple[int, int]]:
    """All pairs (i < j) of different strings within ``most`` edits, of which one at least is ``asked``.

    ``most`` takes both lengths and gives at most 3.  Strings within k edits keep a common rest of
    k letters less than the longer has, so rests of that length are hashed and joined by equality.
    """
    by_length: dict[int, list[int]] = defaultdict(list)
    ends: dict[tuple[str, bool], list[int]] = defaultdict(list)
    for i, s in enumerate(strings):
        if len(s) <= LONG:
            by_length[len(s)].append(i)
        if len(s) > LONG - 3:
            for end, side in ((s[:END], False), (s[-END:], True)):
                for w in deletions(end, 1):
                    ends[w, side].append(i)
    found: set[tuple[int, int]] = set()
    for ids in ends.values():
        found.update((i, j) for i, j in combinations(ids, 2) if max(len(strings[i]), len(strings[j])) > LONG)
    codes = {n: np.frombuffer("".join(strings[i] for i in ids).encode("latin-1", "replace"), np.uint8).reshape(len(ids), n) for n, ids in by_length.items() if n}
    for lb in codes:
        for la in codes:
            k = most(la, lb)
            if not lb - k <= la <= lb:
                continue
            rest = max(lb - k, 0)
            if not rest:  # short enough for all to be near
                found.update((min(i, j), max(i, j)) for i in by_length[la] for j in by_length[lb] if i != j)
                continue
            b = _hashes(codes[lb], lb - rest)
            a = b if la == lb else _hashes(codes[la], la - rest)
            order = np.argsort(b, axis=None)
            flat, wide = b.ravel()[order], b.shape[1]
            lo, hi = np.searchsorted(flat, a.ravel(), "left"), np.searchsorted(flat, a.ravel(), "right")
            n = hi - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            x, y = np.repeat(np.arange(a.size) // a.shape[1], n), order[at] // wide
            if la == lb:
                x, y = x[x < y], y[x < y]
            for p in np.unique(x * len(by_length[lb]) + y).tolist():
                i, j = by_length[la][p // len(by_length[lb])], by_length[lb][p % len(by_length[lb])]
                found.add((min(i, j), max(i, j)))
    found = {(i, j) for i, j in found if asked[i] or asked[j]}
    return {(i, j) for i, j in found if damerau(strings[i], strings[j], k := most(*sorted((len(strings[i]), len(strings[j]))))) <= k}


def _word(la: int, lb: int) -> int:
    return 1 if min(la, lb) <= 4 else 2 if max(la, lb) <= 8 else 3


def _near_words(words: dict[str, bool], most: Callable[[int, int], int]) -> dict[str, set[str]]:
    listed = sorted(words)
    near = {w: {w} for w in listed}
    for i, j in near_strings(listed, most, [words[w] for w in listed]):
        near[listed[i]].add(listed[j])
        near[listed[j]].add(listed[i])
    return near


def near_parts(kind: str, parts: list[tuple[str, ...]], joined: Callable[[list[str]], str], squash: Callable[[str], str], asked: list[bool]) -> set[tuple[int, int]]:
    """Pairs (i < j) of readings that may be near, all that ``names.edits`` accepts among them but for
    those of which neither is ``asked``.

    Words are compared once, and readings found by pairs of near words; readings of more words by
    all but one of them; and those without initials by what they are run together, in either order.
    """
    found: set[tuple[int, int]] = set()
    pair = lambda i, j: found.add((min(i, j), max(i, j))) if i != j and (asked[i] or asked[j]) else None

    def of(keys: dict[int, list[str]]) -> dict[str, bool]:
        words: dict[str, bool] = {}
        for i, ks in keys.items():
            for k in ks:
                words[k] = words.get(k, False) or asked[i]
        return words

    def meet(keys: dict[int, list[str]], most: Callable[[int, int], int]) -> None:
        held: dict[str, list[int]] = defaultdict(list)
        for i, ks in keys.items():
            for k in set(ks):
                held[k].append(i)
        for k, others in _near_words(of(keys), most).items():
            for o in others:
                for i in held[k]:
                    for j in held[o]:
                        pair(i, j)

    if kind == "p":
        meet({i: [squash(p[0])] for i, p in enumerate(parts)}, lambda a, b: min(2, _word(a, b)))
        return found
    near = _near_words(of({i: [w for w in p if len(w) > 1] for i, p in enumerate(parts) if len(p) <= 2}), _word)
    one, two, any_ = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, p in enumerate(parts):
        if len(p) == 1:
            one[p[0]].append(i)
        elif len(p) == 2:
            two[tuple(sorted(p))].append(i)
            for w in set(p):
                any_[w].append(i)
    for i, p in enumerate(parts):
        if len(p) == 1:
            for u in near.get(p[0], p):
                for j in one[u] if u in one else ():
                    pair(i, j)
        elif len(p) == 2 and min(map(len, p)) > 1:
            for u in near[p[0]]:
                for v in near[p[1]]:
                    for j in two.get((min(u, v), max(u, v)), ()):
                        pair(i, j)
        elif len(p) == 2:  # an initial: the other word is near one of the other name
            initial, word = sorted(p, key=len)
            for u in near.get(word, ()):
                for j in any_[u] if u in any_ else ():
                    rest = parts[j][1] if parts[j][0] == u else parts[j][0]
                    if rest[0] == initial[0]:
                        pair(i, j)
    rests: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for i, p in enumerate(parts):
        if len(p) > 2:
            whole = sorted(p)
            for rest in {tuple(whole[:k] + whole[k + 1 :]) for k in range(len(whole))}:
                rests[rest].append(i)
    for ids in rests.values():
        for i, j in combinations(ids, 2):
            pair(i, j)
    full = {i: [joined(list(p)), joined(list(p[::-1]))] for i, p in enumerate(parts) if min(map(len, p)) > 1}
    meet(full, lambda a, b: 2)
    return found
