"""String similarity scores.

``ratio(a, b)`` is ``round(100 * 2 * LCS(a, b) / (|a| + |b|))`` with
round-half-to-even, 0 when either side is empty: the indel similarity.
``partial_ratio`` compares the shorter string with windows of the longer one.  The
two are taken apart into matching blocks: the longest common stretch (the earliest of
several, in the shorter string first), then the same left and right of it.  A window
starts where a block, moved to the beginning of the shorter string, would start; one
more ends with the longer string.  A window has the shorter string's length or ends
with the longer one.  The best ratio counts.  Of strings of equal length the text is
the shorter one, in ``weighted_ratio`` the query.
``weighted_ratio`` is the best of the ratio and, by how far the lengths lie apart, the
sorted-token and token-set ratios (x0.95) or their window forms and the window ratio
(x0.9, x0.6 beyond a factor 8).  The token set form compares the common words, and
these with each side's own words, all sorted and once each.

The longest common subsequence is bit-parallel: ``V`` starts as ones over the
pattern's length and every text character with position mask ``M`` does
``U = V & M;  V = (V + U) | (V - U)``; LCS is the number of zeros.  One pattern
runs against many texts at once as numpy vectors of 64-bit limbs, and its masks
are made once.  A pair is scored only if an upper bound can reach the threshold:
no common subsequence is longer than the number of characters in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

LIMB = 64
#: Windows that one step of a subsequence count covers.
WINDOWS_AT_ONCE = 1 << 17


class Texts:
    """Strings as a matrix of character codes (-1 beyond the end)."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        self.length = np.array([len(s) for s in strings], dtype=np.int64)
        self.codes = np.full((len(strings), int(self.length.max(initial=0))), -1, dtype=np.int64)
        for row, s in zip(self.codes, strings):
            row[:len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def take(self, rows: np.ndarray) -> Texts:
        out = Texts.__new__(Texts)
        out.strings = [self.strings[i] for i in rows]
        out.length, out.codes = self.length[rows], self.codes[rows]
        return out

    def in_common(self, pattern: str) -> np.ndarray:
        """How many characters each text has in common with the pattern."""
        total = np.zeros(len(self.length), dtype=np.int64)
        for c in set(pattern):
            total += np.minimum((self.codes == ord(c)).sum(axis=1), pattern.count(c))
        return total


def _masks(pattern: str, codes: np.ndarray) -> np.ndarray:
    """The pattern's position masks at every code: (limbs, *codes.shape)."""
    limbs = -(-len(pattern) // LIMB)
    out = np.zeros((limbs, *codes.shape), dtype=np.uint64)
    for c in set(pattern):
        at = codes == ord(c)
        for limb in range(limbs):
            bits = sum(1 << i for i, x in enumerate(pattern[limb * LIMB:(limb + 1) * LIMB]) if x == c)
            if bits:
                out[limb][at] = bits
    return out


def _lcs(pattern: str, masks: np.ndarray) -> np.ndarray:
    """LCS of the pattern with texts given as masks (limbs, texts, characters)."""
    limbs, texts, width = masks.shape
    size = [min(LIMB, len(pattern) - i * LIMB) for i in range(limbs)]
    full = [np.uint64((1 << s) - 1) for s in size]
    v = [np.full(texts, f, dtype=np.uint64) for f in full]
    for at in range(width):
        carry = np.zeros(texts, dtype=np.uint64)
        for i in range(limbs):
            u = v[i] & masks[i, :, at]
            total = v[i] + u
            over = total < u
            total = total + carry
            carry = (over | (total < carry)).astype(np.uint64)
            v[i] = (total | (v[i] & ~u)) & full[i]
    return len(pattern) - sum(np.bitwise_count(x).astype(np.int64) for x in v)


def lcs(pattern: str, texts: Texts) -> np.ndarray:
    """LCS length of the pattern with every text."""
    if not pattern or not texts.codes.size:
        return np.zeros(len(texts.length), dtype=np.int64)
    return _lcs(pattern, _masks(pattern, texts.codes))


def _percent(numerator: np.ndarray, denominator: np.ndarray | int) -> np.ndarray:
    return np.rint(100.0 * (numerator.astype(np.float64) / denominator)).astype(np.int64)  # rint: half to even


def ratio_scores(query: str, texts: Texts) -> np.ndarray:
    """F1a of the query with every text."""
    out = np.zeros(len(texts.length), dtype=np.int64)
    rows = np.flatnonzero((texts.length > 0) & (len(query) > 0))
    if len(rows):
        some = texts.take(rows)
        out[rows] = _percent(2 * lcs(query, some), len(query) + some.length)
    return out


def _in_windows(pattern: str, codes: np.ndarray) -> np.ndarray:
    """How many characters each window has in common with the pattern, (texts, starts)."""
    m, (rows, width) = len(pattern), codes.shape
    total = np.zeros((rows, width), dtype=np.int32)
    for c in set(pattern):
        upto = np.zeros((rows, width + m), dtype=np.int32)
        np.cumsum(codes == ord(c), axis=1, out=upto[:, 1:width + 1])
        upto[:, width + 1:] = upto[:, width:width + 1]
        total += np.minimum(upto[:, m:] - upto[:, :width], pattern.count(c))
    return total


def _window_ratios(pattern: str, texts: Texts, least: int = 0) -> np.ndarray:
    """The ratio of the pattern with every window of every text, (texts, starts); 0 for
    windows that cannot reach ``least``: they have too few characters in common."""
    m, width = len(pattern), texts.codes.shape[1]
    out = np.zeros(texts.codes.shape)
    step = max(1, WINDOWS_AT_ONCE // max(1, width))
    for at in range(0, len(out), step):
        codes = texts.codes[at:at + step]
        size = np.minimum(m, texts.length[at:at + step, None] - np.arange(width))  # a window may end with the text
        row, start = np.nonzero((size > 0) & (200.0 * _in_windows(pattern, codes) >= (least - 0.5) * (m + size)))
        if len(row):
            # of the characters that stand in a window, those beyond the text are in no pattern
            windows = np.pad(codes, ((0, 0), (0, m)), constant_values=-1)[row[:, None], start[:, None] + np.arange(m)]
            out[at + row, start] = 2.0 * _lcs(pattern, _masks(pattern, windows)) / (m + size[row, start])
    return out


def block_starts(short: str, long: str) -> list[int]:
    """Where the windows of ``long`` start that ``partial_ratio`` looks at."""
    blocks = SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()  # the last one is empty, at both ends
    return sorted({max(0, b.b - b.a) for b in blocks})


def _best_aligned(short: str, long: str, windows: np.ndarray) -> float:
    return max(windows[at] for at in block_starts(short, long) if at < len(windows))


def partial_scores(query: str, texts: Texts, least: int = 0, query_first: bool = False) -> np.ndarray:
    """F1b of the query with every text; scores below ``least`` may come out higher
    than they are, but below ``least``.

    The ratios of all windows are computed first, for many texts at once.  The best of
    all bounds the score, and is the score where it is 1; only texts between are taken
    apart into blocks."""
    out, m = np.zeros(len(texts.length), dtype=np.int64), len(query)
    if not m:
        return out
    rows = np.flatnonzero(texts.length >= m + (not query_first))
    if len(rows):
        some = texts.take(rows)
        windows = _window_ratios(query, some, least)
        best = windows.max(axis=1)
        for i in np.flatnonzero((best < 1) & (np.rint(100 * best) >= least)):
            best[i] = _best_aligned(query, some.strings[i], windows[i, :some.length[i]])
        out[rows] = np.rint(100 * best).astype(np.int64)
    for row in np.flatnonzero((texts.length < m + (not query_first)) & (texts.length > 0)):
        short = texts.strings[row]
        windows = _window_ratios(short, Texts([query]), least)[0]
        best = windows.max()
        if best < 1 and np.rint(100 * best) >= least:
            best = _best_aligned(short, query, windows)
        out[row] = int(np.rint(100 * best))
    return out


def token_sort(text: str) -> str:
    """The words sorted and joined by single spaces."""
    return " ".join(sorted(text.split()))


def _joined_set(words: set[str]) -> str:
    return " ".join(sorted(words))


def token_set_score(query: str, text: str, windows: bool = False) -> int:
    """The best ratio (window ratio) of two among: the common words; these and the
    query's own words; these and the text's own words."""
    a, b = set(query.split()), set(text.split())
    shared = _joined_set(a & b)
    if shared and windows:
        return 100  # the common words begin the other two strings
    own = [" ".join(x for x in (shared, _joined_set(one - other)) if x) for one, other in ((a, b), (b, a))]
    pairs = [(own[0], own[1])] + [(shared, x) for x in own if shared]
    if windows:
        return max(int(partial_scores(x, Texts([y]), query_first=True)[0]) for x, y in pairs)
    return max(int(ratio_scores(x, Texts([y]))[0]) for x, y in pairs)


def weighted_scores(query: str, texts: Texts) -> np.ndarray:
    """the best of the ratio and, scaled, the token ratios (lengths within a
    factor 1.5) or the window ratios (x0.9, x0.6 beyond a factor 8)."""
    out, m = np.zeros(len(texts.length), dtype=np.int64), len(query)
    rows = np.flatnonzero((texts.length > 0) & (m > 0))
    if not len(rows):
        return out
    some, sorted_query = texts.take(rows), token_sort(query)
    factor = np.maximum(some.length, m) / np.minimum(some.length, m)
    best = ratio_scores(query, some).astype(np.float64)
    sets = lambda at, windows: np.array([token_set_score(query, some.strings[i], windows) for i in at], dtype=np.float64)
    near = np.flatnonzero(factor < 1.5)
    if len(near):
        tokens = Texts([token_sort(some.strings[i]) for i in near])
        best[near] = np.maximum(best[near], np.maximum(ratio_scores(sorted_query, tokens), sets(near, False)) * 0.95)
    far = np.flatnonzero(factor >= 1.5)
    if len(far):
        scale = np.where(factor[far] > 8, 0.6, 0.9)
        tokens = Texts([token_sort(some.strings[i]) for i in far])
        token_best = np.maximum(partial_scores(sorted_query, tokens, query_first=True), sets(far, True))
        best[far] = np.maximum(best[far], np.maximum(partial_scores(query, some.take(far), query_first=True) * scale, token_best * 0.95 * scale))
    out[rows] = np.rint(best).astype(np.int64)
    return out


SCORERS = {"ratio": ratio_scores, "partial_ratio": partial_scores, "weighted_ratio": weighted_scores}


def scorer(name: str) -> Callable[[str, Texts], np.ndarray]:
    """Unknown scorer -> error at build time."""
    if name not in SCORERS:
        raise ValueError(f"Unknown scorer: {name!r}; expected one of {sorted(SCORERS)}")
    return SCORERS[name]


def matches(name: str, query: str, texts: Texts, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the texts that score at least ``threshold``.

    Exact: the characters in common bound the score, and only texts whose bound
    reaches the threshold are scored."""
    score = scorer(name)
    if threshold <= 0:
        return np.arange(len(texts.length)), score(query, texts)
    common = texts.in_common(query)
    shared = np.zeros(len(texts.length), dtype=bool)
    if name == "weighted_ratio":  # sorted words have fewer spaces, sets of words each word once
        own = set(query.split())
        sets = [set(t.split()) for t in texts.strings]
        shared = np.array([not own.isdisjoint(x) for x in sets], dtype=bool)  # common words alone may reach 95
        words = np.array([sum(map(len, x)) for x in sets], dtype=np.int64)
        short = np.minimum(sum(map(len, own)), words)
    else:
        short = np.minimum(len(query), texts.length)
    # a window may end with the longer string, and be as short as the characters in common
    size = (len(query) + texts.length) / 2 if name == "ratio" else np.maximum(1, short + np.minimum(common, short)) / 2
    rows = np.flatnonzero((texts.length > 0) & (len(query) > 0) & (shared | (100.0 * common + 0.5 * size >= threshold * size)))
    found = score(query, texts.take(rows), threshold) if name == "partial_ratio" else score(query, texts.take(rows))
    keep = found >= threshold
    return rows[keep], found[keep]


def _pairwise(name: str, a: Column | str, b: Column | str) -> Column:
    fn = scorer(name)

    @pandas_udf("int")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([None if x is None or y is None else int(fn(x, Texts([y]))[0]) for x, y in zip(left, right)], dtype="Int64")

    return scored(a, b)


def ratio(a: Column | str, b: Column | str) -> Column:
    """F1a of two string columns."""
    return _pairwise("ratio", a, b)


def partial_ratio(a: Column | str, b: Column | str) -> Column:
    """F1b of two string columns."""
    return _pairwise("partial_ratio", a, b)


def normalise(c: Column | str) -> Column:
    """Default processing of the search library: characters U+0080 to U+00FF are left
    out, every other character that is no letter, digit or underscore becomes a space;
    lower case, trimmed."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(col, r"[\u0080-\u00FF]", ""), r"(?U)\W", " ")))
