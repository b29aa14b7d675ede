"""String similarities for batches of pairs, in numpy, and the Arrow functions that call them.

All pairs of a batch advance together: longest common subsequences by the bit-parallel recurrence (Hyyro, 2004)
over as many 64-bit words as the longest pattern needs, Jaro by the same bit sets. Strings become code arrays
over the batch's own alphabet, so any script works.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

ONE, ALL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
#: Lanes that the kernels hold at a time.
LANES = 1 << 16


def codes(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Both sides as matrices of codes from 1, padded with 0, their lengths, and the number of codes."""
    sizes = [np.fromiter(map(len, side), dtype=np.int64, count=len(side)) for side in (left, right)]
    flat = np.frombuffer("".join((*left, *right)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    present = np.zeros(int(flat.max(initial=0)) + 1, dtype=np.int64)
    present[flat] = 1
    number = (np.cumsum(present) - 1)[flat]
    out, at = [], 0
    for size in sizes:
        matrix = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
        inside = np.arange(matrix.shape[1])[None] < size[:, None]
        matrix[inside] = number[at : at + int(size.sum())] + 1
        at += int(size.sum())
        out.append(matrix)
    return out[0], out[1], sizes[0], sizes[1], int(present.sum()) + 1


def positions(pattern: np.ndarray, size: np.ndarray, alphabet: int) -> np.ndarray:
    """(rows, alphabet, words): for each row and code the bit set of its places in the pattern."""
    words = max(1, -(-pattern.shape[1] // 64))
    masks = np.zeros((len(pattern), alphabet, words), dtype=np.uint64)
    rows = np.arange(len(pattern))
    for j in range(pattern.shape[1]):
        masks[rows, pattern[:, j], j // 64] |= ONE << np.uint64(j % 64)
    masks[:, 0] = 0
    return masks


def step(state: np.ndarray, match: np.ndarray) -> np.ndarray:
    """One text character: V = (V + (V & M)) | (V & ~M), the sum carried across words."""
    hit = state & match
    out = np.empty_like(state)
    carry = np.zeros(len(state), dtype=np.uint64)
    for w in range(state.shape[1]):
        total = state[:, w] + hit[:, w]
        over = total < state[:, w]
        total = total + carry
        carry = (over | (total < carry)).astype(np.uint64)
        out[:, w] = total | (state[:, w] & ~match[:, w])
    return out


def matches(masks: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(rows, characters): the bit set of each character of a text, of patterns of one word."""
    return masks[np.arange(len(masks))[:, None], text, 0]


def advance(state: np.ndarray, match: np.ndarray) -> None:
    """`step` in place, of patterns of one word."""
    hit = state & match
    rest = state - hit
    np.add(state, hit, out=state)
    np.bitwise_or(state, rest, out=state)


def zeros(state: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Zero bits of each row among the pattern's places: the length of the common subsequence."""
    total = np.zeros(len(state), dtype=np.int64)
    for w in range(state.shape[1]):
        n = np.clip(size - 64 * w, 0, 64)
        mask = np.where(n == 64, ALL, (ONE << np.minimum(n, 63).astype(np.uint64)) - ONE)
        total += np.bitwise_count(~state[:, w] & mask)
    return total


def subsequence(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of the longest common subsequence of each pair, and both lengths."""
    a, b, na, nb, alphabet = codes(left, right)
    out = np.zeros(len(left), dtype=np.int64)
    for at in range(0, len(left), LANES // 4):
        rows = slice(at, at + LANES // 4)
        masks = positions(a[rows], na[rows], alphabet)
        if masks.shape[2] == 1:
            state = np.full(len(masks), ALL)
            for match in matches(masks, b[rows, : int(nb[rows].max(initial=0))]).T.copy():
                advance(state, match)
            out[rows] = zeros(state[:, None], na[rows])
            continue
        state = np.full((len(masks), masks.shape[2]), ALL)
        each = np.arange(len(masks))
        for j in range(int(nb[rows].max(initial=0))):
            state = step(state, masks[each, b[rows][:, j]])
        out[rows] = zeros(state, na[rows])
    return out, na, nb


def ratio(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised Indel similarity; 1 if both are empty."""
    common, na, nb = subsequence(left, right)
    return np.where(na + nb == 0, 1.0, 2 * common / np.maximum(na + nb, 1))


def partial_ratio(left: list[str], right: list[str]) -> np.ndarray:
    """Best ratio of the shorter string with a window of the longer of at most its length; 0 if just one is empty.

    Strings of equal length are tried both ways.
    """
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(left, right, strict=True)]
    again = [k for k, (x, y) in enumerate(pairs) if len(x) == len(y) and x != y]
    short = [p[0] for p in pairs] + [pairs[k][1] for k in again]
    long = [p[1] for p in pairs] + [pairs[k][0] for k in again]
    best = _windows(short, long)
    out = best[: len(pairs)]
    np.maximum.at(out, again, best[len(pairs) :])
    return out


def _windows(short: list[str], long: list[str]) -> np.ndarray:
    out = np.empty(len(short))
    sizes = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
    for some, kernel in ((np.flatnonzero(sizes <= 64), _windows_of_a_word), (np.flatnonzero(sizes > 64), _windows_of_words)):
        if len(some):
            out[some] = kernel([short[k] for k in some], [long[k] for k in some])
    return out


def _windows_of_a_word(short: list[str], long: list[str]) -> np.ndarray:
    """All windows of a pair side by side, so that a step reads the next column of the longer string's bit sets.

    Behind the longer string's end nothing matches: a window that is cut there keeps its state.
    """
    a, b, na, nb, alphabet = codes(short, long)
    out = np.where((na == 0) & (nb == 0), 1.0, 0.0)
    order = np.flatnonzero(na > 0)
    order = order[np.argsort(nb[order], kind="stable")]
    at = 0
    while at < len(order):
        last = at + max(1, LANES // 2 // max(int(nb[order[min(at + LANES // 64, len(order) - 1)]]), 1))
        rows = order[at:last]
        rows = rows[np.argsort(na[rows], kind="stable")]
        at = last
        size, span = na[rows], nb[rows]
        starts, steps = int(span.max()), int(size[-1])
        match = np.zeros((len(rows), starts + steps), dtype=np.uint64)
        match[:, :starts] = matches(positions(a[rows, :steps], size, alphabet), b[rows, :starts])
        lengths = np.minimum(size[:, None], span[:, None] - np.arange(starts))
        state = np.full((len(rows), starts), ALL)
        best = np.zeros(len(rows))
        low = (ALL >> (64 - size).astype(np.uint64))
        ends = np.searchsorted(size, np.arange(steps + 1), side="right")
        for j in range(steps):
            live = slice(ends[j], None)
            advance(state[live], match[live, j : j + starts])
            first = np.bitwise_count(~state[live, 0] & low[live])  # the window that is cut at the longer string's start
            best[live] = np.maximum(best[live], 2 * first.astype(np.int64) / (size[live] + np.minimum(j + 1, span[live])))
            full = slice(ends[j], ends[j + 1])
            if ends[j] < ends[j + 1]:
                common = np.bitwise_count(~state[full] & low[full, None]).astype(np.int64)
                share = np.where(lengths[full] > 0, 2 * common / (size[full, None] + np.maximum(lengths[full], 1)), 0.0)
                best[full] = np.maximum(best[full], share.max(axis=1))
        out[rows] = best
    return out


def _windows_of_words(short: list[str], long: list[str]) -> np.ndarray:
    a, b, na, nb, alphabet = codes(short, long)
    out = np.where((na == 0) & (nb == 0), 1.0, 0.0)
    rows = np.repeat(np.arange(len(short)), np.where(na > 0, nb, 0))
    first = np.arange(len(rows)) - np.repeat(np.cumsum(np.where(na > 0, nb, 0)) - np.where(na > 0, nb, 0), np.where(na > 0, nb, 0))
    ends = np.searchsorted(rows, np.arange(len(short) + 1))
    at = 0
    while at < len(short):
        last = max(at + 1, int(np.searchsorted(ends, ends[at] + LANES, side="right")) - 1)
        last = min(last, at + LANES // 4)
        lanes = slice(ends[at], ends[last])
        row, start = rows[lanes], first[lanes]
        masks = positions(a[at:last], na[at:last], alphabet)
        state = np.full((len(row), masks.shape[2]), ALL)
        for j in range(int(na[at:last].max(initial=0))):
            live = (j < na[row]) & (start + j < nb[row])
            if not live.any():
                break
            if not live.all():
                row, start, state = row[live], start[live], state[live]
            state = step(state, masks[row - at, b[row, start + j]])
            # a window ends here if it is full, or if it is cut at either end of the longer string
            done = (j + 1 == na[row]) | (start + j + 1 == nb[row]) | (start == 0)
            if done.any():
                common = zeros(state[done], na[row[done]])
                np.maximum.at(out, row[done], 2 * common / (na[row[done]] + j + 1))
        at = last
    return out


def jaro_winkler(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro-Winkler: prefix weight 0.1, at most four letters, only above a Jaro of 0.7; 1 if both are empty."""
    a, b, na, nb, alphabet = codes(left, right)
    out = np.empty(len(left))
    for at in range(0, len(left), LANES // 4):
        rows = slice(at, at + LANES // 4)
        out[rows] = _jaro_winkler(a[rows], b[rows], na[rows], nb[rows], alphabet)
    return out


def _jaro_winkler(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(a)
    masks = positions(b, nb, alphabet)
    words = masks.shape[2]
    reach = np.maximum(np.maximum(na, nb) // 2 - 1, 0)
    if words == 1:
        m, half = _jaro_of_a_word(a, b, masks, reach)
    else:
        m, half = _jaro_of_words(a, b, na, masks, reach)
    safe = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / np.maximum(na, 1) + m / np.maximum(nb, 1) + (m - half) / safe) / 3, 0.0)
    jaro = np.where((na == 0) & (nb == 0), 1.0, jaro)
    width = min(4, a.shape[1], b.shape[1])
    same = (a[:, :width] == b[:, :width]) & (a[:, :width] > 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1) if width else np.zeros(n)
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)


def _jaro_of_a_word(a: np.ndarray, b: np.ndarray, masks: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matching letters of each pair and half of those out of order, where the second string has one word of bits."""
    n = len(a)
    free = np.full(n, ALL)
    matched = np.zeros((a.shape[1], n), dtype=bool)
    reaches = np.arange(int(reach.max(initial=0)) + 1)

    def below(limit: np.ndarray) -> np.ndarray:
        k = np.clip(limit, 0, 64)
        return np.where(k == 64, ALL, (ONE << np.minimum(k, 63).astype(np.uint64)) - ONE)

    for i, match in enumerate(matches(masks, a).T.copy()):
        can = match & free & (below(i + reaches + 1) & ~below(i - reaches))[reach]
        free &= ~(can & (~can + ONE))
        matched[i] = can != 0
    taken = np.unpackbits((~free).astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, : b.shape[1]].astype(bool)
    inside = matched.T
    rows = np.nonzero(inside)[0]
    wrong = a[inside] != b[taken]  # both in their own order, as many of each pair
    return inside.sum(axis=1), np.bincount(rows[wrong], minlength=n) // 2


def _jaro_of_words(a: np.ndarray, b: np.ndarray, na: np.ndarray, masks: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, words = len(a), masks.shape[2]
    free = np.full((n, words), ALL)
    place = np.full((n, a.shape[1]), -1, dtype=np.int64)
    each = np.arange(n)

    def below(limit: np.ndarray, w: int) -> np.ndarray:
        k = np.clip(limit - 64 * w, 0, 64)
        return np.where(k == 64, ALL, (ONE << np.minimum(k, 63).astype(np.uint64)) - ONE)

    for i in range(a.shape[1]):
        open_ = (i < na) & True
        for w in range(words):
            window = below(i + reach + 1, w) & ~below(np.maximum(i - reach, 0), w)
            can = masks[each, a[:, i], w] & free[:, w] & window
            take = open_ & (can != 0)
            bit = can & (~can + ONE)
            free[take, w] &= ~bit[take]
            place[take, i] = 64 * w + np.bitwise_count(bit[take] - ONE)
            open_ = open_ & ~take
    matched = place >= 0
    m = matched.sum(axis=1)
    in_a = np.argsort(~matched, axis=1, kind="stable") if a.shape[1] else np.empty((n, 0), dtype=int)
    letters_a = np.take_along_axis(a, in_a, axis=1)
    where = np.sort(np.where(matched, place, np.iinfo(np.int64).max), axis=1)
    letters_b = np.take_along_axis(b, np.minimum(where, max(b.shape[1] - 1, 0)), axis=1) if b.shape[1] else np.zeros_like(letters_a)
    counted = np.arange(a.shape[1])[None] < m[:, None]
    return m, ((letters_a != letters_b) & counted).sum(axis=1) // 2


def set_ratio(common: np.ndarray, only_a: list[str], only_b: list[str], empty: np.ndarray) -> np.ndarray:
    """Token set ratio from the length of the joined shared tokens and the joined tokens of either side alone."""
    shared, na, nb = subsequence(only_a, only_b)
    some = (common > 0).astype(int)
    whole_a, whole_b = common + some + na, common + some + nb
    both = whole_a + whole_b
    best = np.where(both > 0, 1 - (na + nb - 2 * shared) / np.maximum(both, 1), 1.0)
    for n, whole in ((na, whole_a), (nb, whole_b)):
        own = 1 - (some + n) / np.maximum(common + whole, 1)
        best = np.where(common > 0, np.maximum(best, own), best)
    best = np.where((common > 0) & ((na == 0) | (nb == 0)), 1.0, best)
    return np.where(empty, 0.0, best)


def two_strings(kernel):
    """A kernel over two lists of strings as an Arrow function of two columns; null counts as empty."""

    @F.pandas_udf(DoubleType())
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(kernel(a.fillna("").tolist(), b.fillna("").tolist()))

    return apply


@F.pandas_udf(DoubleType())
def _set_ratio(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for common, a, b, empty in batches:
        yield pd.Series(set_ratio(common.to_numpy(), a.tolist(), b.tolist(), empty.to_numpy()))


def token_sets(a: Column, b: Column) -> tuple[Column, Column, Column, Column]:
    """What `set_ratio` takes, of two arrays of tokens: JVM-side set algebra."""
    common = F.array_join(F.sort_array(F.array_intersect(a, b)), " ")
    only_a = F.array_join(F.sort_array(F.array_except(a, b)), " ")
    only_b = F.array_join(F.sort_array(F.array_except(b, a)), " ")
    return F.length(common), only_a, only_b, (F.size(a) == 0) | (F.size(b) == 0)


def token_set_ratio(a: Column, b: Column) -> Column:
    return _set_ratio(*token_sets(a, b))
