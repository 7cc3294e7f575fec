"""Best targets of a block of texts in a block of others by Ratcliff-Obershelp ratio: counts of shared grams and longest common subsequences of many pairs at once, which rule out most pairs and no best one."""

from __future__ import annotations

import difflib

import numpy as np

#: Lengths of grams; of each target the first that leaves a bound of use.
GRAMS = (12, 8, 6, 4, 3, 2, 1)
_CHAR, _NEXT, _AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a number that a row of the subsequence uses; the next one takes the carry.
BITS = 62
#: Pairs whose subsequences are found together, and cells of their tables of characters.
PAIRS, CELLS = 1 << 13, 1 << 17
#: Sources whose grams are counted together.
COUNTED = 16


def matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points plus one of the texts, a row each, 0 after the end; and their lengths."""
    n = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), int(n.max(initial=1))), np.uint32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) + 1
    return out, n


def blocks_at_most(target: str) -> int:
    """Most blocks that difflib matches in the target, as second sequence, besides what lengths say. From 200 characters on it seeds no block on a popular character, so each block but one holds a rare one of its own;
    that one is what both texts begin with."""
    if len(target) < 200:
        return len(target)
    counts = np.unique(np.frombuffer(target.encode("utf-32-le"), np.uint32), return_counts=True)[1]
    return int(counts[counts <= len(target) // 100 + 1].sum()) + 1


def gram_codes(chars: np.ndarray, n: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the grams of q characters, numbered among their equals in each row, and the row of each."""
    wide = chars.shape[1] - q + 1
    if wide <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code, each = np.zeros((len(chars), wide), np.uint64), chars.astype(np.uint64) * _CHAR
    for k in range(q):
        code = code * _NEXT + (each[:, k : k + wide] ^ (each[:, k : k + wide] >> np.uint64(29)))
    order = np.argsort(code, axis=1, kind="stable")  # what stands past the end of a text comes after its equals
    code = np.take_along_axis(code, order, 1)
    at = np.broadcast_to(np.arange(wide), code.shape)
    first = np.concatenate((np.ones((len(code), 1), bool), code[:, 1:] != code[:, :-1]), axis=1)
    code = code + (at - np.maximum.accumulate(np.where(first, at, 0), axis=1)).astype(np.uint64) * _AGAIN
    row, column = np.nonzero(order < (n - q + 1)[:, None])
    return code[row, column], row


def shared(s: tuple[np.ndarray, np.ndarray], t: tuple[np.ndarray, np.ndarray], targets: int, some: range) -> np.ndarray:
    """How many codes each of some sources has in common with each target. s: codes in order of their rows, with the rows; t: sorted codes, with the rows."""
    a, b = np.searchsorted(s[1], [some.start, some.stop])
    codes, rows = s[0][a:b], s[1][a:b] - some.start
    low, high = np.searchsorted(t[0], codes, "left"), np.searchsorted(t[0], codes, "right")
    n = high - low
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.bincount(np.repeat(rows * targets, n) + t[1][at], minlength=len(some) * targets).reshape(len(some), targets)


def may_match(s: list[str], t: list[str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (source, target), by source, that a ratio of least can't be ruled out for by lengths and shared grams.

    A ratio of least takes an overlap of M = least * (n + m) / 2 characters of texts of n and m, in at most n + m - 2 * M + 1 blocks, and in few where the
    target has few rare characters. Of k blocks M - (q - 1) * k grams of q characters are left, which both texts have.
    """
    (s_chars, s_n), (t_chars, t_n) = matrix(s), matrix(t)
    few = np.array([blocks_at_most(x) for x in t], np.int64)
    short = t_n < 200
    reach = np.minimum(5 / 8 * least * t_n, np.ceil(t_n * least / (2 - least)) - 1)  # grams that blocks may cost, also against the shortest partner
    length = np.array([next(q for q in GRAMS if q == 1 or (q - 1) * k <= r) for k, r in zip(few.tolist(), reach.tolist())])
    out = []
    groups = [((q,), np.flatnonzero(~short & (length == q))) for q in GRAMS] + [((2, 1), np.flatnonzero(short))]
    for grams, mine in ((g, m) for g, m in groups if len(m)):
        tables = []
        for q in grams:
            codes, rows = gram_codes(t_chars[mine], t_n[mine], q)
            order = np.argsort(codes)
            tables.append((q, gram_codes(s_chars, s_n, q), (codes[order], rows[order])))
        for k in range(0, len(s), COUNTED):
            some = range(k, min(k + COUNTED, len(s)))
            total = s_n[some.start : some.stop, None] + t_n[mine]
            both = np.ceil(least * total / 2 - 1e-9).astype(np.int64)
            blocks = np.minimum(total - 2 * both + 1, few[mine])
            left = 2 * np.minimum(s_n[some.start : some.stop, None], t_n[mine]) >= least * total - 1e-9
            for q, of_s, of_t in tables:
                left &= shared(of_s, of_t, len(mine), some) >= both - (q - 1) * blocks
            i, j = np.nonzero(left)
            out.append((i + k, mine[j]))
    i, j = (np.concatenate([x[p] for x in out] or [np.zeros(0, np.int64)]) for p in (0, 1))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def common_subsequences(s: list[str], t: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs in order of their source, row by row in the bits of a few numbers a pair."""
    (s_chars, s_n), (t_chars, t_n) = matrix(s), matrix(t)
    letters, coded = np.unique(s_chars, return_inverse=True)
    coded = coded.reshape(s_chars.shape)
    if letters[0]:
        letters, coded = np.append(0, letters), coded + 1
    place = np.searchsorted(letters, t_chars)
    t_coded = np.where(letters[np.minimum(place, len(letters) - 1)] == t_chars, place, 0)  # 0: in no source, or past the end
    words, full = -(-s_chars.shape[1] // BITS), np.uint64((1 << BITS) - 1)
    out, at, most = np.zeros(len(i), np.int64), 0, max(1, CELLS // len(letters))
    while at < len(i):
        stop = min(at + PAIRS, int(np.searchsorted(i, i[at] + most)))  # sources of a step are numbered one after the other
        own, which = np.unique(i[at:stop], return_inverse=True)
        masks = np.zeros((words, len(own) * len(letters)), np.uint64)
        for k in range(s_chars.shape[1]):
            masks[k // BITS, np.arange(len(own)) * len(letters) + coded[own, k]] |= np.uint64(1 << k % BITS)
        masks[:, np.arange(len(own)) * len(letters)] = 0
        size = np.clip(s_n[i[at:stop]] - BITS * np.arange(words)[:, None], 0, BITS).astype(np.uint64)
        ends = (np.uint64(1) << size) - np.uint64(1)
        row, theirs = ends.copy(), t_coded[j[at:stop]]
        for k in range(int(t_n[j[at:stop]].max())):
            cell, carry = which * len(letters) + theirs[:, k], np.uint64(0)
            for w in range(words):
                hit = row[w] & masks[w].take(cell)
                more = row[w] + hit + carry
                row[w] -= hit
                carry = more >> np.uint64(BITS)
                row[w] |= more & full
        out[at:stop] = s_n[i[at:stop]] - np.bitwise_count(row & ends).sum(axis=0, dtype=np.int64)
        at = stop
    return out


def best_targets(s: list[str], t: list[str], least: float) -> list[tuple[int, int, float]]:
    """(source, target, ratio) of each source's greatest ratio of least or more, with all targets that reach it. Matched blocks are a common subsequence, so a pair is scored only where its longest one reaches the best so far."""
    if not s or not t:
        return []
    i, j = may_match(s, t, least)
    s_n, t_n = (np.array([len(x) for x in side], np.int64) for side in (s, t))
    bound = 2.0 * common_subsequences(s, t, i, j) / (s_n[i] + t_n[j])
    on = np.flatnonzero(bound >= least)
    on = on[np.lexsort((-bound[on], i[on]))]
    out, last, best, held, scorer = [], -1, least, [], difflib.SequenceMatcher(None)
    for k, a, b, top in zip(on, i[on].tolist(), j[on].tolist(), bound[on].tolist()):
        if a != last:
            out += held
            last, best, held = a, least, []
        if top < best:
            continue
        scorer.set_seqs(s[a], t[b])
        value = scorer.ratio()
        if value > best:
            best, held = value, [(a, b, value)]
        elif value == best:
            held.append((a, b, value))
    return out + held
