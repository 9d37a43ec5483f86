"""Common prefixes of a text collection by increasing length, from its Burrows-Wheeler transform.

The intervals of all patterns of length l are held at once; each is extended backward by every
symbol that precedes it, which gives the intervals of length l + 1.  The right end of a new
interval that no shorter pattern has marked has a longest common prefix of exactly l with its
neighbour; only intervals that mark something are extended further (after Beller, Gog, Ohlebusch
and Schnattinger, 2013).  The expansion stops at the threshold: what is not marked by then shares
at least so many symbols with the suffix before it.
"""

from __future__ import annotations

import numpy as np


#: Symbols that the first sorting key holds, 9 bits each.
_PACKED = 7


def suffix_array(text: np.ndarray, separators: int, depth: int) -> np.ndarray:
    """By prefix tripling from keys of seven symbols; only suffixes that still tie are sorted again, and
    only by their first ``depth`` symbols: intervals of patterns up to that length don't depend on the
    order inside of longer ties.

    ``text``: int64 symbols; those below ``separators`` occur once each, in rising order, and the
    last symbol is one of them.
    """
    n = len(text)
    small = np.zeros(n + _PACKED, dtype=np.int64)
    small[:n] = np.where(text < separators, 0, text - separators + 1)
    key = np.zeros(n, dtype=np.int64)
    open_ = np.ones(n, dtype=bool)
    for k in range(_PACKED):
        open_ &= small[k : k + n] > 0
        key = (key << 9) | np.where(open_, small[k : k + n], 0)
    owner = np.searchsorted(np.flatnonzero(text < separators), np.arange(n))
    sa = np.argsort(key)
    ordered = key[sa]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = _PACKED
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    wide = n < 1 << 21  # then three ranks fit into one key, and a round triples what is sorted
    while len(tied) and step < depth:
        at = sa[tied]
        key = rank[at]
        second = rank[np.minimum(at + step, n - 1)]
        if step == _PACKED:  # a key with a separator in it ends there: its string decides
            second = np.where(open_[at], second, owner[at])
        key = (key << 21 | second) << 21 | rank[np.minimum(at + 2 * step, n - 1)] if wide else key * n + second
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[tied] = at
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~(head & np.append(head[1:], True))]
        step *= 3 if wide else 2
    return sa


def _by_symbol(bwt: np.ndarray) -> np.ndarray:
    """Places of the transform in the order of their symbols, then of themselves."""
    n = len(bwt)
    return np.argsort(bwt * n + np.arange(n))


def repeated_starts(strings: list[bytes], *lengths: int, starts: list[int] | None = None) -> list[list[np.ndarray]]:
    """For each of the rising ``lengths``, and for each string, the starts of those of its substrings of
    that length that also start elsewhere in the collection.  Substrings do not run from one string
    into the next.  The expansion passes the shorter lengths on its way to the last one.  ``starts``: in
    each string only so many places count as starts; what follows them is context, which another
    string may hold as well."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    m = len(strings)
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    n = int(ends[-1]) + 1 if m else 0
    if not n:
        return [[] for _ in lengths]
    text = np.empty(n, dtype=np.int64)
    body = np.ones(n, dtype=bool)
    body[ends] = False
    text[body] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + m
    text[ends] = np.arange(m)  # a separator of its own for each string
    sa = suffix_array(text, m, lengths[-1])
    bwt = text[sa - 1]
    lf = np.empty(n, dtype=np.int64)
    lf[_by_symbol(bwt)] = np.arange(n)
    marked = np.zeros(n + 1, dtype=bool)
    marked[0] = marked[n] = True
    lb, rb = np.array([0]), np.array([n])
    passed: dict[int, np.ndarray] = {}
    for step in range(lengths[-1]):
        if step in lengths:
            passed[step] = marked.copy()
        size = rb - lb
        single = size == 1
        one = lf[lb[single]]
        many_lb, many = lb[~single], size[~single]
        if len(many):
            owner = np.repeat(np.arange(len(many)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + many_lb[owner]
            key = owner * (m + 256) + bwt[at]
            order = np.argsort(key, kind="stable")
            key, to = key[order], lf[at[order]]
            head = np.concatenate(([True], key[1:] != key[:-1]))
            last = np.append(head[1:], True)
            new_lb, new_rb = np.concatenate((one, to[head])), np.concatenate((one, to[last])) + 1
        else:
            new_lb, new_rb = one, one + 1
        fresh = ~marked[new_rb]
        lb, rb = new_lb[fresh], new_rb[fresh]
        if not len(lb):
            break
        rb, pick = np.unique(rb, return_index=True)
        lb = lb[pick]
        marked[rb] = True
    counts = np.ones(n, dtype=bool)
    if starts is not None:
        inside = np.arange(n) - np.repeat(begins, sizes + 1)
        counts = inside < np.repeat(np.array(starts, dtype=np.int64), sizes + 1)
    valid = counts[sa]
    out = []
    for length in lengths:
        # suffixes that share so many symbols stand together: from one mark to the next
        block = np.cumsum(passed.get(length, marked)[:n])
        twice = np.bincount(block[valid], minlength=int(block[-1]) + 1) > 1
        hit = np.zeros(n, dtype=bool)
        hit[sa[valid & twice[block]]] = True
        out.append([np.flatnonzero(hit[b:e]) for b, e in zip(begins, ends, strict=True)])
    return out
