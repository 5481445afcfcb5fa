"""Word counts and repeated substrings of many texts at once, on numpy inside tasks."""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

_SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"
_BATCH = 1 << 18  # words handled together, but for a longer text


def longest_repeats(codes):
    """For each place, the length of its longest match with any other place of codes.

    Suffix array by prefix doubling, where places whose prefix is already unique
    are not sorted again; then longest common prefixes of neighbouring suffixes
    from the ranks of all doublings. Codes that occur once end every match.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    levels = [_starts(codes[order], order, n)]
    width = 1
    slots = np.arange(n)
    while True:
        rank = levels[-1]
        ranked = rank[order[slots]]
        same = np.zeros(len(slots), bool)
        same[1:] = ranked[1:] == ranked[:-1]
        same[:-1] |= same[1:]
        slots = slots[same]
        if not len(slots):
            break
        places = order[slots]
        after = places + width
        nxt = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[places].astype(np.int64) * (n + 1) + nxt
        by = np.argsort(key, kind="stable")
        places, key = places[by], key[by]
        order[slots] = places
        new = np.empty(len(slots), bool)
        new[0] = True
        new[1:] = key[1:] != key[:-1]
        fresh = rank.copy()
        fresh[places] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        levels.append(fresh)
        width *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank, a, b = levels[k], left + common, right + common
        fits = (a < n) & (b < n)
        match = np.zeros(n - 1, bool)
        match[fits] = rank[a[fits]] == rank[b[fits]]
        common[match] += 1 << k
    best = np.zeros(n, np.int64)
    best[left] = common
    best[right] = np.maximum(best[right], common)
    return best


def _starts(sorted_codes, order, n):
    """Rank of each place: where its group of equal codes begins in the order."""
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = sorted_codes[1:] != sorted_codes[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return rank


def _covered(best, least, owners, docs):
    """Words of each text inside a repeat of at least so many words."""
    n = len(best)
    starts = np.flatnonzero(best >= least)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + best[starts], -1)
    return np.bincount(owners[np.cumsum(edges[:-1]) > 0], minlength=docs)


def repeats(word_lists, least):
    """(words in 3-word repeats, words in repeats of least words, longest repeat) for each list of words."""
    codes, owners, base = [], [], 0
    for i, words in enumerate(word_lists):
        seen = {}
        own = [seen.setdefault(w, len(seen)) for w in words]
        codes.append(np.array([*own, len(seen)], np.int64) + base)  # the last code ends this text's matches
        owners.append(np.full(len(own) + 1, i))
        base += len(seen) + 1
    owners = np.concatenate(owners)
    best = longest_repeats(np.concatenate(codes))
    longest = np.zeros(len(word_lists), np.int64)
    np.maximum.at(longest, owners, best)
    return _covered(best, 3, owners, len(word_lists)), _covered(best, least, owners, len(word_lists)), longest


def measurer(least):
    """Iterator of text series -> iterator of frames of counts."""

    def measure(texts, words):
        thrice, covered, longest = repeats(words, least)
        lines = [[x for x in t.split("\n") if x.strip(_SPACE)] for t in texts]
        return pd.DataFrame({
            "n_words": [len(w) for w in words],
            "word_chars": [len(t) - sum(map(t.count, _SPACE)) for t in texts],
            "n_symbols": [sum(map(t.count, _SYMBOLS)) for t in texts],
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_repeat_words": thrice, "n_covered": covered, "longest_repeat": longest,
        })

    def run(batches):
        for batch in batches:
            out, texts, words, n = [], [], [], 0
            for t in batch:
                t = t or ""
                texts.append(t)
                words.append(t.encode("utf-8", "surrogatepass").split())
                n += len(words[-1])
                if n >= _BATCH:
                    out.append(measure(texts, words))
                    texts, words, n = [], [], 0
            if texts:
                out.append(measure(texts, words))
            if out:
                yield pd.concat(out, ignore_index=True)
            else:
                yield pd.DataFrame({c: np.empty(0, np.int64) for c in COLUMNS})

    return run


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")

cloudpickle.register_pickle_by_value(sys.modules[__name__])
