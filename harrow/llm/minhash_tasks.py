"""Shingle sets, SuperMinHash signatures and the checks of one block, on numpy inside tasks."""

import hashlib
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CHUNK = 1 << 15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words_of(text):
    """Words between ASCII white space, A-Z lowered, as bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def shingles(words, k, known):
    """Sorted distinct 64-bit hashes of the k-word windows; of the whole sequence where it is shorter.

    known keeps the hash of each word seen by this task.
    """
    if not words:
        return np.empty(0, np.uint64)
    if len(known) > 400_000:
        known.clear()
    codes = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        codes.append(h)
    codes = np.array(codes, np.uint64)
    width = min(k, len(words))
    out = np.full(len(codes) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + codes[i:len(codes) - width + 1 + i])
    return np.unique(out)


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def superminhash(sets, m):
    """One signature of m 64-bit ranks for each set of hashes (SuperMinHash).

    Element d draws one random permutation of the slots, step by step; at step j
    it offers rank j + r to slot p[j]. A slot keeps the least offer. A set stops
    at the first step that no slot can still gain from, so a set of many
    elements takes a few steps and the result is that of all m steps. The steps
    of many sets run together on flat arrays. An empty set has the top rank
    everywhere. Ranks are held as integers: step in the high bits, r below.
    """
    best = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    for start in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):
        _offer(flat[start:start + _CHUNK], owners[start:start + _CHUNK], best, m)
    return best


def _offer(elements, owners, best, m):
    order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
    first = owners[0]
    slots = best[first:owners[-1] + 1].reshape(-1)
    base = (owners - first) * m
    rows = np.arange(len(elements))
    seed = elements
    for j in range(m):
        if j:
            worst = (slots.reshape(-1, m).max(axis=1) >> np.uint64(48))[base[rows] // m]
            live = worst >= j
            if not live.all():
                rows = rows[live]
                if not len(rows):
                    return
                seed = seed[live]
        seed = _mixed(seed + np.uint64(0x9E3779B97F4A7C15))
        k = j + ((seed >> np.uint64(40)) % np.uint64(m - j)).astype(np.int64)
        taken = order[rows, k]
        order[rows, k] = order[rows, j]
        rank = (seed & np.uint64((1 << 40) - 1)) | np.uint64(j << 48)
        np.minimum.at(slots, base[rows] + taken, rank)


def signer(k, bands, rows):
    """mapInPandas step: (doc_id, missing, text) -> the first two, word sequence, set size and a hash of each band."""
    m = bands * rows

    def run(batches):
        known = {}
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start:start + 512]
                words = [words_of(t) for t in part["text"]]
                sets = [shingles(w, k, known) for w in words]
                best = superminhash(sets, m).reshape(-1, bands, rows)
                keys = np.zeros(best.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)
                for i in range(rows):
                    keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + best[:, :, i])
                yield pd.DataFrame({
                    "doc_id": part["doc_id"],
                    "missing": part["missing"],
                    "fp": [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words],
                    "n_shingles": [len(s) for s in sets],
                    "bands": [list(x) if len(s) else [] for x, s in zip(keys.view(np.int64), sets, strict=True)],
                })

    return run


def verifier(k, percent, slots, doubt):
    """mapInPandas step over rows (block, id, text) in order of block -> links (a, b) that span its linked rows.

    Each row meets the rows before it, likely ones first (by estimated
    similarity), as long as they are not connected with it; such a pair is
    checked on the full sets. Pairs whose estimate is under the threshold by
    more than doubt are no candidates. No list of pairs is kept, so memory grows
    with the rows of a block alone.
    """

    def links(ids, sets):
        found, group = [], np.arange(len(ids))
        sizes = np.array([len(s) for s in sets])
        marks = superminhash(sets, slots).astype(np.uint32)
        need = percent / 100 - doubt
        for i in range(1, len(ids)):
            near = (marks[:i] == marks[i]).mean(axis=1)
            fits = (near >= need) & (100 * np.minimum(sizes[:i], sizes[i]) >= percent * np.maximum(sizes[:i], sizes[i]))
            left = np.flatnonzero(fits)
            left = left[np.argsort(-near[left], kind="stable")]
            while len(left):
                j, left = left[0], left[1:]
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    group[group == group[j]] = group[i]
                    left = left[group[left] != group[i]]
                    found.append((ids[i], ids[j]))
        return found

    def run(batches):
        known = {}
        block, ids, sets = None, [], []
        for batch in batches:
            out = []
            for b, i, t in zip(batch["block"], batch["doc_id"], batch["text"], strict=True):
                if b != block:
                    out += links(ids, sets) if ids else []
                    block, ids, sets = b, [], []
                ids.append(i)
                sets.append(shingles(words_of(t), k, known))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        if ids:
            yield pd.DataFrame(links(ids, sets), columns=["a", "b"]).astype("int64")

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
