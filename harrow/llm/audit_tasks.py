"""Term counts of texts and summed differences of sources, inside tasks."""

import re
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_HELD = 500_000  # counts that a task holds before it sends them on


def counter(batches):
    """mapInArrow step: rows (lang, text, sources) -> counts of terms, added up over many rows."""
    counts, docs = {}, {}

    def out():
        for (lang, source), own in counts.items():
            if own:
                held = docs[lang, source]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(own), pa.string()), "source": pa.array([source] * len(own), pa.string()),
                    "term": pa.array(list(own), pa.string()), "n": pa.array(list(own.values()), pa.int64()),
                    "docs": pa.array([held[t] for t in own], pa.int64())})
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        for lang, text, sources in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "sources")), strict=True):
            terms = _TERM.findall(text.encode().lower().decode())  # of bytes, so A-Z alone are lowered
            for held_by in sources:
                key, n = (lang, held_by["source"]), held_by["n"]
                own, own_docs = counts.setdefault(key, Counter()), docs.setdefault(key, Counter())
                held -= len(own)
                if n == 1:
                    own.update(terms)
                    own_docs.update(set(terms))
                else:
                    once = Counter(terms)
                    own.update({t: n * c for t, c in once.items()})
                    own_docs.update(dict.fromkeys(once, n))
                held += len(own)
            if held > _HELD:
                yield from out()
                held = 0
    yield from out()


def differences(rows):
    """Summed |p - p'| of each two sources of a block over its terms, as (lang, source, item, value) both ways.

    Rows with a term are its p in a source that holds it; one row without a
    term for each source has the p of a term it does not hold, and the number of
    terms. The first block adds the terms that no source of a pair holds; all
    blocks then add what differs from that. So only held terms are walked.
    """
    head = rows[rows["term"].isna()].sort_values("source")
    names = head["source"].to_numpy()
    zero = head["p"].to_numpy(np.int64)
    first = int(rows["block"].iloc[0]) == 0
    total = int(head["terms"].iloc[0]) if first else 0
    side = head["tile"].to_numpy()
    held = rows[rows["term"].notna()]
    row = pd.Index(names).get_indexer(held["source"])
    order = np.argsort(row, kind="stable")
    row = row[order]
    column, words = pd.factorize(held["term"])
    column, p = column[order], held["p"].to_numpy(np.int64)[order]
    bounds = np.searchsorted(row, np.arange(len(names) + 1))
    own_n = np.diff(bounds)
    one, two = int(rows["one"].iloc[0]), int(rows["two"].iloc[0])
    value, has = np.zeros(len(words), np.int64), np.zeros(len(words), bool)

    def summed(x, at):
        # whole numbers far below 2 ** 53, so the sums are exact
        return np.bincount(at, weights=x, minlength=len(names)).astype(np.int64)

    found = []
    for s in range(len(names)):
        own = slice(bounds[s], bounds[s + 1])
        value[column[own]], has[column[own]] = p[own], True
        both = has[column]
        base = np.abs(zero[s] - zero)
        # terms of the others, then terms of s that the others lack
        sums = summed(np.where(both, np.abs(value[column] - p), np.abs(zero[s] - p)), row)
        sums += np.array([np.abs(p[own] - z).sum() for z in zero], np.int64)
        sums -= summed(np.abs(value[column[both]] - zero[row[both]]), row[both])
        either = own_n + own_n[s] - np.bincount(row[both], minlength=len(names))
        sums += base * (total - either)
        fits = np.arange(len(names)) != s
        if one != two:
            fits &= side != side[s]
        found.append(pd.DataFrame({"source": names[s], "item": names[fits], "value": sums[fits]}))
        has[column[own]] = False
    out = pd.concat(found)
    out.insert(0, "lang", rows["lang"].iloc[0])
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
