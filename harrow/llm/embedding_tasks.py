"""Sign hashes of vectors and exact cosines inside blocks, on numpy inside tasks."""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from harrow.llm.union_find import Forest


def planes(dim, tables, bits, seed):
    """Normals of the random hyperplanes, the same in every task."""
    return np.random.default_rng([seed, dim]).standard_normal((tables * bits, dim))


def units(vectors):
    """Rows of unit length in double precision."""
    m = np.array(list(vectors), np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def hasher(tables, bits, seed):
    """mapInPandas step: rows (id, n, vector) of one length each -> the same and the sign hash of every table."""
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for batch in batches:
            out = []
            for dim, part in batch.groupby(batch["vector"].map(len)):
                signs = units(part["vector"]) @ planes(int(dim), tables, bits, seed).T >= 0
                codes = (signs.reshape(len(part), tables, bits) * weights).sum(axis=2)
                out.append(part.assign(codes=list(codes), dim=int(dim)))
            if out:
                yield pd.concat(out)[["id", "n", "vector", "codes", "dim"]]

    return run


def linker(least):
    """mapInPandas step over rows (block, side, table, id, n, vector, codes) in order of block.

    side 0 and 1 are two chunks of one bucket, side 2 a bucket whole. Each linked
    pair counts in the first table whose bucket holds both. -> (id, n, other):
    links found, weighed by equal vectors, and one linked id that leads to the
    least one of the block's group (null for none).
    """

    def links(block):
        ids, n = block["id"].to_numpy(), block["n"].to_numpy()
        side, table = block["side"].to_numpy(), int(block["table"].iloc[0])
        unit, codes = units(block["vector"]), np.array(list(block["codes"]))[:, :table + 1]
        rows, cols = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        count, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        if len(rows) and len(cols):
            for start in range(0, len(rows), 512):
                part = rows[start:start + 512]
                i, j = np.nonzero(unit[part] @ unit[cols].T >= least)
                i, j = part[i], cols[j]
                apart = i < j if side[0] == 2 else np.ones(len(i), bool)
                i, j = i[apart], j[apart]
                if table:
                    for a in range(0, len(i), 1 << 16):
                        b = slice(a, a + (1 << 16))
                        seen = (codes[i[b], :table] == codes[j[b], :table]).any(axis=1)
                        i[b][seen] = -1
                    j, i = j[i >= 0], i[i >= 0]
                np.add.at(count, i, n[j])
                np.add.at(count, j, n[i])
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    forest.join(x, y)
        hit = np.flatnonzero(count)
        heads = {}
        roots = [forest.root(x) for x in hit.tolist()]
        for x, r in zip(hit.tolist(), roots, strict=True):
            heads[r] = min(heads.get(r, ids[x]), ids[x])
        return pd.DataFrame({"id": ids[hit], "n": count[hit], "other": [heads[r] for r in roots]})

    def run(batches):
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rest["block"].iloc[-1] if len(rest) else None
            done = rest[rest["block"] != last]
            rest = rest[rest["block"] == last]
            yield from (links(part) for _, part in done.groupby("block", sort=False) if len(part) > 1)
        if rest is not None and len(rest) > 1:
            yield links(rest)

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
