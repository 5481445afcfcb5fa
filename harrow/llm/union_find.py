"""Union-find over rows inside a task."""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle


class Forest:
    def __init__(self, n):
        self.parent = list(range(n))

    def root(self, x):
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x, y):
        """True if x and y were apart."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


_EDGES = 1_000_000  # that are held at once


def _joined(a, b):
    """(node, smallest node that it reaches by these edges) of all nodes but the smallest ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    forest = Forest(len(nodes))
    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True):
        forest.join(x, y)
    roots = np.array([forest.root(x) for x in range(len(nodes))], np.int64)
    rest = roots != np.arange(len(nodes))
    return nodes[rest], nodes[roots[rest]]


def joiner():
    """mapInArrow step: edges (a, b) of longs -> edges that connect the same nodes, from each to the smallest one of its group."""

    def run(batches):
        held, size = [], 0

        def sent():
            a, b = _joined(*(np.concatenate([batch.column(c).to_numpy() for batch in held]) for c in ("a", "b")))
            for start in range(0, len(a), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(x[start:start + 65536], pa.int64()) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _EDGES:
                yield from sent()
                held, size = [], 0
        if held:
            yield from sent()

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
