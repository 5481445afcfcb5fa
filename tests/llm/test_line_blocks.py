"""Links of many small blocks of lines, and edges joined inside a task, against brute force."""

import random
import time

import pandas as pd
import pyarrow as pa

from harrow.llm import line_dedup, line_tasks, union_find

CLASSES = line_tasks.length_classes(line_dedup.LIMIT)


def _lines(chance, n, size):
    """Lines of size characters, and copies of some with up to 10 edits."""
    out = []
    while len(out) < n:
        x = list(chance.choice(out)) if out and chance.random() < 0.7 else chance.choices("abcdeé界🙂 ", k=size)
        for _ in range(chance.randint(0, 10)):
            at = chance.randint(0, len(x))
            x[at:at + chance.randint(0, 1)] = chance.choices("abcde界", k=chance.randint(0, 1))
        out.append("".join(x))
    return out


def _components(n, pairs):
    forest = union_find.Forest(n)
    for a, b in pairs:
        forest.join(a, b)
    return [forest.root(x) for x in range(n)]


def test_small_blocks_by_force():
    chance = random.Random(7)
    ids, lines, blocks = [], [], []
    for block in range(60):
        some = [x for x in _lines(chance, chance.randint(1, 12), chance.choice((24, 60, 130, 210, 700))) if len(x) >= 20]
        lines += some
        blocks += [f"b{block:02d}"] * len(some)
    ids = list(range(len(lines)))
    want = []
    for x in ids:
        for y in ids[:x]:
            a, b = sorted((lines[x], lines[y]), key=len)
            limit = max((k for least, k in line_dedup.LIMIT if len(a) >= least), default=0)
            if blocks[x] == blocks[y] and line_tasks.within(a, b, limit):
                want.append((x, y))
    rows = pd.DataFrame({"block": blocks, "id": ids, "line": lines})
    batches = [rows.iloc[start:start + 50] for start in range(0, len(rows), 50)]
    got = [pair for part in line_tasks.linker(CLASSES)(iter(batches)) for pair in zip(part["a"], part["b"], strict=True)]
    assert _components(len(ids), got) == _components(len(ids), want) and 50 < len(want)


def test_small_blocks_take_little_time():
    chance = random.Random(8)
    words = ["".join(chance.choices("abcdefghij", k=7)) for _ in range(300)]
    rows = []
    for block in range(4000):
        line = " ".join(chance.choices(words, k=32))
        rows += [(str(block), 2 * block, line), (str(block), 2 * block + 1, line[:100] + "!" + line[103:])]
    rows = pd.DataFrame(rows, columns=["block", "id", "line"])
    start = time.process_time()
    found = sum(len(part) for part in line_tasks.linker(CLASSES)(iter([rows])))
    assert found == 4000 and time.process_time() - start < 3


def test_edges_joined_in_a_task():
    edges = [(5, 3), (3, 9), (9, 1), (20, 21), (7, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges[k:k + 2], strict=True)], names=["a", "b"])
               for k in (0, 2, 4)]
    got = [(r["a"], r["b"]) for batch in union_find.joiner()(iter(batches)) for r in batch.to_pylist()]
    assert sorted(got) == [(3, 1), (5, 1), (9, 1), (21, 20)]
