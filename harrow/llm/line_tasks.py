"""Edit distance and the links of one block of lines, inside tasks."""

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle


def within(a, b, limit):
    """True if the edit distance of a and b is at most limit.

    What both share at their start and at their end is left out first. Then come
    bit-parallel columns over the band of 2 * limit + 1 diagonals: vertical and
    horizontal differences are bits of one machine word, and the distance is
    followed along the lowest diagonal, then along the last row. The rows of a
    character are kept for the band alone, so a very long line costs no more
    than its length.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return False
    if limit == 0 or a == b:
        return a == b
    start, most = 0, len(b)
    while start < most:
        middle = (start + most + 1) // 2
        start, most = (middle, most) if a[start:middle] == b[start:middle] else (start, middle - 1)
    a, b = a[start:], b[start:]
    end, most = 0, len(b)
    while end < most:
        middle = (end + most + 1) // 2
        same = a[len(a) - middle:len(a) - end] == b[len(b) - middle:len(b) - end]
        end, most = (middle, most) if same else (end, middle - 1)
    a, b = a[:len(a) - end], b[:len(b) - end]
    rows, ones = len(a), (1 << (2 * limit + 1)) - 1
    places = {}  # character -> (column, its rows in the band of that column)

    def rows_of(c, j):
        column, bits = places.get(c, (j, 0))
        return bits >> (j - column)

    for i, c in enumerate(a[:limit]):
        places[c] = 0, rows_of(c, 0) | 1 << (i + limit)
    up, down = (ones << limit) & ones, 0  # vertical differences of +1 and -1
    distance, low = limit, 1 << (2 * limit)
    for j, c in enumerate(b):
        if j + limit < rows:
            places[a[j + limit]] = j, rows_of(a[j + limit], j) | low
        match = rows_of(c, j)
        diagonal = ((((match & up) + up) ^ up) | match | down) & ones  # cells equal to their upper left neighbour
        right = (down | ~(diagonal | up)) & ones
        left = diagonal & up
        if j + 1 + limit <= rows:
            distance += not diagonal & low
        else:
            last = 1 << (rows - j - 1 + limit)  # the last row in this column's band
            distance += bool(right & last) - bool(left & last)
        if j + 1 + limit <= rows and distance > 2 * limit + (len(a) - len(b)):
            return False
        moved = diagonal >> 1
        up, down = (left | ~(moved | right)) & ones, moved & right
    return distance <= limit


def within_pairs(pairs, limits):
    """Whether each pair (a, b), a not the shorter one, is within its limit: the columns of within, all pairs at once."""
    most = int(max(limits))
    if most == 0 or len(pairs) < 64:
        return np.array([within(a, b, int(k)) for (a, b), k in zip(pairs, limits, strict=True)], bool)
    rows, columns = (np.array([len(p[side]) for p in pairs], np.int64) for side in (0, 1))

    def matrix(side, size, front, filler):
        out = np.full((len(pairs), front + size), filler, np.uint32)
        for x, pair in enumerate(pairs):
            out[x, front:front + len(pair[side])] = np.frombuffer(pair[side].encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.ascontiguousarray(out.T)

    a = matrix(0, int(columns.max()) + 2 * most + 1, most, 0xFFFFFFFF)
    b = matrix(1, int(columns.max()), 0, 0xFFFFFFFE)
    ones, low = (1 << (2 * most + 1)) - 1, 1 << (2 * most)
    bits = 2.0 ** np.arange(2 * most + 1)
    up = np.full(len(pairs), (ones << most) & ones, np.int64)
    down, distance = np.zeros(len(pairs), np.int64), np.minimum(most, rows)
    for j in range(len(b)):
        match = (bits @ (a[j:j + 2 * most + 1] == b[j])).astype(np.int64)
        diagonal = ((((match & up) + up) ^ up) | match | down) & ones
        right = (down | ~(diagonal | up)) & ones
        left = diagonal & up
        last = np.int64(1) << np.clip(rows - j - 1 + most, 0, 2 * most)
        step = np.where(j + 1 + most <= rows, (diagonal & low) == 0, ((right & last) != 0) * 1 - ((left & last) != 0) * 1)
        distance += np.where(j < columns, step, 0)
        moved = diagonal >> 1
        up, down = (left | ~(moved | right)) & ones, moved & right
    return distance <= np.asarray(limits)


def length_classes(steps, widest=64):
    """(least length, limit, width of a segment) of each class of lengths, in order.

    steps: (least length, edits), both rising. The limit + 1 segments of a class
    are as wide as its shortest line allows, up to widest; classes of one limit
    double in length until then.
    """
    out = []
    for x, (least, limit) in enumerate(steps):
        end = steps[x + 1][0] if x + 1 < len(steps) else None
        while end is None or least < end:
            width = min(widest, least // (limit + 1))
            out.append((least, limit, width))
            if width == widest:
                break
            least *= 2
    return out


def reach(classes):
    """Characters at either end of a line in which all segments and their windows lie."""
    return max((limit // 2 + 1) * (width + 1) for _, limit, width in classes)


def _grams(matrix, q):
    """Hashes of all runs of q characters down each column of a matrix of codes: (start, text)."""
    run, out, done = matrix.astype(np.uint64) + np.uint64(1), None, 0
    # a run of a + b characters from one of a and one of b, so in as many steps as q has bits
    for bit in range(q.bit_length()):
        m = 1 << bit
        if q & m:
            if out is None:
                out = run
            else:
                size = len(matrix) - done - m + 1
                out = run[:size] * np.uint64(pow(int(_BASE), done, 1 << 64)) + out[m:m + size]
            done += m
        if done < q:
            size = len(run) - m
            run = run[:size] * np.uint64(pow(int(_BASE), m, 1 << 64)) + run[m:m + size]
    return out


_RANGE = 64  # lengths that go together in a key
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd


def _mix(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def signatures(codes, starts, ends, lengths, classes):
    """(row, key) arrays: two lines that link, the limit that of the shorter one, have a key in common.

    codes: the characters of all lines, of which each has those from its start to
    its end: all, or at least the first and the last reach(classes) ones. The
    shorter line has limit + 1 segments side by side, some from its start and the
    others from its end. Going inwards, a first segment that stands whole in the
    other line has at most as many edits before it as it has segments before it,
    on one of the two sides at least: so it is shifted by that number at most. A
    segment is named by the smallest hash of its runs of q characters, so that
    the few smallest hashes over all shifts name all windows that could equal it.
    The key also holds the class and a range of 64 lengths; a line takes the
    class below and the range below, too, where a shorter partner may be in them.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    bounds = [c[0] for c in classes[1:]] + [1 << 62]
    for number, ((least, limit, width), bound) in enumerate(zip(classes, bounds, strict=True)):
        rows = np.flatnonzero((lengths >= least) & (lengths - limit < bound))
        if not len(rows):
            continue
        q = min(width, 24, max(10, width - 6))
        cells = np.stack([(lengths[rows] - limit) // _RANGE, lengths[rows] // _RANGE]).astype(np.uint64)
        two = cells[0] != cells[1]
        for side, parts in ((0, limit // 2 + 1), (1, (limit + 1) // 2)):
            if not parts:
                continue
            places = np.arange(parts * width + parts - 1)[:, None]
            matrix = codes[ends[rows] - 1 - places if side else starts[rows] + places]
            grams = _grams(matrix, q)
            for i in range(parts):
                before = None
                for start in range(i * width - i, i * width + i + 1):
                    least_hash = grams[start:start + width - q + 1].min(axis=0)
                    new = slice(None) if before is None else np.flatnonzero(least_hash != before)
                    before = least_hash
                    key = _mix(least_hash[new] + np.uint64((number * 2 + side) * 4096 + i + 1))
                    found.append((rows[new], _mix(key + cells[1][new])))
                    also = two[new]
                    found.append((rows[new][also], _mix(key[also] + cells[0][new][also])))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _signed(column, lengths, classes, cut):
    """signatures of an Arrow column of lines; of lines over 2 * cut characters the first and last cut ones."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    text = column.buffers()[2][offsets[0]:offsets[-1]].to_pybytes().decode("utf-8", "surrogatepass")
    ends = np.cumsum(np.minimum(lengths, 2 * cut))
    return signatures(_codes([text]), ends - np.minimum(lengths, 2 * cut), ends, lengths, classes)


def signer(classes):
    """mapInArrow step: rows with id, n and line (null: no signs) -> the same with signs in place of the line, where an id
    comes first. Of lines over 2 * reach(classes) characters the first and last reach(classes) ones are given."""
    cut = reach(classes)

    def run(batches):
        seen = set()  # of a task: a line in very many texts gives its signs once
        for batch in batches:
            ids, lengths = batch.column("id").to_numpy(), batch.column("n").to_numpy().astype(np.int64)
            if len(seen) > 500_000:
                seen.clear()
            some, found = [], []
            for x, (i, known) in enumerate(zip(ids.tolist(), batch.column("line").is_valid().to_pylist(), strict=True)):
                if known and i not in seen:
                    seen.add(i)
                    some.append(x)
            some = np.array(some, np.int64)
            for part in np.split(some, range(4096, len(some), 4096)):
                if len(part):
                    rows, keys = _signed(batch.column("line").take(pa.array(part)), lengths[part], classes, cut)
                    found.append((part[rows], keys))
            rows, keys = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, np.uint64))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(ids)))])
            keys = keys[np.argsort(rows, kind="stable")].view(np.int64)
            signs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys))
            kept = [c for c in batch.schema.names if c != "line"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), signs], names=[*kept, "signs"])

    return run


def _counts(line, letters=32):
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(codes % letters, minlength=letters)


def links(ids, lines, classes):
    """Pairs of ids that span the linked lines of one block.

    Lines that share a signature and are not connected yet are looked at in
    order of length. Those whose counts of characters differ by more than twice
    the limit (an edit moves two counts by one at most) or whose lengths differ
    by more than it go by vectors; the rest are compared.
    """
    if not ids:
        return []
    order = sorted(range(len(ids)), key=lambda x: (len(lines[x]), lines[x]))
    ids, lines = [ids[x] for x in order], [lines[x] for x in order]
    lengths = np.array([len(t) for t in lines], np.int64)
    limits = np.array([c[1] for c in classes])[np.searchsorted([c[0] for c in classes], lengths, "right") - 1]
    ends = np.cumsum(lengths)
    rows, keys = signatures(_codes(lines), ends - lengths, ends, lengths, classes)
    by_key = np.lexsort((rows, keys))
    rows, keys = rows[by_key], keys[by_key]
    starts = np.searchsorted(keys, keys)
    places = np.argsort(rows, kind="stable")
    cuts = np.searchsorted(rows[places], np.arange(len(lines) + 1))
    counts = np.array([_counts(t) for t in lines], np.int32).reshape(len(lines), -1)
    label, members, found, waiting = np.arange(len(lines)), [[x] for x in range(len(lines))], [], []

    def join(x, y):
        if label[x] != label[y]:
            found.append((ids[x], ids[y]))
            small, large = sorted((int(label[x]), int(label[y])), key=lambda c: len(members[c]))
            label[members[small]] = large
            members[large] += members[small]
            members[small] = []

    def compare():
        apart = [(x, y) for x, y in waiting if label[x] != label[y]]
        waiting.clear()
        if apart:
            close = within_pairs([(lines[x], lines[y]) for x, y in apart], [limits[y] for _, y in apart])
            for (x, y), near in zip(apart, close.tolist(), strict=True):
                if near:
                    join(x, y)

    for x, line in enumerate(lines):
        near = np.zeros(x, bool)
        for place in places[cuts[x]:cuts[x + 1]].tolist():
            earlier = rows[starts[place]:place]
            near[earlier[earlier < x]] = True
        near = np.flatnonzero(near)
        near = near[(label[near] != label[x]) & (lengths[x] - lengths[near] <= limits[near])]
        apart = np.abs(counts[near] - counts[x]).sum(axis=1)
        near, apart = near[apart <= 2 * limits[near]], apart[apart <= 2 * limits[near]]
        near = near[np.argsort(apart, kind="stable")]
        # the likeliest partners at once, so that a group of copies stays one comparison a line; the rest in bulk
        for y in near[:4].tolist():
            if label[y] != label[x] and within(line, lines[y], int(limits[y])):
                join(x, y)
        waiting += [(x, y) for y in near[label[near] != label[x]].tolist()]
        if len(waiting) * (len(line) + 64) > 2_000_000:
            compare()
    compare()
    return found


_SMALL = 1000  # lines of a block of which each two are looked at, so that many blocks are done at once
_LONG = 20_000  # characters of a line that is compared alone


def _codes(lines):
    return np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)


def _edges(codes, starts, steps, shorter):
    """The number of equal characters of each two texts from the two given starts on, going by steps (1 or -1)."""
    places = np.arange(int(shorter.max())) * steps
    a, b = (codes[np.clip(s[:, None] + places, 0, len(codes) - 1)] for s in starts)
    stop = np.ones((len(shorter), a.shape[1] + 1), bool)
    stop[:, :-1] = (a != b) | (np.arange(a.shape[1]) >= shorter[:, None])
    return stop.argmax(axis=1)


def _banded(codes, a, b, rows, columns, limits):
    """Whether texts from places a (of so many rows) and b (so many columns, not more) of codes are within their limits.

    The columns of within, all pairs at once and 32 columns at a time; pairs that are decided drop out in between.
    """
    out = np.zeros(len(a), bool)
    most = int(limits.max())
    wide, ones, low = 2 * most + 1, (1 << (2 * most + 1)) - 1, 1 << (2 * most)
    left = np.arange(len(a))
    up, down = np.full(len(a), (ones << most) & ones, np.int64), np.zeros(len(a), np.int64)
    distance = np.minimum(most, rows)
    for first in range(0, int(columns.max()), 32):
        n, m = rows[left], columns[left]
        size = min(32, int(m.max()) - first)
        at = np.arange(first - most, first + size + most)
        band = codes[np.clip(a[left][:, None] + at, 0, len(codes) - 1)]
        band[(at < 0) | (at >= n[:, None])] = 0xFFFFFFFF
        at = np.arange(first, first + size)
        text = codes[np.clip(b[left][:, None] + at, 0, len(codes) - 1)]
        equal = np.lib.stride_tricks.sliding_window_view(band, wide, axis=1) == text[:, :, None]
        packed = np.packbits(equal, axis=2, bitorder="little")
        matches = sum(packed[:, :, i].T.astype(np.int64) << (8 * i) for i in range(packed.shape[2]))
        for j, match in enumerate(matches, first):
            diagonal = ((((match & up) + up) ^ up) | match | down) & ones
            right = (down | ~(diagonal | up)) & ones
            lower = diagonal & up
            last = np.int64(1) << np.clip(n - j - 1 + most, 0, 2 * most)
            step = np.where(j + 1 + most <= n, (diagonal & low) == 0, ((right & last) != 0) * 1 - ((lower & last) != 0) * 1)
            distance += np.where(j < m, step, 0)
            moved = diagonal >> 1
            up, down = (lower | ~(moved | right)) & ones, moved & right
        done = m <= first + size
        out[left[done]] = distance[done] <= limits[left[done]]
        # the end lies n - m diagonals off the upper one, and no diagonal's distances fall
        lost = (first + size + most <= n) & (distance > limits[left] + most - (n - m))
        go = ~(done | lost)
        if not go.any():
            break
        left, up, down, distance = left[go], up[go], down[go], distance[go]
    return out


def _close(lines, codes, starts, lengths, x, y, limits):
    """Whether the lines x and y, those of y not the shorter ones, are within the limits: in bulk, long ones one by one."""
    out = np.zeros(len(x), bool)
    order = np.argsort(lengths[x], kind="stable")
    alone = (lengths[y] > _LONG) | (limits > 25)
    for k in np.flatnonzero(alone).tolist():
        out[k] = within(lines[y[k]], lines[x[k]], int(limits[k]))
    order = order[~alone[order] & (lengths[y] - lengths[x] <= limits)[order]]
    while len(order):
        # as many of the shortest as fit in a matrix of 2^20 characters
        cells = np.arange(1, len(order) + 1) * lengths[x[order]]
        some = order[:max(1, int(np.searchsorted(cells, 1 << 20, "right")))]
        order = order[len(some):]
        a, b, n, m, k = starts[y[some]], starts[x[some]], lengths[y[some]], lengths[x[some]], limits[some]
        front = _edges(codes, (a, b), 1, m)
        back = np.minimum(_edges(codes, (a + n - 1, b + m - 1), -1, m), m - front)
        n, m = n - front - back, m - front - back
        out[some] = n <= k
        rest = np.flatnonzero((n > k) & (m > 0))
        rest = rest[np.argsort(m[rest], kind="stable")]
        for part in np.split(rest, range(4096, len(rest), 4096)):
            if len(part):
                out[some[part]] = _banded(codes, a[part] + front[part], b[part] + front[part], n[part], m[part], k[part])
    return out


def small_links(blocks, ids, lines, classes):
    """Pairs of ids that span the linked lines of many blocks: as links, each two lines of a block looked at.

    blocks: a number for each line. Pairs that lengths or counts of characters tell apart go by vectors. Of the rest each
    line's likeliest partner is compared, then its next two, four and so on, leaving out what is connected by then.
    """
    if not ids:
        return []
    lengths = np.array([len(t) for t in lines], np.int64)
    order = np.lexsort((lengths, np.asarray(blocks)))
    blocks, lengths = np.asarray(blocks)[order], lengths[order]
    ids, lines = [ids[k] for k in order.tolist()], [lines[k] for k in order.tolist()]
    codes = _codes(lines)
    starts = np.cumsum(lengths) - lengths
    limits = np.array([c[1] for c in classes])[np.searchsorted([c[0] for c in classes], lengths, "right") - 1]
    cells = np.repeat(np.arange(len(lines)) * 32, lengths) + codes % 32
    counts = np.bincount(cells, minlength=32 * len(lines)).reshape(-1, 32).astype(np.int32)
    found = []
    x, offset = np.arange(len(lines)), 0
    while len(x):
        offset += 1
        x = x[:np.searchsorted(x, len(lines) - offset)]
        x = x[(blocks[x + offset] == blocks[x]) & (lengths[x + offset] - lengths[x] <= limits[x])]
        apart = np.abs(counts[x] - counts[x + offset]).sum(axis=1)
        near = apart <= 2 * limits[x]
        found.append((x[near], x[near] + offset, apart[near]))
    x, y, apart = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((apart, y))
    x, y = x[order], y[order]
    parent, out, most = list(range(len(lines))), [], 1

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    while len(x):
        rank = np.arange(len(y)) - np.searchsorted(y, y)
        now = rank < most
        near = _close(lines, codes, starts, lengths, x[now], y[now], limits[x[now]])
        for a, b in zip(x[now][near].tolist(), y[now][near].tolist(), strict=True):
            one, other = root(a), root(b)
            if one != other:
                parent[one] = other
                out.append((ids[a], ids[b]))
        x, y = x[~now], y[~now]
        roots = np.arange(len(lines))
        used = np.unique(np.concatenate([x, y]))
        roots[used] = [root(k) for k in used.tolist()]
        open_ = roots[x] != roots[y]
        x, y, most = x[open_], y[open_], 2 * most
    return out


def linker(classes):
    """mapInPandas step over rows (block, id, line) in order of block -> links (a, b) that span its linked rows.

    Blocks of few lines are done many at a time, others one by one.
    """

    def run(batches):
        out, held, pairs, chars = [], ([], [], []), 0, 0  # numbers of blocks, ids and lines of small blocks
        block, ids, lines = None, [], []

        def end():
            nonlocal pairs, chars
            if len(ids) > _SMALL:
                out.extend(links(ids, lines, classes))
            elif len(ids) > 1:
                for to, what in zip(held, ([pairs] * len(ids), ids, lines), strict=True):
                    to.extend(what)
                pairs += len(ids) * (len(ids) - 1) // 2  # rises by one at least, so it numbers the blocks
                chars += sum(map(len, lines))
            ids.clear()
            lines.clear()

        def flush():
            nonlocal pairs, chars
            out.extend(small_links(*held, classes))
            pairs = chars = 0
            for part in held:
                part.clear()

        for batch in batches:
            for b, i, t in zip(batch["block"], batch["id"], batch["line"], strict=True):
                if b != block:
                    end()
                    block = b
                    if pairs > 500_000 or chars > 2_000_000:
                        flush()
                ids.append(i)
                lines.append(t)
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
            out.clear()
        end()
        flush()
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
