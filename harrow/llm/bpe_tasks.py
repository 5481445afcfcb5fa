"""Byte-pair merges on length-bucketed numpy matrices, with hashed pair lookup and compaction."""

import base64
import gc
import heapq
import json

import numpy as np
import regex

_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
_NONE = np.iinfo(np.int32).max
_WIDTHS = (*range(2, 26, 2), 32, 48, 64, 96, 128, 192, 256)
_CELLS = 1 << 17  # cells of one matrix
_CACHE = 250_000  # pre-tokens whose ids a worker keeps, before those of one more slice
_SLICE = 1_000_000  # characters handled together, but for a longer text
_LOADED = {}


class Merges:
    """Ids of the 256 bytes, bytes of every id, pair -> rank in an open-addressing table, and rank -> id made."""

    def __init__(self, byte_ids, pieces, pairs):
        self.byte_ids = np.array(byte_ids, np.int32)
        self.numbers = list(range(max(pieces) + 1))  # one object for each id, however often it is held
        self.pieces = pieces
        left, right, rank, made = (np.array(x, np.int64) for x in pairs)
        self.made = np.zeros(int(rank.max(initial=0)) + 1, np.int32)
        self.made[rank] = made
        self.mask = np.uint64((1 << (max(len(rank), 2) * 2 - 1).bit_length()) - 1)
        keys = self._key(left, right)
        self.table = np.full(int(self.mask) + 1, _FREE, np.uint64)
        self.rank = np.zeros(int(self.mask) + 1, np.int32)
        waiting, at = np.arange(len(keys)), self._home(keys)
        while len(waiting):
            free = self.table[at] == _FREE
            self.table[at[free]] = keys[waiting[free]]  # of several for one slot the last stays
            won = self.table[at] == keys[waiting]
            self.rank[at[won]] = rank[waiting[won]]
            waiting, at = waiting[~won], (at[~won] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _home(self, keys):
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(20)) & self.mask

    def lookup(self, left, right):
        """Rank of each pair, or the top one if it has none; negative ids are padding and pair with nothing."""
        found = np.full(left.shape, _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self._key(left[open_], right[open_])
        at = self._home(keys)
        while len(open_):
            there = self.table[at]
            hit = there == keys
            found[open_[hit]] = self.rank[at[hit]]
            on = ~hit & (there != _FREE)
            open_, keys, at = open_[on], keys[on], (at[on] + np.uint64(1)) & self.mask
        return found

    def encode(self, texts):
        """Ids of each text (bytes), a tuple each."""
        out = [None] * len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        start = 0
        for width in _WIDTHS:
            rows = np.flatnonzero((sizes > start) & (sizes <= width))
            for i in range(0, len(rows), _CELLS // width):
                self._matrix(rows[i:i + _CELLS // width], width, texts, out)
            start = width
        for i in np.flatnonzero(sizes > start):
            out[i] = self._long(texts[i])
        for i in np.flatnonzero(sizes == 0):
            out[i] = ()
        return out

    def _matrix(self, rows, width, texts, out):
        flat = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in rows), np.uint8)
        ids = self.byte_ids[flat].reshape(len(rows), width)
        sizes = np.array([len(texts[i]) for i in rows])
        ids[np.arange(width) >= sizes[:, None]] = -1
        numbers = self.numbers
        ranks = self.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(rows):
            best = ranks.argmin(axis=1)  # the leftmost of the least
            least = ranks[np.arange(len(rows)), best]
            more = least < _NONE
            if not more.all():
                for i, row in zip(rows[~more], ids[~more].tolist(), strict=True):
                    out[i] = tuple(numbers[x] for x in row if x >= 0)
                rows, ids, ranks, best, least = rows[more], ids[more], ranks[more], best[more], least[more]
            if not len(rows):
                return
            each, width = np.arange(len(rows)), ids.shape[1] - 1
            ids[each, best] = self.made[least]
            # each row is one shorter: what follows the merged pair moves left
            ids = ids[np.arange(width + 1) != best[:, None] + 1].reshape(len(rows), width)
            if width == 1:
                ranks = np.full((len(rows), 1), _NONE, np.int32)
                continue
            ranks = ranks[np.arange(width) != best[:, None]].reshape(len(rows), width - 1)
            for side in (best - 1, best):
                fits = np.flatnonzero((side >= 0) & (side < width - 1))
                at = side[fits]
                ranks[fits, at] = self.lookup(ids[fits, at], ids[fits, at + 1])

    def _long(self, text):
        """The same merges for a text longer than every bucket: the next pair comes from a heap."""
        ids = self.byte_ids[np.frombuffer(text, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.lookup(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i] = int(self.made[rank])
            ids[j] = -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    r = int(self.lookup(np.array([ids[x]], np.int32), np.array([ids[after[x]]], np.int32))[0])
                    if r < _NONE:
                        heapq.heappush(heap, (r, x, ids[x], ids[after[x]]))
        return tuple(self.numbers[x] for x in ids if x >= 0)


def from_ranks(data):
    """Merges of a rank file: any two neighbours merge whose joined bytes have a rank."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    left, right, rank = [], [], []
    for piece, r in ranks.items():
        for i in range(1, len(piece)):
            a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    return Merges([ranks[bytes([i])] for i in range(256)], {r: p for p, r in ranks.items()}, (left, right, rank, rank))


def from_json(data):
    """(merges, special strings) of a tokenizer file with byte-level pieces and a list of merges."""
    spec = json.loads(data)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    kinds = [(x["content"], x["lstrip"], x["rstrip"], x["single_word"], x["normalized"]) for x in spec["added_tokens"]]
    plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if not plain or spec["normalizer"] or any(any(x[1:]) for x in kinds):
        raise ValueError("only plain byte-level files are handled")
    letters = _letters()
    byte_of = {c: b for b, c in enumerate(letters)}
    specials = [x[0] for x in kinds]
    pieces = {i: bytes(byte_of[c] for c in p) for p, i in vocab.items() if p not in specials}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    left, right = [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs]
    made = [vocab[a + b] for a, b in pairs]
    return Merges([vocab[c] for c in letters], pieces, (left, right, list(range(len(pairs))), made)), specials


def _letters():
    """The printable character that stands for each byte in byte-level files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Ids:
    """Ids of pre-tokens: known ones from memory, the new ones of a batch in matrices.

    What a worker process has loaded and learned stays for its later tasks.
    """

    def __init__(self, load, data):
        key = (load.__name__, hash(data))
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = load(data), {}
        self.merges, self.known = _LOADED[key]

    def learn(self, pieces):
        if len(self.known) > _CACHE:
            self.known.clear()
        known = self.known
        new = list({p for p in pieces if p not in known})
        known.update(zip(new, self.merges.encode([p.encode("utf-8", "surrogatepass") for p in new]), strict=True))
        return known


def splitter(pattern):
    return regex.compile(pattern).findall


def slices(texts):
    """The texts of a batch (null: empty) in runs of bounded size, without garbage collection meanwhile."""
    gc.disable()  # millions of short-lived strings and tuples, none in a cycle
    try:
        part, size = [], 0
        for t in texts:
            part.append(t or "")
            size += len(part[-1])
            if size >= _SLICE:
                yield part
                part, size = [], 0
        if part:
            yield part
    finally:
        gc.enable()
