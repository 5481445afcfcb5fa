"""Character model, noisy-channel decoding of disguised words, and features of restored texts, inside tasks."""

import math
import re
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# characters as the model sees them: 0 a word's edge, 1-26 a-z, then one of 32 classes for all other letters
SIZE = 59
_OTHERS = 32
_HELD = 400_000

# Letters that a sign stands for in disguised words.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
# End of fixed values.

_SIGNS = "".join(re.escape(c) for c in LEET if not c.isdigit())
_LETTER = r"[^\W\d_]"
WORD = re.compile(f"{_LETTER}+")
# letters and digits with signs between them, or one before them
_TOKEN = re.compile(rf"[{_SIGNS}]?[^\W_]+(?:[{_SIGNS}]+[^\W_]+)*")
_DISGUISED = re.compile(rf"{_LETTER}[\d{_SIGNS}]|[\d{_SIGNS}]{_LETTER}|({_LETTER})\1\1")
_ONE = rf"(?:{_LETTER}|[\d{_SIGNS}])"
_SPACED = re.compile(rf"(?<![\w{_SIGNS}]){_ONE}(?:[ ._*-]{{1,2}}{_ONE}){{2,}}(?![\w{_SIGNS}])")
# what any such run holds: a single character between gaps, and one after it
_MAYBE_SPACED = re.compile(rf"[ ._*-][\w{_SIGNS}][ ._*-]{{1,2}}[\w{_SIGNS}](?![\w{_SIGNS}])")
_TRIPLE = re.compile(r"(.)\1\1", re.DOTALL)
_RUN = re.compile(r"(.)\1*", re.DOTALL)

# costs of the channel, as negative logarithms of its probabilities
_SWAP = 1.5  # a sign for a letter
_PLAIN = 4.0  # a digit or sign that stands for itself inside a word
_ONCE, _TWICE = 0.7, 1.2  # a run of equal letters, of one letter or of two
_JOIN, _PART = 0.1, 3.0  # a gap of a spaced word, or a gap between words


def code(c):
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % _OTHERS if c.isalpha() else 0


def word_counter(batches):
    """mapInArrow step: texts -> (word, n), lower-cased words added up over many texts."""
    counts = Counter()

    def out():
        found = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()
        return found

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(WORD.findall(text.lower()))
            if len(counts) > _HELD:
                yield out()
    yield out()


def gram_counter(batches):
    """mapInPandas step: (word, n) -> (gram, n) for each three characters in a row, with the word's edges.

    A word with a letter three times in a row may be disguised and teaches nothing.
    """
    counts = np.zeros(SIZE ** 3, np.int64)
    for batch in batches:
        for word, n in zip(batch["word"], batch["n"], strict=True):
            if _DISGUISED.search(word):
                continue
            a = b = 0
            for c in (*map(code, word), 0):
                counts[(a * SIZE + b) * SIZE + c] += n
                a, b = b, c
    found = np.flatnonzero(counts)
    yield pd.DataFrame({"gram": found, "n": counts[found]})


def costs(grams, numbers):
    """Negative log-probabilities [a, b, c] of c after a and b, smoothed by shorter histories."""
    counts = np.zeros(SIZE ** 3)
    counts[grams] = numbers
    counts = counts.reshape(SIZE, SIZE, SIZE)
    two, one = counts.sum(0), counts.sum((0, 1))
    alone = (one + 1) / (one.sum() + SIZE)
    after = (two + 5 * alone) / (two.sum(1, keepdims=True) + 5)
    return -np.log((counts + 5 * after) / (counts.sum(2, keepdims=True) + 5))


class Restorer:
    """Restores disguised words: the likeliest way through the lattice of what each sign may stand for."""

    def __init__(self, table):
        self.table = table.tolist()
        self.known = {}

    def decode(self, lattice):
        """The cheapest reading. lattice: for each place its choices (text, cost); text of no letter is a word's edge."""
        states = {(0, 0): (0.0, None)}
        table = self.table
        for choices in lattice:
            new = {}
            for (a, b), (cost, path) in states.items():
                for text, extra in choices:
                    x, y, total = a, b, cost + extra
                    for c in text:
                        z = code(c)
                        total += table[x][y][z] if z or y else 0.0  # two edges in a row are one
                        x, y = (y, z) if z else (0, 0)
                    if (x, y) not in new or total < new[x, y][0]:
                        new[x, y] = total, (path, text)
            states = new
        ends = (((cost + (table[a][b][0] if b else 0.0)), path) for (a, b), (cost, path) in states.items())
        path = min(ends, key=lambda e: e[0])[1]
        out = []
        while path:
            path, text = path
            out.append(text)
        return "".join(reversed(out))

    def lattice(self, token):
        places = []
        for run in _RUN.finditer(token):
            c, n = run[1], len(run[0])
            if c in LEET:
                signs = [(c * n, _PLAIN * n)]
                for x in LEET[c]:
                    signs.append((x, _SWAP + (_ONCE if n > 1 else 0)))
                    if n > 1:
                        signs.append((x + x, _SWAP + _TWICE))
                places.append(signs)
            elif n < 3:
                places.append([(c * n, 0.0)])
            else:
                # names such as xxx, and languages that double their letters twice, may be meant as they stand
                places.append([(c, _ONCE), (c + c, _TWICE), (c * n, 3.0)])
        return places

    def token(self, token):
        """The text that a token stands for; itself where it is not disguised."""
        if not _DISGUISED.search(token):
            return token
        if token not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[token] = self.decode(self.lattice(token))
        return self.known[token]

    def spaced(self, run):
        """Single characters with gaps between them, joined to words where that is likelier."""
        places = []
        for part in re.findall(r"[ ._*-]+|[^ ._*-]", run):
            if part[0] in " ._*-":
                wide = len(part) > 1
                places.append([("", _JOIN + 2 * wide), (" ", _PART)])
            else:
                places += self.lattice(part)
        return self.decode(places)

    def joined(self, text):
        """A lower-cased text with its spaced words joined."""
        return _SPACED.sub(lambda m: self.spaced(m[0]), text) if _MAYBE_SPACED.search(text) else text

    def text(self, text):
        """The whole text, lower-cased and restored."""
        text = self.joined(text.lower())
        return _TOKEN.sub(lambda m: self.token(m[0]), text)

    def words(self, text):
        """The different words of the restored text."""
        text = self.joined(text.lower())
        found = set()
        for token in set(_TOKEN.findall(text)):
            if token.isalpha() and not _DISGUISED.search(token):
                found.add(token)
            else:
                found.update(WORD.findall(self.token(token)))
        return found


def features(word):
    """A word, and its beginnings of 3 to 7 letters."""
    return [word, *[word[:k] + "-" for k in range(3, min(8, len(word)))]]


def word_lists(shared):
    """mapInPandas step: (toxic, text) -> (toxic, words), the different restored words of each text."""

    def run(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            words = [sorted(restorer.words(t)) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "words": words})

    return run


def evidence(batches):
    """mapInPandas step: (toxic, words) -> (feature, toxic, clean), the texts of each label that hold a feature."""
    counts = {}
    for batch in batches:
        for toxic, words in zip(batch["toxic"], batch["words"], strict=True):
            for f in {f for w in words for f in features(w)}:
                counts.setdefault(f, [0, 0])[0 if toxic else 1] += 1
            if len(counts) > _HELD:
                yield _rows(counts)
                counts = {}
    yield _rows(counts)


def _rows(counts):
    return pd.DataFrame([(f, *n) for f, n in counts.items()], columns=["feature", "toxic", "clean"])


def hits(words, index):
    """{feature's number: how many different words of a text have it}."""
    return Counter(index[f] for w in words for f in features(w) if f in index)


def hit_lists(index):
    def run(batches):
        for batch in batches:
            found = [sorted(hits(w, index).items()) for w in batch["words"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "at": [[i for i, _ in f] for f in found],
                                "n": [[n for _, n in f] for f in found]})

    return run


def fit(rows, size, penalty=1.0, steps=500):
    """(weights, bias) of a logistic regression on log(1 + n), by gradient steps on all rows."""
    toxic = np.array([float(r[0]) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    at = np.array([i for r in rows for i in r[1]], np.int64)
    x = np.log1p(np.array([n for r in rows for n in r[2]], float))
    share = min(max(toxic.mean() if len(rows) else 0.0, 1e-3), 0.4)
    w, bias = np.zeros(size), float(np.log(share / (1 - share)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1 if len(rows) else 1):
        z = bias + np.bincount(row, weights=x * w[at], minlength=len(rows))
        off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic
        slope = np.append(np.bincount(at, weights=x * off[row], minlength=size) + penalty * w, off.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        move = 0.1 * (1 - step / (steps + 1)) * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def has_triple(text):
    """Whether any character stands three times in a row."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    same = x[1:] == x[:-1]
    return bool((same[1:] & same[:-1]).any())


def scorer(shared):
    """Pandas UDF step: texts -> (score, n_restored)."""

    def run(batches):
        table, index, weights, bias = shared.value
        restorer, weights = Restorer(table), weights.tolist()
        starts = {f.removesuffix("-")[:3] for f in index}  # a word that begins otherwise has no feature

        def add(word, seen):
            if word[:3] in starts and word not in seen:
                seen[word] = [index[f] for f in features(word) if f in index]

        for batch in batches:
            out = []
            for text in batch:
                low = "" if text is None else text.lower()
                plain = restorer.joined(low)
                seen, restored, triple = {}, int(plain != low), has_triple(plain)
                for token in set(_TOKEN.findall(plain)):
                    if token.isalpha() and not (triple and _TRIPLE.search(token)):
                        add(token, seen)
                        continue
                    meant = restorer.token(token)
                    restored += meant != token
                    for word in WORD.findall(meant):
                        add(word, seen)
                counts = Counter(f for own in seen.values() for f in own)
                z = bias + math.fsum(weights[f] * math.log1p(n) for f, n in counts.items())
                out.append((1 / (1 + math.exp(-min(max(z, -30), 30))), restored))
            yield pd.DataFrame(out, columns=["score", "n_restored"])

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
