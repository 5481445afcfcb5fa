"""Lines of one byte range to records, inside tasks.

A range may begin inside a quoted cell. Whether it does is only known once all
ranges before it are read, so a range is read under both assumptions: ``OUT``
(it begins with a record) and ``IN`` (it begins inside a quoted cell). Both meet
at a line with quotes, mostly at the first; from there on each record is given
once, as ``BOTH``. A line without quotes is given as it stands: it is a record,
or a piece of the cell that the range began in.
"""

import csv
import gzip
import io
import re
import sys
import urllib.parse
import zlib

import pyarrow as pa
from pyspark import cloudpickle

OUT, IN, BOTH = 0, 1, 2
# a line without quotes; a record of quoted cells that hold no quotes; another record; the first record of a file; the end of a record that began in an earlier range;
# the start of one that ends in a later range; a range inside one cell; and the sum of a range
LINE, QUOTED, RECORD, HEADER, HEAD, TAIL, THROUGH, RANGE = "line", "quoted", "record", "header", "head", "tail", "through", "range"

SCHEMA = (
    "file string, block long, seq long, part int, kind string, under int, cells array<string>, width int, raw string,"
    " out_open boolean, in_open boolean, in_through boolean, reason string"
)
_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("part", pa.int32()), ("kind", pa.string()),
    ("under", pa.int32()), ("cells", pa.list_(pa.string())), ("width", pa.int32()), ("raw", pa.string()),
    ("out_open", pa.bool_()), ("in_open", pa.bool_()), ("in_through", pa.bool_()), ("reason", pa.string()),
])
_ROWS, _CHARS = 4096, 1 << 24  # of a batch, at most; a record is not split

NOT_TEXT, CUT = "bytes that are not UTF-8", "compressed file is cut or broken"

# cells of a line from a record's start, as far as they are closed; and the end of a cell that was open
_CELLS = re.compile(r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)(?:,|\Z))*+')
_CLOSE = re.compile(r'(?:[^"]++|"")*+"[^,]*+(?:,|\Z)')


def ends_open(line, inside):
    """True if a line ends inside a quoted cell. Quotes open a cell at its start only; two inside stand for one."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSE.match(line)
        if not closed:
            return True
        at = closed.end()
        if at == len(line):
            return False
    return _CELLS.match(line, at).end() < len(line)


def parse(record):
    """The rows of one record's text: one, but where bare carriage returns end lines."""
    record = record.removesuffix("\r")
    if '"' not in record and "\r" not in record:
        return [record.split(",")] if record else []
    return [row for row in csv.reader(io.StringIO(record, newline="")) if row]


def width(cells):
    """Cells up to the last one that is not empty."""
    n = len(cells)
    while n and not cells[n - 1]:
        n -= 1
    return n


def quoted_width(record):
    """The width of a record of quoted cells without quotes inside, or None for any other text."""
    if len(record) < 2 or record[0] != '"' or record[-1] != '"':
        return None
    inner = record[1:-1]
    n = inner.count('","')
    if inner.count('"') != 2 * n:
        return None
    end = len(inner)
    while n and inner.endswith('","', 0, end):
        end, n = end - 3, n - 1
    return n + 1 if n or end else 0


class _Cursor:
    """Records of a range under one assumption."""

    def __init__(self, under):
        self.under, self.open = under, under == IN
        self.opening = self.open  # still inside the cell that the range began in
        self.held, self.start = [], 0

    def feed(self, seq, line):
        """(kind, seq, text) where the line ends a record, else None."""
        if not self.held:
            self.start = seq
        self.held.append(line)
        self.open = ends_open(line, self.open)
        if self.open:
            return None
        kind, text = HEAD if self.opening else RECORD, "\n".join(self.held)
        self.held, self.opening = [], False
        return kind, self.start, text


class Range:
    """Reads the lines of one range in order and gives its rows; with ``unsplit`` a record of quoted cells that hold no
    quotes is given as it stands (``QUOTED``), for Spark to split."""

    def __init__(self, file, block, unsplit=False):
        self.file, self.block, self.seq, self.reason, self.unsplit = file, block, 0, None, unsplit
        first = block == 0
        self.cursors = [_Cursor(BOTH)] if first else [_Cursor(OUT), _Cursor(IN)]
        self.headed = not first

    def line(self, line):
        seq, self.seq = self.seq, self.seq + 1
        if seq == 0 and self.block == 0:
            line = line.removeprefix("﻿")
        if '"' not in line and "\r" not in line[:-1]:
            own = self.cursors[0]
            if not own.held and len(self.cursors) == 1:
                if self.headed:
                    if line.rstrip("\r"):
                        yield self._line(seq, BOTH, line)
                    return
            elif not own.held and self.cursors[1].opening and not self.cursors[1].held:
                yield self._line(seq, OUT, line)
                return
        elif self.unsplit and len(self.cursors) == 1 and self.headed and not self.cursors[0].held and "\r" not in line[:-1]:
            record = line.removesuffix("\r")
            n = quoted_width(record)
            if n is not None:
                yield (self.file, self.block, seq, 0, QUOTED, BOTH, None, n, record, None, None, None, None)
                return
        for cursor in self.cursors:
            done = cursor.feed(seq, line)
            if done:
                yield from self._rows(cursor.under, *done)
        if len(self.cursors) == 2 and not any(c.open or c.held for c in self.cursors):
            self.cursors = [_Cursor(BOTH)]

    def _rows(self, under, kind, seq, text):
        if kind == HEAD:
            yield self._row(seq, 0, HEAD, under, None, text)
            return
        # a cell may hold line ends; with carriage returns the record goes to the parser
        n = quoted_width(text) if self.unsplit and self.headed and "\r" not in text else None
        if n is not None:
            yield (self.file, self.block, seq, 0, QUOTED, under, None, n, text, None, None, None, None)
            return
        for part, cells in enumerate(parse(text)):
            kind, self.headed = RECORD if self.headed else HEADER, True
            yield self._row(seq, part, kind, under, cells, None)

    def _line(self, seq, under, line):
        filled = line.removesuffix("\r").rstrip(",")
        return (self.file, self.block, seq, 0, LINE, under, None, filled.count(",") + 1 if filled else 0, line, None, None, None, None)

    def _row(self, seq, part, kind, under, cells, raw):
        return (self.file, self.block, seq, part, kind, under, cells, width(cells) if cells else 0, raw, None, None, None, None)

    def end(self):
        for c in self.cursors:
            if c.held:
                yield self._row(c.start, 0, THROUGH if c.opening else TAIL, c.under, None, "\n".join(c.held))
        out, last = self.cursors[0], self.cursors[-1]
        yield (self.file, self.block, self.seq, 0, RANGE, BOTH, None, 0, None, out.open, last.open, last.opening, self.reason)


def one_slash(path):
    """A path as listings give it."""
    return re.sub(r"^(\w+):///", r"\1:/", path)


def file_path(uri):
    """The path of a file that a scan names by its URI."""
    return one_slash(urllib.parse.unquote(uri))


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _sent(rows):
    held, chars = [], 0
    for row in rows:
        held.append(row)
        cells, raw = row[6], row[8]
        chars += (len(raw) if raw else 0) + (sum(map(len, cells)) + 50 * len(cells) if cells else 0)
        if len(held) == _ROWS or chars > _CHARS:
            yield _batch(held)
            held, chars = [], 0
    if held:
        yield _batch(held)


def split_text(batches):
    """mapInArrow step: rows (value, file, block), the lines of whole ranges in order -> rows of SCHEMA."""

    def rows():
        csv.field_size_limit(2**31 - 1)
        now = None
        for batch in batches:
            files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_pylist()
            names, which = [file_path(f) for f in files.dictionary.to_pylist()], files.indices.to_pylist()
            values = batch.column("value")
            try:
                lines = values.cast(pa.string()).to_pylist()
            except pa.ArrowInvalid:
                lines = values.to_pylist()
            for line, block, name in zip(lines, blocks, which, strict=True):
                name = names[name]
                if now is None or now.block != block or now.file != name:
                    if now:
                        yield from now.end()
                    now = Range(name, block, unsplit=True)
                if isinstance(line, bytes):
                    try:
                        line = line.decode()
                    except UnicodeDecodeError:
                        now.reason = NOT_TEXT
                if not now.reason:
                    yield from now.line(line)
        if now:
            yield from now.end()

    return _sent(rows())


def split_compressed(batches):
    """mapInArrow step: rows (path, content) of gzip files -> rows of SCHEMA; one that is cut or broken is told apart."""

    def rows():
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                now = Range(one_slash(path), 0, unsplit=True)
                try:
                    with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as lines:
                        for line in lines:
                            yield from now.line(line.removesuffix(b"\n").decode())
                except UnicodeDecodeError:
                    now.reason = NOT_TEXT
                except (EOFError, OSError, zlib.error):
                    now.reason = CUT
                yield from now.end()

    return _sent(rows())


def split_joined(batches):
    """mapInArrow step: rows (file, block, seq, raw), the joined texts of records over several ranges -> rows of SCHEMA."""

    def rows():
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for row in batch.to_pylist():
                for part, cells in enumerate(parse(row["raw"])):
                    yield (row["file"], row["block"], row["seq"], part, RECORD, BOTH, cells, width(cells), None, None, None, None, None)

    return _sent(rows())


cloudpickle.register_pickle_by_value(sys.modules[__name__])
