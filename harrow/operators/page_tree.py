"""Page markup to node and piece lists: the part that runs in Python workers.

Needs the standard library and pyarrow only, and is shipped by value with the
job, so executors need no copy of this package.
"""

import re
import sys
from array import array
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# --- fixed values -----------------------------------------------------------
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
HIDDEN_TEXT_TAGS = frozenset(("script", "style", "template", "rt", "rp"))
VERBATIM_TAGS = frozenset(("pre", "textarea"))
ASCII_SPACE = "\n\t\x0c\r "
# ----------------------------------------------------------------------------

NODES_TYPE = (
    "array<struct<id:int,parent:int,last:int,depth:int,tag:string,attrs:map<string,string>,p0:int,p1:int>>"
)
PARSED_SCHEMA = (
    f"page_id bigint, url string, nodes {NODES_TYPE}, "
    "strings array<string>, owners array<int>"
)

# pages per output batch: keeps a worker's memory near a few pages' size
_SLICE = 64

# plain tags that a worker remembers with what they say: so many, none longer; and page layouts, of pages not longer
_KNOWN_TAGS, _KNOWN_LENGTH = 4096, 200
_KNOWN_LAYOUTS, _LAYOUT_LENGTH = 1024, 4096


# a tag in its plain form: closing, or opening with double-quoted attributes only
_PLAIN_TAG = re.compile(
    r'<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:\s+[a-zA-Z][-a-zA-Z0-9_:]*="[^"]*")*))>'
)
_TAG_AND_TEXT = re.compile(rf"<([^<>]{{1,{_KNOWN_LENGTH - 2}}})>([^<]*)")
_PLAIN_ATTR = re.compile(r'([a-zA-Z][-a-zA-Z0-9_:]*)="([^"]*)"')


def _numbers(values):
    """An array of C integers as an Arrow column, not copied."""
    return pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])


class _Trees(HTMLParser):
    """Node and string columns of a run of pages.

    Forgiving rules: void tags close at once, an end tag closes the nearest open
    tag of its name or is ignored, and no start tag closes another.

    Tags in plain form take a short path, and the same tag is read once for all
    pages; all other markup goes through the standard tokenizer at its place.
    """

    def __init__(self, known=None, layouts=None):
        super().__init__(convert_charrefs=True)
        self.known = {} if known is None else known  # text between < and > -> _plain
        self.layouts = {} if layouts is None else layouts  # tags of a page and where text follows -> its tree
        # numbers stand as Arrow takes them; no parent is -1
        self.page_ends, self.string_ends, self.attr_ends = array("i", [0]), array("i", [0]), array("i", [0])
        self.ids, self.parents, self.lasts, self.depths = array("i"), array("i"), array("i"), array("i")
        self.p0, self.p1, self.owners = array("i"), array("i"), array("i")
        self.tags, self.attr_names, self.attr_values, self.strings = [], [], [], []

    def _start_page(self):
        self._first, self._first_string = len(self.ids), len(self.strings)
        self._stack, self._open, self._text = [], {}, []
        self._hidden = self._verbatim = 0
        self._append("[document]", ())
        self._stack.append((0, "[document]"))

    def _append(self, tag, attrs):
        node = len(self.ids) - self._first
        at = len(self.strings) - self._first_string
        self.ids.append(node)
        self.parents.append(self._stack[-1][0] if self._stack else -1)
        self.lasts.append(node)
        self.depths.append(len(self._stack))
        self.tags.append(tag)
        self.p0.append(at)
        self.p1.append(at)
        if attrs:
            unique = dict(attrs)
            self.attr_names.extend(unique)
            self.attr_values.extend(v or "" for v in unique.values())
        self.attr_ends.append(len(self.attr_names))
        return node

    def _flush(self):
        text = "".join(self._text)
        self._text.clear()
        if self._hidden:
            return
        if not self._verbatim and not text.strip(ASCII_SPACE):
            text = "\n" if "\n" in text else " "
        self.strings.append(text)
        self.owners.append(self._stack[-1][0])

    def _pop(self):
        node, tag = self._stack.pop()
        self.lasts[self._first + node] = len(self.ids) - self._first - 1
        self.p1[self._first + node] = len(self.strings) - self._first_string
        if tag in HIDDEN_TEXT_TAGS:
            self._hidden -= 1
        elif tag in VERBATIM_TAGS:
            self._verbatim -= 1
        return tag

    def handle_starttag(self, tag, attrs):
        if self._text:
            self._flush()
        node = self._append(tag, attrs)
        if tag in VOID_TAGS:
            return
        self._stack.append((node, tag))
        self._open[tag] = self._open.get(tag, 0) + 1
        self._hidden += tag in HIDDEN_TEXT_TAGS
        self._verbatim += tag in VERBATIM_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_comment(None)
        self._append(tag, attrs)

    def handle_endtag(self, tag):
        if self._text:
            self._flush()
        if self._open.get(tag):
            popped = None
            while popped != tag:
                popped = self._pop()
                self._open[popped] -= 1

    def handle_data(self, data):
        self._text.append(data)

    def handle_comment(self, data):
        if self._text:
            self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.handle_comment(None)
        if data.upper().startswith("CDATA["):
            self._text.append(data[6:])
            self._flush()

    def updatepos(self, i, j):
        return j  # no line numbers wanted

    def _markup(self, html, at):
        """Handle the markup at a ``<``; gives the place after it, or -1 where
        the page ends inside it."""
        plain = _PLAIN_TAG.match(html, at)
        if plain:
            closing, opening, attrs = plain.groups()
            if closing:
                self.handle_endtag(closing.lower())
                return plain.end()
            tag = opening.lower()
            if tag not in self.CDATA_CONTENT_ELEMENTS:
                found = [(k.lower(), unescape(v)) for k, v in _PLAIN_ATTR.findall(attrs)] if attrs else ()
                self.handle_starttag(tag, found)
                return plain.end()
        following = html[at + 1:at + 2]
        if following.isascii() and following.isalpha():
            return self.parse_starttag(at)
        if following == "/":
            return self.parse_endtag(at)
        if html.startswith("<!--", at):
            return self.parse_comment(at)
        if following == "?":
            return self.parse_pi(at)
        if following == "!":
            return self.parse_html_declaration(at)
        self.handle_data("<")
        return at + 1

    def _plain(self, html, mark, end):
        """What the plain tag between two places says: whether it closes, its name, its attributes, and whether it is
        void, hides text or keeps it as it is; and its names in a layout, with text after it and without, where it does
        neither. None for all other markup."""
        plain = _PLAIN_TAG.fullmatch(html, mark, end)
        if not plain:
            return None
        closing, opening, attrs = plain.groups()
        tag = (closing or opening).lower()
        if opening and tag in self.CDATA_CONTENT_ELEMENTS:
            return None
        pairs = dict((k.lower(), unescape(v)) for k, v in _PLAIN_ATTR.findall(attrs)) if attrs else None
        hides, keeps = tag in HIDDEN_TEXT_TAGS, tag in VERBATIM_TAGS
        names = (None, None) if hides or keeps else (f"/{tag}", f"/{tag} ") if closing else (tag, f"{tag} ")
        said = bool(closing), tag, pairs, tag in VOID_TAGS, hides, keeps, *names
        if len(self.known) < _KNOWN_TAGS:
            self.known[html[mark + 1:end - 1]] = said
        return said

    def _walk(self, html):
        self.reset()
        self.rawdata = html
        find, known, plain = html.find, self.known.get, self._plain
        first, first_string, stack, opened, pending = self._first, self._first_string, self._stack, self._open, self._text
        ids, parents, lasts, depths, tags, p0, p1 = self.ids, self.parents, self.lasts, self.depths, self.tags, self.p0, self.p1
        attr_ends, attr_names, attr_values = self.attr_ends, self.attr_names, self.attr_values
        strings, owners = self.strings, self.owners
        at = 0
        while (mark := find("<", at)) >= 0:
            if mark > at:
                text = html[at:mark]
                pending.append(unescape(text) if "&" in text else text)
            end = find(">", mark, mark + _KNOWN_LENGTH) + 1
            said = (known(html[mark + 1:end - 1]) or plain(html, mark, end)) if end else None
            if said:  # as the handlers below, in one place
                closes, tag, attrs, void, hides, keeps, _, _ = said
                if pending:
                    if not self._hidden:
                        text = pending[0] if len(pending) == 1 else "".join(pending)
                        if not self._verbatim and not text.strip(ASCII_SPACE):
                            text = "\n" if "\n" in text else " "
                        strings.append(text)
                        owners.append(stack[-1][0])
                    pending.clear()
                if closes:
                    if opened.get(tag):
                        popped = None
                        while popped != tag:
                            popped = self._pop()
                            opened[popped] -= 1
                else:
                    node, here = len(ids) - first, len(strings) - first_string
                    ids.append(node)
                    parents.append(stack[-1][0])
                    lasts.append(node)
                    depths.append(len(stack))
                    tags.append(tag)
                    p0.append(here)
                    p1.append(here)
                    if attrs:
                        attr_names.extend(attrs)
                        attr_values.extend(attrs.values())
                    attr_ends.append(len(attr_names))
                    if not void:
                        stack.append((node, tag))
                        opened[tag] = opened.get(tag, 0) + 1
                        if hides:
                            self._hidden += 1
                        elif keeps:
                            self._verbatim += 1
                at = end
                continue
            at = self._markup(html, mark)
            if at < 0:
                self.rawdata = html[mark:]
                self.close()
                return
            if self.cdata_elem:  # script or style: nothing counts before its end tag
                end = re.compile(rf"</\s*{self.cdata_elem}\s*>", re.I).search(html, at)
                if end is None:
                    return
                self._text.append(html[at:end.start()])
                self.handle_endtag(self.cdata_elem)
                self.clear_cdata_mode()
                at = end.end()
        if at < len(html):
            self._text.append(unescape(html[at:]))

    def _tokens(self, html):
        """What each tag of a short page says, the text after each, and the page's layout; None where a page has other
        markup than plain tags, text before the first, or text that is hidden or kept as it is."""
        if not html or html[0] != "<" or len(html) > _LAYOUT_LENGTH:
            return None
        tokens = _TAG_AND_TEXT.findall(html)
        if len(tokens) != html.count("<"):
            return None
        known, texts = self.known.get, [t for _, t in tokens]
        said = [known(h) or self._plain(f"<{h}>", 0, len(h) + 2) for h, _ in tokens]
        if None in said:
            return None
        layout = tuple([s[6] if t else s[7] for s, t in zip(said, texts)])
        return None if None in layout else (said, texts, layout)

    def _columns_of_tree(self):
        return self.ids, self.parents, self.lasts, self.depths, self.tags, self.p0, self.p1, self.owners

    def _add_known(self, tree, said, texts):
        """A page whose layout has been met: its tree is the same, texts and attributes are its own."""
        for column, values in zip(self._columns_of_tree(), tree):
            column.extend(values)
        for text in texts:
            if text:
                if "&" in text:
                    text = unescape(text)
                if not text.strip(ASCII_SPACE):
                    text = "\n" if "\n" in text else " "
                self.strings.append(text)
        names, values, ends = self.attr_names, self.attr_values, [len(self.attr_names)]
        for s in said:
            if not s[0]:
                if s[2]:
                    names.extend(s[2])
                    values.extend(s[2].values())
                ends.append(len(names))
        self.attr_ends.extend(ends)
        self.page_ends.append(len(self.ids))
        self.string_ends.append(len(self.strings))

    def add(self, html):
        """Parse one page. Markup that the tokenizer rejects gives an empty page."""
        tokens = self._tokens(html)
        if not tokens:
            self._add_walked(html)
            return
        said, texts, layout = tokens
        tree = self.layouts.get(layout)
        if tree:
            self._add_known(tree, said, texts)
            return
        self._add_walked(html)
        if len(self.layouts) < _KNOWN_LAYOUTS:
            first, first_string = self._first, self._first_string
            *nodes, owners = self._columns_of_tree()
            self.layouts[layout] = [*(column[first:] for column in nodes), owners[first_string:]]

    def _add_walked(self, html):
        self._start_page()
        try:
            self._walk(html or "")
        except AssertionError:
            self._drop_page()
        if self._text:
            self._flush()
        while self._stack:
            self._pop()
        self.page_ends.append(len(self.ids))
        self.string_ends.append(len(self.strings))

    def _drop_page(self):
        for column in (self.ids, self.parents, self.lasts, self.depths, self.tags, self.p0, self.p1):
            del column[self._first:]
        del self.attr_ends[self._first + 1:]
        del self.attr_names[self.attr_ends[-1]:], self.attr_values[self.attr_ends[-1]:]
        del self.strings[self._first_string:], self.owners[self._first_string:]
        self._start_page()

    def columns(self):
        """The parsed pages as Arrow list columns: nodes, strings, owners."""
        parents = _numbers(self.parents)
        parents = pc.if_else(pc.less(parents, 0), pa.scalar(None, pa.int32()), parents)
        attrs = pa.MapArray.from_arrays(
            _numbers(self.attr_ends), pa.array(self.attr_names, pa.string()), pa.array(self.attr_values, pa.string())
        )
        nodes = pa.StructArray.from_arrays(
            [_numbers(self.ids), parents, _numbers(self.lasts), _numbers(self.depths), pa.array(self.tags, pa.string()), attrs,
             _numbers(self.p0), _numbers(self.p1)],
            names=["id", "parent", "last", "depth", "tag", "attrs", "p0", "p1"],
        )
        pages, strings = _numbers(self.page_ends), _numbers(self.string_ends)
        return [
            pa.ListArray.from_arrays(pages, nodes),
            pa.ListArray.from_arrays(strings, pa.array(self.strings, pa.string())),
            pa.ListArray.from_arrays(strings, _numbers(self.owners)),
        ]


def parse_batches(batches):
    known, layouts = {}, {}
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            part = batch.slice(start, _SLICE)
            trees = _Trees(known, layouts)
            for html in part.column("html"):
                trees.add(html.as_py())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), *trees.columns()],
                names=["page_id", "url", "nodes", "strings", "owners"],
            )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
