"""Blocks of a page, their costs, and the minimum cut that labels them, in plain Python inside tasks."""

import html
import re
import sys

from pyspark import cloudpickle

# an attribute's name, and its value: in quotes, or bare up to white space or the end of the tag, as HTML has it
_VALUE = r"(?:\s*+=\s*+(?:\"({0}[^\"]*+)\"|'({0}[^']*+)'|({0}[^\s>]*+)))?+"
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)" + _VALUE.format(""))
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+"
    + _VALUE.format("?:") + r")*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAME = re.compile(r"[a-z0-9]+")
# Elements whose content is no text of the page; the content of the first five is not markup either.
_RAW = ("script", "style", "textarea", "title", "noscript")
_DROPPED = {*_RAW, "head", "template", "svg", "iframe", "object", "canvas", "select", "button", "audio", "video",
            "annotation", "annotation-xml"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "br", "wbr", "img", "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt",
    "mroot", "mstyle", "merror", "mpadded", "mphantom", "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover",
    "munderover", "mmultiscripts", "mtable", "mtr", "mtd"}
_FLOW = _INLINE | _DROPPED - {"head", "title"}  # these do not end the block that they stand in
# An open element of the first kind ends where one of the second begins.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
         "th": {"td", "th", "tr"}, "option": {"option"}}
_ENDED = {tag: tuple(k for k, v in _ENDS.items() if tag in v) for tag in _ENDS}
_LISTS = ("table", "ul", "ol", "dl")
_SCOPES = (*_LISTS, "article", "div", "section")
_CLOSES_P = {"p", "div", "article", "section", "aside", "nav", "header", "footer", "main", "form", "ul", "ol", "dl", "table",
             "pre", "blockquote", "figure", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "address", "fieldset", "details"}
_BAD_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
_GOOD_TAGS = {"article", "main"}
_BAD_NAMES = {
    "nav", "navbar", "navigation", "menu", "header", "masthead", "footer", "sidebar", "aside", "ad", "ads", "advert",
    "adverts", "advertisement", "advertising", "banner", "promo", "promotion", "sponsor", "sponsored", "cookie", "cookies",
    "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "login", "comment", "comments", "disqus", "respond", "reply", "replies", "share", "sharing", "social", "related",
    "recommended", "breadcrumb", "breadcrumbs", "pagination", "pager", "widget", "toolbar", "copyright", "search",
    "skip", "contentinfo", "complementary", "dialog"}
_GOOD_NAMES = {"article", "content", "post", "entry", "story", "main", "body", "text", "page"}
_MODIFIERS = {"has", "with", "no", "not", "without", "is", "hide", "show"}  # what follows is no name of the element itself
_SURE, _LIKELY = 1000, 12  # capacities of what an element says, and of content names
_NAMED, _HINT, _LINE = -20, -4, -2  # evidence of a bad name, of one bad word among others, of a content's own header
_NEXT, _SIBLING = 4, 2  # capacities between neighbours in the page, and more if they share a parent
_KIN = 6  # between siblings with other blocks between them


def _named(tag, values):
    """Evidence of a tag's class, id and role: _SURE, _LIKELY, _HINT, _NAMED, _LINE (a header, if content is around it) or 0.

    A name is what stands between blanks. One with bad words alone is bad; one
    with bad and other words, or next to a good name, is a hint. Names that
    start with a modifier (has-sidebar), and ids of headings, which are made
    from their texts, say nothing.
    """
    names = []
    for key, value in values:
        if key != "id" or not re.fullmatch("h[1-6]", tag):
            names += [w for x in value.split() if (w := _NAME.findall(x)) and w[0] not in _MODIFIERS]
    bad = [w for w in names if not _BAD_NAMES.isdisjoint(w)]
    good = [w for w in names if not _GOOD_NAMES.isdisjoint(w) and _BAD_NAMES.isdisjoint(w)]
    if bad and not any({"article", "main"} & set(w) for w in good):
        if all(_BAD_NAMES & set(w) == {"header"} for w in bad):
            owned = any({"article", "post", "entry", "story"} & set(w) for w in bad)
            return _LINE, owned
        return _NAMED if not good and any(_BAD_NAMES.issuperset(w) for w in bad) else _HINT, False
    if any({"article", "main"} & set(w) for w in good):
        return _SURE, False
    return _LIKELY if good else 0, False


class _Element:
    __slots__ = ("tag", "parent", "evidence", "dropped", "heading", "within", "owner", "linked")

    def __init__(self, tag, attributes, parent):
        self.tag, self.parent = tag, parent
        inline = tag in _INLINE and parent is not None
        self.owner = parent.owner if inline else self  # the element of the block
        self.linked = inline and (tag == "a" or parent.linked)
        values, hidden = [], False
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), html.unescape(a or b or c).lower()
            if key in ("class", "id", "role"):
                values.append((key, value))
            elif key == "style":
                hidden |= "display:none" in value.replace(" ", "")
            elif key == "hidden":
                hidden = True
            elif key == "aria-hidden":
                hidden |= value == "true"
        self.dropped = parent is not None and parent.dropped or tag in _DROPPED or hidden
        self.heading = parent is not None and parent.heading or bool(re.fullmatch("h[1-6]", tag))
        self.evidence = around = parent.evidence if parent is not None else 0
        self.within = parent is not None and parent.within
        if tag in ("html", "body"):
            return
        named, owned = _named(tag, values) if values else (0, False)
        if tag in _BAD_TAGS:
            # the header of an article holds its headings; its other lines are no text of it
            self.evidence = _LINE if tag == "header" and around > 0 else -_SURE
        elif named == _LINE:
            self.evidence = _LINE if around > 0 or owned and around > _NAMED else min(around, _NAMED)
        elif named == _NAMED:
            self.evidence = min(around, _NAMED)
        elif named == _HINT:
            self.evidence = min(around, _HINT)
        elif tag in _GOOD_TAGS or named == _SURE:
            self.evidence, self.within = _SURE, True
        elif named == _LIKELY and around in (0, _HINT):
            # a content container undoes a hint around it
            self.evidence = _SURE if self.within else _LIKELY


class _Open:
    """The open elements, and the places of those of each tag, so that none has to be searched for."""

    def __init__(self):
        self.path, self.places = [_Element("", "", None)], {}

    def push(self, element):
        self.places.setdefault(element.tag, []).append(len(self.path))
        self.path.append(element)

    def pop(self):
        element = self.path.pop()
        self.places[element.tag].pop()
        return element

    def last(self, tags):
        """The place of the innermost open element of these tags, 0 for none."""
        return max((x[-1] for t in tags if (x := self.places.get(t))), default=0)


def blocks(page):
    """(text, parent, evidence, heading, linked) of each block of text in page order.

    A block is the text between two block-level tags; line breaks inside it are
    white space, and elements inside a line whose content is no text of the page
    leave it whole. linked is the number of its characters inside links. The
    work is linear in the page, whatever is left open in it.
    """
    out, pieces, linked = [], [], 0
    open_ = _Open()
    here = open_.path[0]

    def close():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append((text, here.owner, here.evidence, here.heading, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def leave(place):
        nonlocal here
        while len(open_.path) > place:
            if not here.dropped and here.tag not in _FLOW:
                close()
            open_.pop()
            here = open_.path[-1]

    def end_of(tags, stops):
        place = open_.last(tags)
        if place > open_.last(stops):
            leave(place)
            return True
        return False

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        text = page[at:token.start() if token else end]
        if text and not here.dropped:
            pieces.append(text)
            if here.linked:
                linked += len(text)
        if token is None:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            done = end_of((tag,), _LISTS if tag in _ENDS and tag != "p" else ())
            if tag == "p" and not done and not here.dropped:
                close()
            continue
        if tag in _VOID:
            if tag == "br":
                if not here.dropped:
                    pieces.append(" ")
            elif tag not in _INLINE and tag != "input" and not here.dropped:
                close()
            continue
        if tag in _ENDS:
            end_of(_ENDED[tag], _SCOPES)
        if tag in _CLOSES_P:
            end_of(("p",), ("table", "button"))
        if tag not in _FLOW and not here.dropped:
            close()
        if tag in ("svg", "path") and token[3].endswith("/"):
            continue
        made = _Element(tag, token[3], here)
        if tag in _RAW:
            stop = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        open_.push(made)
        here = made
    close()
    return out


def costs(found):
    """For each block how much more it costs to call it boilerplate than to call it content; may be negative.

    What an element says by itself (article, nav) is decisive. A bad name has a
    finite cost, and one bad word among others only adds to what the text says.
    """
    inside = any(evidence >= _SURE for _, _, evidence, _, _ in found)
    out = []
    for text, owner, evidence, heading, linked in found:
        words = text.count(" ") + 1
        if abs(evidence) >= _SURE or evidence == _NAMED:
            cost = evidence
        elif evidence == _LINE:
            cost = _LIKELY if heading else -_LIKELY
        else:
            # without any sign of boilerplate a block is content, however short
            cost = evidence + 1 + min(words, 60) // 3 + 3 * (text[-1] in ".!?…") + 4 * heading
            cost -= 16 * (2 * linked > len(text))
            cost += _LIKELY if owner.within else -30 * inside  # inside, or outside the article that the page names
        out.append(cost)
    return out


def edges(found):
    """(i, j, capacity) between blocks that follow each other, closer for one parent, and between siblings further apart.

    A block is tied to the last one before it of the same parent, and to the
    last one there of its own kind (tag and evidence), wherever it stands. So
    there are three edges a block at most.
    """
    out, last = [], {}
    for i, (_, owner, evidence, _, _) in enumerate(found):
        parent = id(owner.parent)
        kin = set()
        for key in (parent, (parent, owner.tag, evidence)):
            kin.add(last.get(key, i))
            last[key] = i
        out += [(j, i, _KIN) for j in sorted(kin) if j < i - 1]
        if i:
            before = found[i - 1][1]
            near = owner is before or owner.parent is before.parent
            out.append((i - 1, i, _NEXT + _SIBLING * near))
    return out


def cut(cost, links):
    """True for each block on the content side of the minimum cut.

    Costs are capacities to the terminals, links capacities between blocks. A
    block whose cost outweighs all its links lies on that side of every minimum
    cut: it is fixed first and its links become costs of its neighbours, which
    leaves few blocks, if any, to the augmenting paths. Blocks that may lie on
    either side count as boilerplate.
    """
    n = len(cost)
    around = [[] for _ in range(n)]
    for i, j, c in links:
        around[i].append((j, c))
        around[j].append((i, c))
    cost, side = list(cost), [None] * n
    weight = [sum(c for _, c in x) for x in around]
    ready = [i for i in range(n) if abs(cost[i]) > weight[i]]
    while ready:
        i = ready.pop()
        if side[i] is not None:
            continue
        side[i] = cost[i] > 0
        for j, c in around[i]:
            if side[j] is None:
                cost[j] += c if side[i] else -c
                weight[j] -= c
                if abs(cost[j]) > weight[j]:
                    ready.append(j)
    open_ = [i for i in range(n) if side[i] is None]
    if open_:
        held = _source_side(open_, cost, [(i, j, c) for i, j, c in links if side[i] is None and side[j] is None])
        for i in open_:
            side[i] = i in held
    return side


def _source_side(nodes, cost, links):
    """Nodes that the source still reaches once no augmenting path is left.

    Paths of one length are saturated together (blocking flows over the levels
    of a breadth-first search), each arc looked at once a level graph.
    """
    place = {x: k for k, x in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    arcs, to, rest = [[] for _ in range(len(nodes) + 2)], [], []

    def join(a, b, there, back):
        for x, y, c in ((a, b, there), (b, a, back)):
            arcs[x].append(len(to))
            to.append(y)
            rest.append(c)

    for k, i in enumerate(nodes):
        if cost[i]:
            join(*((source, k) if cost[i] > 0 else (k, sink)), abs(cost[i]), 0)
    for i, j, c in links:
        join(place[i], place[j], c, c)
    while True:
        level, queue = [-1] * len(arcs), [source]
        level[source] = 0
        for x in queue:
            for e in arcs[x]:
                if rest[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return {nodes[x] for x in queue if x < len(nodes)}
        turn, path, x = [0] * len(arcs), [], source
        while True:
            if x == sink:
                flow = min(rest[e] for e in path)
                for e in path:
                    rest[e] -= flow
                    rest[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if not rest[e])
                x = to[path[first] ^ 1]
                del path[first:]
            while turn[x] < len(arcs[x]):
                e = arcs[x][turn[x]]
                if rest[e] > 0 and level[to[e]] == level[x] + 1:
                    break
                turn[x] += 1
            if turn[x] < len(arcs[x]):
                path.append(e)
                x = to[e]
            elif path:
                x = to[path.pop() ^ 1]
                turn[x] += 1
            else:
                break


def main_text(page):
    """The content blocks of a page, one to a line."""
    found = blocks(page or "")
    if not found:
        return ""
    side = cut(costs(found), edges(found))
    return "\n".join(block[0] for block, content in zip(found, side, strict=True) if content)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
