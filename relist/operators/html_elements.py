"""Element lookup inside one HTML page, used by the Arrow UDF of extract_html.

List pages are not well-formed XML, so the XML functions of Spark SQL refuse them. This
helper scans tags once and answers class/id/tag paths with descendant and child steps.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from html import unescape

# Fixed values of HTML itself.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW_TEXT = set("script style textarea title".split())
INLINE = set("a abbr b bdi bdo cite code data dfn em font i img input kbd label mark q s samp select small span "
             "strike strong sub sup textarea time tt u var wbr".split())
ENDS_WITH_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                     "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH = {"p"}
CLOSES_PARAGRAPH = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                       "nav ol p pre section table ul".split())

ATTRIBUTES = r"[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?[^>=]*+)*+"
# The start tag of a raw text element goes up to its closing tag, as tags inside are none.
RAW = "|".join(rf"{''.join(f'[{c}{c.upper()}]' for c in t)}(?=[\s/>]){ATTRIBUTES}>(?:.*?(?=</(?i:{t})[\s/>])|.*)" for t in sorted(RAW_TEXT))
FIRST = "".join(sorted({t[0] + t[0].upper() for t in RAW_TEXT}))
# All begin with <, so that the search passes over texts.
TOKEN = re.compile(rf"(<(?:/[a-zA-Z][^\s/>]*+>|(?=[{FIRST}])(?:{RAW})|/?[a-zA-Z][^\s/>]*+{ATTRIBUTES}>|!--.*?(?:-->|\Z)|[!?/][^>]*+>))", re.S)
TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>", re.S)
NAMED = re.compile("class|id", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
SIMPLE = re.compile(r"[#.]?[\w-]+")
BLANKS = " \t\n\f\r"
#: A numeric reference, without its leading zeros; eight digits are more than any character has.
NUMBER, DIGITS = re.compile(r"&#0*([0-9]+)"), 8
SPACES, UNEVEN = re.compile(r"[ \t\n\f\r]+"), re.compile(r"[\t\n\f\r]|  ")


def decoded(text: str) -> str:
    """The text with its character references replaced; numbers beyond all characters are U+FFFD, as in the HTML standard."""
    if "&" not in text:
        return text
    try:
        return unescape(text)
    except ValueError:  # a number of more digits than Python reads
        return unescape(NUMBER.sub(lambda m: "&#" + m[1][:DIGITS], text))


def describe(tag: str, attributes: str) -> tuple[dict[str, str], frozenset[str]]:
    """Attributes of a start tag (the first of a repeated one counts), and the names paths
    find it by: its tag, '#id' and '.class'."""
    attrs: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(attributes):
        value = double or single or bare
        attrs.setdefault(name.lower(), decoded(value))
    return attrs, names_of(tag, attrs.get("class", ""), attrs.get("id"))


#: So many tags are remembered from page to page, none of them longer than this.
REMEMBERED, LONGEST = 10_000, 200
NAMES: dict[tuple, frozenset[str]] = {}


def names_of(tag: str, classes: str, ident: str | None) -> frozenset[str]:
    key = (tag, classes, ident)
    found = NAMES.get(key)
    if found is None:
        if len(NAMES) > REMEMBERED:
            NAMES.clear()
        names = {tag, *("." + c for c in classes.split())}
        found = NAMES[key] = frozenset(names if ident is None else names | {"#" + ident})
    return found


class Tag:
    """What a token means, whatever page it stands on; name None is a comment or a declaration."""

    __slots__ = ("name", "closing", "attributes", "length", "names", "ends", "open", "raw", "inline")

    def __init__(self, token: str):
        found = TAG.match(token)
        self.name = self.attributes = None
        if found is None:
            return
        closing, name, self.attributes = found.groups()
        self.name, self.closing, self.length = name.lower(), bool(closing), found.end()
        self.ends = ENDS_WITH_SIBLING.get(self.name) or (PARAGRAPH if self.name in CLOSES_PARAGRAPH else None)
        self.open, self.raw, self.inline = self.name not in VOID, self.name in RAW_TEXT, self.name in INLINE
        # Most tags have neither class nor id; their attributes are taken apart when one is asked for.
        named = not closing and NAMED.search(self.attributes)
        self.names = describe(self.name, self.attributes)[1] if named else names_of(self.name, "", None)

    def attrs(self) -> dict[str, str]:
        return describe(self.name, self.attributes)[0]

    def attribute(self, wanted: str) -> str:
        """An attribute, '' if it is absent; the first of a repeated one counts."""
        for found in ATTRIBUTE.finditer(self.attributes):
            name, double, single, bare = found.groups("")
            if name.lower() == wanted:
                value = double or single or bare
                return decoded(value)
        return ""


class Page:
    """Elements in document order, so that a subtree is the run [i, last[i]].

    The page is kept as pieces, texts and tags in turn; an element is the run [start, end) of them. `seen` keeps
    understood tags from page to page, as listings repeat them.
    """

    def __init__(self, html: str | list[str], seen: dict[str, Tag] | None = None):
        # A list is a run of pieces that begins with a tag.
        self.pieces = TOKEN.split(html) if isinstance(html, str) else ["", *html]
        n = len(self.pieces) // 2
        self.tags, self.parent, self.start, self.end, self.last = [None] * n, [-1] * n, [0] * n, [0] * n, list(range(n))
        self.holders: dict[str, list[int]] = {}
        n = self._scan({} if seen is None else seen)
        del self.tags[n:], self.parent[n:]

    def _scan(self, seen: dict[str, Tag]) -> int:
        """Build the elements; the open ones are the innermost (`top`), its parent, and so on. Returns their number."""
        pieces, tags, parent, start, end, last = self.pieces, self.tags, self.parent, self.start, self.end, self.last
        if len(seen) > REMEMBERED:
            seen.clear()
        top, n, at = -1, 0, -1
        for token in pieces[1::2]:
            at += 2
            tag = seen.get(token)
            if tag is None:
                tag = Tag(token)
                if len(token) <= LONGEST:
                    seen[token] = tag
            name = tag.name
            if name is None:
                continue
            if tag.closing:
                i = top
                while i >= 0 and tags[i].name != name:
                    i = parent[i]
                if i >= 0:
                    while top != i:
                        end[top], last[top], top = at, n - 1, parent[top]
                    end[i], last[i], top = at + 1, n - 1, parent[i]
                continue
            if tag.ends:
                while True:
                    i = top
                    while i >= 0 and tags[i].inline:
                        i = parent[i]
                    if i < 0 or tags[i].name not in tag.ends:
                        break
                    i = parent[i]
                    while top != i:
                        end[top], last[top], top = at, n - 1, parent[top]
            tags[n], parent[n], start[n] = tag, top, at
            if tag.open:
                top = n
            else:
                end[n] = at + 1
            n += 1
        while top >= 0:
            end[top], last[top], top = len(pieces), n - 1, parent[top]
        return n

    def _holding(self, name: str) -> list[int]:
        if name not in self.holders:
            self.holders[name] = [i for i, tag in enumerate(self.tags) if name in tag.names]
        return self.holders[name]

    def select(self, path: list, root: int | None = None) -> list[int]:
        """Elements of the subtree of `root` (of the page if None) that match a path."""
        candidates = self._holding(path[-1][1])
        if root is not None:
            candidates = candidates[bisect_left(candidates, root):bisect_right(candidates, self.last[root])]
        return [i for i in candidates if self._matches(i, path, len(path) - 1, root)]

    def _matches(self, i: int, path: list, step: int, root: int | None) -> bool:
        child, _, needed = path[step]
        if not needed <= self.tags[i].names:
            return False
        if step == 0:
            return True
        while i != root and (i := self.parent[i]) >= 0:
            if self._matches(i, path, step - 1, root):
                return True
            if child:
                return False
        return False

    def text(self, i: int) -> str:
        """Text of the subtree, blanks collapsed, blocks and line breaks set apart."""
        start, last, pieces, tags = self.start[i], self.last[i], self.pieces, self.tags
        parts = pieces[start + 1:self.end[i]:2]
        if last > i or tags[i].raw:
            parts = [(at, 1, x) for at, x in zip(range(start + 1, self.end[i], 2), parts)]
            for j in range(i, last + 1):
                if j > i and not tags[j].inline:
                    parts += [(self.start[j], 0, " "), (self.end[j], 0, " ")]
                if tags[j].name in ("textarea", "title"):
                    parts.append((self.start[j], 1, pieces[self.start[j]][tags[j].length:]))
            parts = [p[2] for p in sorted(parts)]
        return SPACES.sub(" ", "".join([decoded(x) if "&" in x else x for x in parts])).strip(" ")

    def read(self, i: int, what: str) -> str:
        if what == "text":
            return self.text(i)
        if what == "outer":
            return "".join(self.pieces[self.start[i]:self.end[i]])
        return self.tags[i].attribute(what[1:])


def compile_path(css: str) -> list:
    """'#jobs div.job > a' as steps of (is child step, the name to look up by, all names)."""
    steps, child = [], False
    for word in css.replace(">", " > ").split():
        if word == ">":
            child = True
            continue
        names = SIMPLE.findall(word)
        steps.append((child, max(names, key=lambda n: n[0] in "#."), frozenset(names)))
        child = False
    return steps


class Finder:
    """Elements matching `root` and, inside each, those matching paths of its own: all found in one pass.

    A step of a path is a bit. What an element matches follows from its names and from what its parent and all elements
    above have matched, so each such pair is worked out once and remembered.
    """

    def __init__(self, root: str, paths: Sequence[str | None]):
        self.root, self.paths = compile_path(root), [compile_path(p) if p else None for p in paths]
        self.steps, self.ends, self.first, self.child = [], [], 0, 0
        for path in (self.root, *self.paths):
            for k, (child, _, needed) in enumerate(path or ()):
                bit = 1 << len(self.steps)
                self.first |= bit if k == 0 else 0
                self.child |= bit if child else 0
                self.steps.append(needed)
            self.ends.append(1 << (len(self.steps) - 1) if path else 0)
        self.outer = (1 << len(self.root)) - 1
        self.moves: dict = {}

    def _move(self, above: tuple[int, int, bool], names: frozenset[str]) -> tuple:
        """(what the element and those above it have matched, whether it is a root, its fields, whether roots nest)."""
        seen, parent, inside = above
        reached = self.first | (self.child & (parent << 1)) | (~self.child & (seen << 1))
        own = reached & sum(1 << b for b, needed in enumerate(self.steps) if needed <= names)
        is_root = bool(own & self.ends[0])
        if is_root:
            # A path inside a root begins there.
            seen &= self.outer
            reached = self.first
            own = (own & self.outer) | (reached & ~self.outer & sum(1 << b for b, needed in enumerate(self.steps) if needed <= names))
        elif not inside:
            own &= self.outer
        fields = tuple(f for f, end in enumerate(self.ends[1:]) if own & end)
        return (seen | own, own, inside or is_root), is_root, fields, inside and is_root

    def find(self, page: Page) -> list[tuple[int, list[list[int]]]]:
        """(root, the elements of each path) in page order; a path that is None has the root itself."""
        if len(self.moves) > REMEMBERED:
            self.moves.clear()
        moves, states, found, of_root = self.moves, [], [], None
        for i, (tag, above) in enumerate(zip(page.tags, page.parent)):
            key = (states[above] if above >= 0 else (0, 0, False), tag.names)
            move = moves.get(key)
            if move is None:
                move = moves[key] = self._move(*key)
            state, is_root, fields, nested = move
            states.append(state)
            if nested:
                return [(r, [[r] if p is None else page.select(p, r) for p in self.paths]) for r in page.select(self.root)]
            if is_root:
                of_root = [[i] if p is None else [] for p in self.paths]
                found.append((i, of_root))
            for f in fields:
                of_root[f].append(i)
        return found


class State(dict):
    """What is open at a place of a page, as far as the tags behind it need to know, and what each tag does there.

    A tag that opens an element nobody wants is the state inside it.
    """

    __slots__ = ("above", "name", "block", "is_root", "fields", "marked", "kinds")

    def __init__(self, above: tuple[int, int, bool], name: str | None, block: str | None, is_root: bool, fields: tuple[int, ...]):
        # The innermost open element, and the innermost that is not inline.
        self.above, self.name, self.block, self.is_root, self.fields = above, name, block, is_root, fields
        self.marked = is_root or bool(fields)
        self.kinds: dict[tuple, State | None] = {}


class Element:
    """A wanted element: its tag and the pieces [start, end) of the page, as in Page."""

    __slots__ = ("tag", "start", "end")

    def __init__(self, tag: Tag, start: int):
        self.tag, self.start, self.end = tag, start, start + 1

    def read(self, pieces: list[str], what: str, seen: dict[str, Tag]) -> str:
        if what == "outer":
            return "".join(pieces[self.start:self.end])
        if what != "text":
            return self.tag.attribute(what[1:])
        parts = None if self.tag.raw else self._texts(pieces, seen)
        if parts is None:
            # The elements inside are those of the page, as nothing outside ends them before this one ends.
            return Page(pieces[self.start:self.end], seen).text(0)
        text = "".join([decoded(x) if "&" in x else x for x in parts]).strip(BLANKS)
        return SPACES.sub(" ", text) if UNEVEN.search(text) else text

    def _texts(self, pieces: list[str], seen: dict[str, Tag]) -> list[str] | None:
        """The texts inside, set apart as in Page.text; None if it takes more than to follow tags that open and close in turn."""
        start, end = self.start + 1, self.end
        if end <= start + 2:
            return pieces[start:end:2]
        parts, inside = [pieces[start]], []
        for at in range(start + 1, end - 1, 2):
            tag = seen.get(pieces[at])
            if tag is None:
                return None
            if tag.name is not None:
                if tag.closing:
                    if not inside or inside.pop() != tag.name:
                        return None
                elif tag.raw or (tag.ends and not tag.ends.isdisjoint(inside)):
                    return None
                elif tag.open:
                    inside.append(tag.name)
                if not tag.inline:
                    parts.append(" ")
            parts.append(pieces[at + 1])
        return parts


# What else a tag does: nothing; close the innermost element, an unwanted one or a wanted one; close one further out; open a wanted
# element; stand for an element without content; end elements before it opens.
SKIP, CLOSE, CLOSE_MARKED, CLOSE_OUTER, OPEN_MARKED, ALONE, ENDS = range(7)


class Walker:
    """The elements of fields inside each element matching `root`, in one pass over the tags of a page.

    Each tag is one step from state to state, worked out once and remembered. Nothing is built of a page but the elements that are
    wanted.
    """

    def __init__(self, root: str, paths: Sequence[str | None]):
        self.finder = Finder(root, paths)
        self.whole = [f for f, path in enumerate(paths) if path is None]
        self.seen: dict[str, Tag] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: dict[tuple, State] = {}
        self.begin, self.known = State((0, 0, False), None, None, False, ()), 0
        self.seen.clear()

    def _state(self, state: State, tag: Tag) -> State | None:
        """The state inside an element opened in `state`; None for a root inside a root."""
        kind = (tag.name, tag.names)
        if kind not in state.kinds:
            above, is_root, fields, nested = self.finder._move(state.above, tag.names)
            key = (above, tag.name, state.block if tag.inline else tag.name)
            if not nested and key not in self.states:
                self.states[key] = State(*key, is_root, fields)
            state.kinds[kind] = None if nested else self.states[key]
            self.known += 1
        return state.kinds[kind]

    def _step(self, state: State, tag: Tag) -> State | tuple[int, Tag, State | None]:
        """The state inside an element nobody wants, or what the tag does and the state of the element it stands for."""
        if tag.name is None:
            return SKIP, tag, None
        if tag.closing:
            return (CLOSE_OUTER if tag.name != state.name else CLOSE_MARKED if state.marked else CLOSE), tag, None
        if tag.ends and state.block in tag.ends:
            return ENDS, tag, None
        then = self._state(state, tag)
        if not tag.open:
            return (ALONE if then is None or then.marked else SKIP), tag, then
        return then if then is not None and not then.marked else (OPEN_MARKED, tag, then)

    def _learn(self, state: State, token: str) -> State | tuple[int, Tag, State | None]:
        tag = self.seen.get(token)
        if tag is None:
            tag = Tag(token)
        step = self._step(state, tag)
        if len(token) <= LONGEST:
            self.seen[token], state[token] = tag, step
            self.known += 1
        return step

    def find(self, pieces: list[str]) -> list[list[list[Element]]] | None:
        """For each root in page order the elements of each path; None if roots are nested."""
        if self.known > REMEMBERED:
            self._forget()
        state, stack, marks, found = self.begin, [], [], []
        for k, token in enumerate(pieces[1::2]):
            step = state.get(token)
            if step is None:
                step = self._learn(state, token)
            if type(step) is State:
                stack.append(state)
                state = step
                continue
            does, tag, then = step
            if does == CLOSE:
                state = stack.pop()
                continue
            if does == SKIP:
                continue
            at = 2 * k + 1
            if does == ENDS:
                while state.block in tag.ends:
                    state = self._close(state, stack, marks, at, state.block, at)
                step = self._step(state, tag)
                does, tag, then = (OPEN_MARKED, tag, step) if type(step) is State else step
            if does == CLOSE_MARKED:
                marks.pop().end = at + 1
                state = stack.pop()
            elif does == CLOSE_OUTER:
                if any(s.name == tag.name for s in stack):
                    state = self._close(state, stack, marks, at, tag.name, at + 1)
            elif then is None:
                return None
            else:
                if then.marked:
                    element = Element(tag, at)
                    if then.is_root:
                        found.append([[] for _ in self.finder.paths])
                        for f in self.whole:
                            found[-1][f].append(element)
                    for f in then.fields:
                        found[-1][f].append(element)
                    if does == OPEN_MARKED:
                        marks.append(element)
                if does == OPEN_MARKED:
                    stack.append(state)
                    state = then
        for element in marks:
            element.end = len(pieces)
        return found

    @staticmethod
    def _close(state: State, stack: list[State], marks: list[Element], at: int, name: str, behind: int) -> State:
        """Close the innermost element of a name, which ends `behind`, and all inside it, which end `at` the tag."""
        while True:
            last = state.name == name
            if state.marked:
                marks.pop().end = behind if last else at
            state = stack.pop()
            if last:
                return state
