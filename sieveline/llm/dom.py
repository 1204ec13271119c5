"""A lenient HTML reader: block elements as nodes in page order, with their direct text."""

from __future__ import annotations

import re
from html import unescape

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements whose content is no text of the page.
RAW = frozenset("script style template noscript iframe svg object select textarea button math canvas audio video".split())
#: Those of them that reach to the page's end where their end tag is missing; the others end with their parent.
_TO_THE_END = frozenset("script style textarea".split())
#: Those that a start tag may close at once, and those that a second one of their kind ends.
_MAY_BE_EMPTY, _NOT_NESTED = frozenset(("svg", "math")), frozenset(("button", "select"))
#: Elements that have no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that separate blocks of text; all others run along inside a block.
BLOCK = (
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption form fieldset "
    "legend nav header footer aside blockquote pre figure figcaption address details summary center dialog menu search hgroup"
).split()
TAGS = {tag: i for i, tag in enumerate(BLOCK)}
_CLOSES_P = frozenset(BLOCK) - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: What a start tag closes among its open siblings, and the elements that keep it from looking further up.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


class Page:
    """Nodes in page order: tag, parent, end (first node behind the subtree), depth, attribute words, direct
    pieces of text, and how many of their characters are inside links."""

    __slots__ = ("tag", "parent", "end", "depth", "words", "link_chars", "chars", "pieces")

    def __init__(self, html: str):
        self.tag, self.parent, self.end, self.depth = [TAGS["html"]], [-1], [0], [0]
        self.words: list[frozenset[str]] = [frozenset()]
        self.link_chars, self.chars = [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # node, run of its block, text
        self._read(html)

    def _read(self, html: str) -> None:
        names, nodes = ["html"], [0]  # open block elements
        at = links = run = 0
        size = len(html)
        head = False
        skipped: list[str] = []  # an element without text of the page, and what is open inside it
        inline: dict[str, int] = {}  # other open elements, outside it

        def close(down_to: int) -> None:
            while len(nodes) > down_to:
                self.end[nodes.pop()] = len(self.tag)
                names.pop()

        def text(a: int, b: int) -> None:
            if b > a and not head and not skipped:
                piece = unescape(html[a:b]) if "&" in html[a:b] else html[a:b]
                n = len(piece) - piece.count(" ") if not piece.isspace() else 0
                node = nodes[-1]
                self.pieces.append((node, run, piece))
                self.chars[node] += n
                if links:
                    self.link_chars[node] += n

        while at < size:
            match = _TOKEN.search(html, at)
            if match is None:
                text(at, size)
                break
            text(at, match.start())
            at = match.end()
            name = match[2]
            if name is None:
                continue
            name = name.lower()
            if skipped:
                if match[1]:
                    if name in skipped:
                        del skipped[len(skipped) - 1 - skipped[::-1].index(name) :]
                        continue
                    if name not in names and name not in ("head", "body") and not inline.get(name):
                        continue
                    skipped = []  # the end of a parent
                elif name == "body":
                    skipped = []
                elif name in _TO_THE_END:
                    end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
                    at = end.end() if end else size
                    continue
                else:
                    empty = name in VOID or match[3].rstrip().endswith("/")
                    if not empty and not (name in _NOT_NESTED and name in skipped):
                        skipped.append(name)
                    continue
            if match[1]:
                if inline.get(name):
                    inline[name] -= 1
                if name == "head":
                    head = False
                elif name == "a":
                    links = 0
                elif name in TAGS and name not in ("html", "body") and name in names:
                    close(len(names) - 1 - names[::-1].index(name))
                    run += 1
                continue
            if name in RAW and name not in _TO_THE_END:
                if not (name in _MAY_BE_EMPTY and match[3].rstrip().endswith("/")):
                    skipped = [name]
                continue
            if name in _TO_THE_END or name == "title":
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
                continue
            if name not in TAGS and name not in VOID:
                inline[name] = inline.get(name, 0) + 1
            if name == "head":
                head = True
            elif name == "a":
                links = 1
            elif name == "br":
                if not head:
                    self.pieces.append((nodes[-1], run, " "))
            elif name in TAGS:
                head, run = False, run + 1
                if name == "html" or (name == "body" and "body" in names):
                    continue
                if name in _CLOSES_P and "p" in names:
                    close(len(names) - 1 - names[::-1].index("p"))
                if name in _CLOSES:
                    ends, stops = _CLOSES[name]
                    for k in range(len(names) - 1, 0, -1):
                        if names[k] in stops:
                            break
                        if names[k] in ends:
                            close(k)
                            break
                links = 0
                self.parent.append(nodes[-1])
                self.depth.append(len(nodes))
                self.tag.append(TAGS[name])
                self.end.append(0)
                self.chars.append(0)
                self.link_chars.append(0)
                self.words.append(self._attribute_words(match[3]) if "=" in match[3] else frozenset())
                names.append(name)
                nodes.append(len(self.tag) - 1)
        close(0)

    @staticmethod
    def _attribute_words(attributes: str) -> frozenset[str]:
        found: set[str] = set()
        for _, a, b, c in _ATTRIBUTE.findall(attributes):
            found.update(_WORD.findall(_CAMEL.sub(" ", a or b or c).lower()))
        return frozenset(found)

    def text(self, keep: list[bool]) -> str:
        """The blocks of the nodes to keep: white space as one space, blocks apart by an empty line."""
        blocks: list[str] = []
        key, parts = None, []
        for node, run, piece in self.pieces:
            if not keep[node]:
                continue
            if (node, run) != key and parts:
                blocks.append(" ".join("".join(parts).split()))
                parts = []
            key = (node, run)
            parts.append(piece)
        blocks.append(" ".join("".join(parts).split()))
        return "\n\n".join(b for b in blocks if b)
