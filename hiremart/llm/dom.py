"""A small forgiving HTML reader: block elements as a tree, text in page order."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript title textarea iframe noframes noembed xmp svg math object".split())
#: A start tag of the key ends open elements of the value, up to the nearest element of ``SCOPE``.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPE = frozenset("html body table ul ol dl menu select div section article main aside nav header footer form blockquote".split())

TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAMES = frozenset(("class", "id", "role", "itemprop", "hidden", "aria-label"))


class Node:
    """A block element; ``text`` and ``link`` count the characters directly below it (inline elements included)."""

    __slots__ = ("tag", "parent", "children", "names", "text", "link", "controls", "number")

    def __init__(self, tag: str, parent: int, names: tuple[str, ...], number: int):
        self.tag, self.parent, self.names, self.number = tag, parent, names, number
        self.children: list[int] = []
        self.text = self.link = self.controls = 0


class Page:
    """``nodes`` in page order (parents first; node 0 is the root) and ``runs``: (node, text) in page order."""

    def __init__(self, source: str | None):
        self.nodes: list[Node] = [Node("#root", -1, (), 0)]
        self.runs: list[tuple[int, str]] = []
        if source:
            self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements; inline ones carry the block they are in
        opened: Counter[str] = Counter()
        pending: list[str] = []
        at, end, last_close = 0, len(source), source.rfind(">")
        unclosed: set[str] = set()  # skipped tags without an end further on

        def flush() -> None:
            raw = entities.unescape("".join(pending))
            pending.clear()
            if not raw or opened["head"]:
                return
            node = stack[-1][1]
            size = len(" ".join(raw.split()))
            self.nodes[node].text += size
            self.nodes[node].link += size if opened["a"] else 0
            self.runs.append((node, raw))

        def close(down_to: int) -> None:
            for tag, _ in stack[down_to:]:
                opened[tag] -= 1
            del stack[down_to:]

        while at < end:
            less = source.find("<", at)
            if less < 0 or less > last_close:
                pending.append(source[at:])
                break
            pending.append(source[at:less])
            if source.startswith(("<!", "<?"), less):
                mark = "-->" if source.startswith("<!--", less) else ">"
                done = source.find(mark, less + 2)
                at = end if done < 0 else done + len(mark)
                continue
            match = TAG.match(source, less) or PLAIN_TAG.match(source, less)
            if match is None:
                pending.append("<")
                at = less + 1
                continue
            at = match.end()
            tag = match[1].lower()
            if source[less + 1] == "/":
                flush()
                if opened[tag]:
                    place = len(stack) - 1
                    block = stack[-1][1]
                    while stack[place][0] != tag:
                        place -= 1
                    if tag not in INLINE:
                        close(place)
                    elif stack[place][1] == block:  # an inline end tag closes nothing outside its block
                        opened[tag] -= 1
                        del stack[place]
            elif tag in SKIPPED:
                self.nodes[stack[-1][1]].controls += tag == "textarea"
                if not match[0].endswith("/>") and tag not in unclosed:
                    done = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                    if done is not None:
                        at = source.find(">", done.start()) + 1 or end
                    elif tag in ("script", "style"):
                        at = end
                    else:
                        unclosed.add(tag)
            elif tag in INLINE:
                if tag == "br":
                    pending.append(" ")
                elif tag not in VOID:
                    flush()
                    stack.append((tag, stack[-1][1]))
                    opened[tag] += 1
            else:
                flush()
                self.nodes[stack[-1][1]].controls += tag in ("input", "button", "select")
                self._end_implied(stack, opened, close, tag)
                number, parent = len(self.nodes), stack[-1][1]
                self.nodes.append(Node(tag, parent, self._names(match[2]), number))
                self.nodes[parent].children.append(number)
                self.runs.append((number, ""))  # a block starts even where it has no text
                if tag not in VOID and not match[2].endswith("/"):
                    stack.append((tag, number))
                    opened[tag] += 1
        flush()

    @staticmethod
    def _end_implied(stack: list[tuple[str, int]], opened: Counter, close, tag: str) -> None:
        if opened["p"]:  # a block element ends an open paragraph, over which only inline elements stand
            place = len(stack) - 1
            while stack[place][0] in INLINE:
                place -= 1
            if stack[place][0] == "p":
                close(place)
        wanted = ENDS.get(tag, ())
        if any(opened[t] for t in wanted):
            place = len(stack) - 1
            while place and stack[place][0] not in SCOPE and stack[place][0] not in wanted:
                place -= 1
            if stack[place][0] in wanted:
                close(place)

    @staticmethod
    def _names(attributes: str) -> tuple[str, ...]:
        found: list[str] = []
        if "=" in attributes:
            for name, *values in ATTRIBUTE.findall(attributes):
                if name.lower() in NAMES:
                    found += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower())
        return tuple(found)

    def blocks(self, kept) -> str:
        """Text of the nodes that ``kept`` holds: white space as one blank, blocks joined by line ends."""
        out: list[str] = []
        last = -1
        part: list[str] = []
        for node, text in [*self.runs, (-1, "")]:
            if node != last:
                if part and kept[last] and (joined := " ".join("".join(part).split())):
                    out.append(joined)
                part, last = [], node
            part.append(text)
        return "\n".join(out)
