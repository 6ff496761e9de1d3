"""HTML pages as a stream of tags with a stack: elements that selectors name, with their text and address."""

import re
from collections import defaultdict
from dataclasses import dataclass

# Elements without content, and elements that a tag of the same kind ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "a": ("a",)}
#: Elements beyond which a tag does not end one of its own kind.
HOLDS = frozenset("ul ol dl select table tbody article section div nav body main aside header footer".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SELECTOR = re.compile(r"""(\*|[A-Za-z][\w-]*)?((?:\.[\w-]+|\[[^\]]*\])*)""")
_PART = re.compile(r"""\.([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]*))\s*)?\]""")


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag, names in lower case; of repeated ones the first."""
    out = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), double or single or bare)
    return out


_TESTS = {
    None: lambda value, want: True, "=": lambda value, want: value == want, "*=": lambda value, want: want != "" and want in value,
    "^=": lambda value, want: want != "" and value.startswith(want), "$=": lambda value, want: want != "" and value.endswith(want),
    "~=": lambda value, want: want in value.split(),
}


@dataclass(frozen=True)
class Selector:
    """One compound selector: a tag, classes, and attributes that are there, equal, contain, begin or end with a value."""

    text: str
    tag: str | None
    classes: tuple[str, ...]
    attributes: tuple[tuple[str, str | None, str], ...]

    @classmethod
    def parse(cls, text: str) -> "Selector":
        found = _SELECTOR.fullmatch(text.strip())
        if not found or not found[0]:
            raise ValueError(f"not a compound selector: {text!r}")
        classes, wanted, rest = [], [], found[2]
        while rest:
            part = _PART.match(rest)
            if not part:
                raise ValueError(f"not a compound selector: {text!r}")
            if part[1]:
                classes.append(part[1])
            else:
                wanted.append((part[2].lower(), part[3], part[4] or part[5] or part[6] or ""))
            rest = rest[part.end():]
        tag = None if found[1] in (None, "*") else found[1].lower()
        return cls(text.strip(), tag, tuple(classes), tuple(wanted))

    def matches(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag is not None and self.tag != tag:
            return False
        if self.classes and not set(self.classes) <= set(attrs.get("class", "").split()):
            return False
        return all(name in attrs and _TESTS[test](attrs[name], value) for name, test, value in self.attributes)


def selectors(text: str) -> list[Selector]:
    """The members of a list of selectors; commas inside brackets belong to values."""
    return [Selector.parse(part) for part in re.split(r""",(?![^\[]*\])""", text)]


@dataclass
class Element:
    """A found element. Texts have a blank for every tag inside, and entities as they are written.

    heading and anchor are the first of its kind with text, inside it or the
    element itself; heading_href is the address around or first in that heading.
    """

    selector: int
    tag: str
    in_nav: bool
    heading: str | None = None
    heading_href: str | None = None
    anchor: str | None = None
    anchor_href: str | None = None


class _Reading:
    """An open heading or anchor, whose text is being read."""

    def __init__(self, start: int, href: str | None, number: int):
        self.start, self.href, self.number = start, href, number


class _Page:
    """The state of one reading."""

    def __init__(self, wanted: list[Selector]):
        self.wanted, self.out, self.texts = wanted, [], []
        #: Open tags, with the element if it was found; the places of each tag, and of those that hold others, in there.
        self.stack, self.places, self.holding, self.navs = [], defaultdict(list), [], 0
        self.heading, self.anchor = None, None
        #: Open found elements that have no heading, no anchor yet, outermost first, each after its number among tags.
        self.without_heading, self.without_anchor, self.number = [], [], 0

    def _text_since(self, reading: _Reading) -> str | None:
        text = " ".join(self.texts[reading.start:])
        return text if text.strip() else None

    def _end(self, reading: _Reading | None, waiting: list) -> tuple[str | None, list[Element]]:
        """Text of a heading or anchor that ends, and the waiting elements opened before it."""
        text = self._text_since(reading) if reading else None
        if text is None:
            return None, []
        inside = len(waiting)
        while inside and waiting[inside - 1][0] > reading.number:
            inside -= 1
        around = [element for _, element in waiting[:inside]]
        del waiting[:inside]
        return text, around

    def end_heading(self) -> None:
        reading, self.heading = self.heading, None
        text, around = self._end(reading, self.without_heading)
        for element in around:
            element.heading, element.heading_href = text, reading.href

    def end_anchor(self) -> None:
        reading, self.anchor = self.anchor, None
        text, around = self._end(reading, self.without_anchor)
        for element in around:
            element.anchor, element.anchor_href = text, reading.href

    def open(self, tag: str, attrs: dict[str, str], empty: bool) -> None:
        hold = self.holding[-1] if self.holding else -1
        ended = [self.places[other][-1] for other in ENDED_BY_NEXT.get(tag, ()) if self.places[other] and self.places[other][-1] > hold]
        if ended:
            self.close_down_to(min(ended))
        if tag == "a" and "href" in attrs:
            self.end_anchor()
            if self.heading and self.heading.href is None:
                self.heading.href = attrs["href"]
        if tag in HEADINGS:
            self.end_heading()
        first = next((i for i, selector in enumerate(self.wanted) if selector.matches(tag, attrs)), None)
        element = None if first is None else Element(first, tag, self.navs > 0 or tag == "nav")
        if element:
            self.out.append(element)
        if empty:
            return
        self.number += 1
        if element:
            self.without_heading.append((self.number, element))
            self.without_anchor.append((self.number, element))
        if tag == "a" and "href" in attrs:
            self.anchor = _Reading(len(self.texts), attrs["href"], self.number)
        if tag in HEADINGS:
            self.heading = _Reading(len(self.texts), self.anchor.href if self.anchor else None, self.number)
        self.places[tag].append(len(self.stack))
        if tag in HOLDS:
            self.holding.append(len(self.stack))
        self.stack.append((tag, element, self.anchor if tag == "a" else self.heading if tag in HEADINGS else None))
        self.navs += tag == "nav"

    def close_down_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag, element, reading = self.stack.pop()
            self.places[tag].pop()
            if tag in HOLDS:
                self.holding.pop()
            self.navs -= tag == "nav"
            if reading is not None and reading is self.anchor:
                self.end_anchor()
            if reading is not None and reading is self.heading:
                self.end_heading()
            for waiting in (self.without_heading, self.without_anchor):
                if element and waiting and waiting[-1][1] is element:
                    waiting.pop()


def elements(html: str, wanted: list[Selector], skip: tuple[str, ...] = ("script", "style")) -> list[Element]:
    """The elements that match one of the selectors (the first counts), in page order.

    Elements in `skip` and comments have no text and no elements; what stands
    between their tags is not read as markup. An end tag ends all elements
    opened since its start tag, and none if there is no such tag; the end of the
    page ends all. A heading ends with the next one, an anchor with the next
    one. So every tag enters and leaves the stack once, every text is part of
    one heading and one anchor at most, and time grows with the page alone.
    """
    page, pos, size = _Page(wanted), 0, len(html)
    while pos < size:
        at = html.find("<", pos)
        token = _TOKEN.match(html, at) if at >= 0 else None
        if token is None:
            end = html.find("<", at + 1) if at >= 0 else -1
            end = size if end < 0 else end
            page.texts.append(html[pos:end])
            pos = end
            continue
        if at > pos:
            page.texts.append(html[pos:at])
        pos = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if page.places[tag]:
                page.close_down_to(page.places[tag][-1])
        elif tag in skip:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, pos)
            pos = end.end() if end else size
        else:
            page.open(tag, attributes(token[3]), tag in VOID or token[3].endswith("/"))
    page.close_down_to(0)
    return page.out
