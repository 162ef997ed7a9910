"""Flat text blocks of an HTML page."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Fixed values of HTML: elements without content, those whose content is no text of the page, those that begin and
# end a block, and those that an element of the same group ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style template noscript iframe svg math textarea select title canvas object video audio".split()
)
#: Those of them that end with what is around them, where they have no end tag or a slash for one; the others go on to
#: the end of the page.
EMBEDDED = frozenset("svg math select canvas object video audio".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section"
    " summary table tbody td tfoot th thead tr ul button label".split()
)
GROUPS = {"li": "li", "dd": "dd dt", "dt": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: What an element says its content is, by its tag or by words of its class, id or role; the first that fits.
KINDS = {
    "hidden": (frozenset(), ""),  # see _unseen
    "comments": (frozenset(), r"\w*comments?\w*|replies|reply|respond|disqus|discussion|guestbook"),
    "advert": (
        frozenset(), r"ad(s|sense|slot|box|unit|block|wrap|wrapper|vert\w*)?|sponsor(ed|s)?|promo(tion|ted)?|banner-?ad",
    ),
    "notice": (
        frozenset(("dialog",)),
        r"cookies?\w*|consent|gdpr|notice\w*|notification|alert|popup|modal|overlay|paywall|disclaimer|banner|newsletter\w*"
        r"|subscribe|subscription|share|sharing|social|toast",
    ),
    "navigation": (frozenset(("nav", "menu")), r"\w*nav(bar|igation)?|\w*menu|breadcrumbs?|pagination|pager|toc|tabs?|skip"),
    "footer": (frozenset(("footer",)), r"\w*footer|copyright|colophon|contentinfo|credits"),
    "sidebar": (
        frozenset(("aside",)),
        r"\w*sidebar|aside|related\w*|recommend(ed|ations)?|widgets?|complementary|trending|popular|more-?stories",
    ),
    "form": (frozenset(("form", "fieldset", "button", "label", "legend", "search")), r"\w*form|search(box|bar)?|login|signup"),
    "header": (frozenset(("header",)), r"\w*header|masthead|topbar|site-?title|logo"),
    "article": (frozenset(("article", "main")), r"article(-?body)?|main(-?content)?|content|post(-?body)?|entry(-?content)?|story"),
}
#: Words that make a class one of the layout, which holds the main text too.
_LAYOUT = re.compile(r"(?:^|[\s_-])(?:wrap|wrapper|layout|container|has|with|no|grid|page|columns?)(?=$|[\s_-])", re.I)
#: Classes that tell what an element is about, has or counts, and not what it is.
_ABOUT = re.compile(r"(?:category|cat|tag|topic|format|status|type|has|no|with)-.*|.*-(?:count|counter|history)(?:-\d+)?|js-.*|tabs?", re.I)
#: What stands around a kind of content and nothing else.
_AROUND = re.compile(r"[_-]+(?:wrap|wrapper|container|holder|outer|inner)$", re.I)

_OPENED = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile(r"--!?>")
_MARK = re.compile(r"[>\"']")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in SILENT}
_ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s/>=\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMING = ("class", "id", "role", "itemprop")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([\w-]+)", re.I)
#: Whole words of a class that hide an element, and those that show it again on wider screens.
_HIDING = re.compile(r"(?:is-)?hidden|visually-?hidden(?:-focusable)?|sr-only(?:-focusable)?|d-none", re.I)
_SHOWING = re.compile(r"(?:\w+:|d-(?:sm|md|lg|xl|xxl)-)(?:block|inline\S*|flex|grid|table\S*|contents|not-sr-only)", re.I)
_BY_WORD = {kind: re.compile(rf"(?:^|[\s_-])(?:{words})(?=$|[\s_-])", re.I) for kind, (_, words) in KINDS.items() if words}
_IS = {kind: re.compile(words, re.I) for kind, (_, words) in KINDS.items() if words and kind != "article"}
_BY_TAG = {tag: kind for kind, (tags, _) in KINDS.items() for tag in tags}


@dataclass
class Block:
    """A run of text between block boundaries: how much of it is links, and the kind of the nearest element around
    it that has one."""

    text: str
    words: int
    link_words: int
    kind: str | None
    heading: bool

    @property
    def link_density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


#: Around these, which may have been left open, an article still counts as one; within the others it does not.
_LEFT_OPEN = (None, "article", "advert", "notice", "header")


def _attributes(said: str) -> dict[str, str]:
    """Values by name in lower case, the first of each name; those without a value have an empty one."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(said):
        if name:
            found.setdefault(name.lower(), a or b or c)
    return found


def _unseen(attributes: dict[str, str]) -> bool:
    """Whether an element says that it is not shown: by its attributes, its style or a whole word of its class."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    if (shown := _DISPLAY.findall(attributes.get("style", ""))) and shown[-1].lower() == "none":
        return True
    words = attributes.get("class", "").split()
    return any(map(_HIDING.fullmatch, words)) and not any(map(_SHOWING.fullmatch, words))


def _kind(tag: str, said: str, around: str | None) -> str | None:
    """The kind of an element's content, or that of what is around it."""
    if tag in ("html", "body"):  # without them there is no page, whatever a script does to them later
        return around
    attributes = _attributes(said) if said else {}
    if attributes and _unseen(attributes):
        return "hidden"
    own = _BY_TAG.get(tag)
    words = [w for n in _NAMING if n in attributes for w in attributes[n].split() if not _ABOUT.fullmatch(w)]
    names = " ".join(words)
    if tag == "main":
        return own
    if own == "article":
        if re.search(r"(?:^|\s)comment", names, re.I):
            return "comments"
        return own if around in _LEFT_OPEN else around
    if own and not (own == "header" and around == "article"):
        return own
    for word in words:
        if (inner := _AROUND.sub("", word)) != word:
            for kind, whole in _IS.items():
                if whole.fullmatch(inner) and not (kind == "header" and around == "article"):
                    return kind
    if names and _LAYOUT.search(names):
        return around
    for kind, words in _BY_WORD.items() if names else ():
        if words.search(names) and not (kind == "header" and around == "article"):
            return around if kind == "article" and around else kind
    return around


class _Tags:
    """Finds the tags of a page, in time in proportion to it however broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")  # no tag ends after this
        self.stuck: set[int] = set()  # places outside quotes from where on no tag ends outside quotes

    def _close(self, at: int) -> int:
        """Where the first ``>`` outside quotes stands, from a place outside quotes; -1 if there is none."""
        seen = []
        while at not in self.stuck:
            seen.append(at)
            if not (m := _MARK.search(self.page, at)):
                break
            if m[0] == ">":
                return m.start()
            if (closing := self.page.find(m[0], m.end())) < 0:
                break
            at = closing + 1
        self.stuck.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Begin and end of the next tag or comment, the tag's name, empty for a comment or a tag that its quotes break,
        whether it is an end tag, and what it says beside its name. None if there are no more."""
        page = self.page
        if not (m := _OPENED.search(page, at)):
            return None
        opened = m[0]
        if opened == "<!--":
            if short := re.compile("-?>").match(page, m.end()):
                return m.start(), short.end(), "", False, ""
            found = _COMMENT_END.search(page, m.end())
            return m.start(), found.end() if found else len(page), "", False, ""
        if m.end() > self.last:
            # Only a comment may still begin, as it needs no end.
            begun = page.find("<!--", m.start() + 1)
            return None if begun < 0 else self.next(begun)
        if opened not in ("<!", "<?") and (end := self._close(m.end())) >= 0:
            closing = opened[1] == "/"
            return m.start(), end + 1, opened[1 + closing :], closing, page[m.end() : end]
        return m.start(), page.index(">", m.end()) + 1, "", False, ""


def text_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, those without text left out.

    White space within a block is one space, character references are decoded after the tags are read, and the
    content of scripts, styles and the like is no text. Elements may be left open, closed twice or cut off.
    """
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, str | None]] = []
    parts: list[str] = []
    linked: list[str] = []
    links, at = -1, 0  # the depth at which a link began
    endless: set[str] = set()  # silent elements without an end tag from here on
    opened: Counter[str] = Counter()  # elements on the stack by tag
    tags = _Tags(page)

    def end() -> None:
        nonlocal parts, linked
        words = html.unescape("".join(parts)).split()
        if words:
            heading = any(tag in HEADINGS for tag, _ in stack[-3:])
            in_links = len(html.unescape(" ".join(linked)).split())
            blocks.append(Block(" ".join(words), len(words), min(in_links, len(words)), stack[-1][1] if stack else None, heading))
        parts, linked = [], []

    def say(text: str) -> None:
        if text:
            parts.append(text)
            if links >= 0:
                linked.append(text)

    def past(tag: str, start: int) -> int:
        """Where the content of a silent element ends that begins here."""
        if tag not in endless:
            if found := _END[tag].search(page, start):
                return found.end()
            endless.add(tag)
        return start if tag in EMBEDDED else len(page)

    def leave(depth: int) -> None:
        opened.subtract(tag for tag, _ in stack[depth:])
        del stack[depth:]

    while found := tags.next(at):
        start, stop, tag, closing, said = found
        say(page[at:start])
        at = stop
        if not tag:
            continue
        tag = tag.lower()
        if tag in SILENT:
            if not closing and not (tag in EMBEDDED and said.endswith("/")):
                at = past(tag, at)
        elif tag == "a":
            links = -1 if closing else len(stack)
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            end()
            if closing:
                if opened[tag]:
                    leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            elif tag != "hr":
                if stack and stack[-1][0] == "p":
                    leave(len(stack) - 1)
                if tag in GROUPS and stack and stack[-1][0] in GROUPS[tag].split():
                    leave(len(stack) - 1)
                stack.append((tag, _kind(tag, said, stack[-1][1] if stack else None)))
                opened[tag] += 1
            if len(stack) < links:  # what was around an open link has ended
                links = -1
    say(page[at:])
    end()
    return blocks
