"""Blocks of text in an HTML page, with the elements that hold them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import xxhash

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*+)(?:>|\Z)
    |[^<]++|<""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?""")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template iframe noscript noframes textarea title xmp".split())
HEAD = set("title meta link style script base noscript template".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# Starting one of these ends an open one of its row.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SIBLING_SCOPE = set("ul ol menu dl table select".split())

# Elements that are never part of an article, nor anything they hold.
ASIDE_TAGS = set("head nav footer aside button select menu svg canvas audio video applet datalist".split())
# These are neither, unless the article stands inside of them.
WRAPPING_TAGS = {"form", "dialog"}
# Nouns that say what an element is if they end a token of its class, id or role, or
# begin one that ends in a word for a part of something.
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox sponsor sponsored "
    "sponsors promo promotion promotions banner cookie cookies consent gdpr notice notices alert "
    "alerts popup modal overlay newsletter subscribe subscription signup share sharing social "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer masthead toolbar related recommended recommendations widget widgets search login "
    "contentinfo complementary form disclaimer copyright".split()
)
COMMENT_WORDS = set("comment comments commentlist disqus respond replies".split())
PART_WORDS = set(
    "area articles bar block body box button buttons container footer header icons inner item items "
    "left link links list panel posts right section slot text thread title top unit wrap wrapper".split()
)
# Before such a noun these say what an element has or lacks, not what it is.
STATE_WORDS = set("has no not without with is open closed hide show toggle enable disable".split())
# These mark a page's head only outside of its article.
HEADER_WORDS = {"header", "topbar"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# How sure a mark is: SOFT ones say nothing of an element that holds the article.
SOFT, COMMENT, HARD = 1, 2, 3
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Within an article only these can be a site's template; paragraphs never are.
CONTAINERS = set("div section ul ol dl table figure details".split())


@dataclass
class Element:
    tag: str
    parent: int
    mark: int
    article: bool
    main: bool
    aside: bool = False
    parts: list[str] = field(default_factory=list)
    digest: int = 0


@dataclass
class Page:
    """Elements in page order (a parent before its children), and the blocks of text
    as (text, number of the element that holds it)."""

    elements: list[Element]
    blocks: list[tuple[str, int]]

    def article(self) -> Page:
        """The part that is the article: of article elements, else of main elements,
        else of the whole body; without what stands aside."""
        held = [(t, e) for t, e in self.blocks if not self.elements[e].aside]
        for flag in ("article", "main"):
            inner = [(t, e) for t, e in held if getattr(self.elements[e], flag)]
            if inner:
                return Page(self.elements, inner)
        return Page(self.elements, held)

    def candidates(self) -> list[bool]:
        """Elements that may belong to a site's template."""
        marked = any(self.elements[e].article or self.elements[e].main for _, e in self.blocks)
        return [
            e.tag in CONTAINERS if marked else e.tag in BLOCK and e.tag not in ("html", "body")
            for e in self.elements
        ]


def _token_mark(token: str, article: bool) -> int:
    """What one token of a class, id or role says of its element; 0 for nothing."""
    parts = [p.lower() for p in _PART.findall(token)]
    if not parts or (len(parts) > 1 and parts[0] in STATE_WORDS):
        return 0
    words = {parts[-1], parts[0] if parts[-1] in PART_WORDS else parts[-1]}
    if words & COMMENT_WORDS:
        return COMMENT
    return SOFT if words & ASIDE_WORDS or (not article and words & HEADER_WORDS) else 0


def _mark(tag: str, rest: str, article: bool) -> int:
    """Whether an element stands aside, by itself. Whole tokens count, as parts of
    slugs and states do not; ids of headings and within an article are slugs, unless
    they name the comments."""
    if tag in ASIDE_TAGS or (tag == "header" and not article):
        return HARD
    found = SOFT if tag in WRAPPING_TAGS else 0
    if tag in ("html", "body", "main") or ("=" not in rest and "hidden" not in rest):
        return found
    for name, value in _ATTRIBUTE.findall(rest):
        name = name.lower()
        if name == "hidden":
            found = max(found, SOFT)
        if name in ("class", "id", "role"):
            slug = name == "id" and (article or tag in HEADINGS)
            for token in value.strip("\"'").split():
                mark = _token_mark(token, article)
                if mark == COMMENT or not slug:
                    found = max(found, 0 if tag in HEADINGS and name == "id" else mark)
    return found


def _settle(elements: list[Element], blocks: list[tuple[str, int]]) -> None:
    """Decide which elements stand aside.

    An article, or an element that holds one, is not aside because of a soft mark.
    Reader comments may be articles too, and teasers in a sidebar, so comments and
    elements such as nav or aside stay aside; but if that leaves no text at all,
    nothing that is or holds an article is.
    """

    def held(below: int) -> list[bool]:
        """Elements that are or hold an article; those behind a mark of at least
        ``below`` don't count."""
        hidden = [False] * len(elements)
        for i, e in enumerate(elements[1:], start=1):
            hidden[i] = hidden[e.parent] or e.mark >= below
        out = [e.tag in ("article", "main") and not hidden[i] for i, e in enumerate(elements)]
        for i in range(len(elements) - 1, 0, -1):
            if out[i]:
                out[elements[i].parent] = True
        return out

    def decide(below: int) -> None:
        holds = held(below)
        for i, e in enumerate(elements[1:], start=1):
            own = e.mark and not (holds[i] and e.mark < below)
            e.aside = elements[e.parent].aside or bool(own)

    decide(COMMENT)
    if all(elements[e].aside for _, e in blocks):
        decide(HARD + 1)


def parse(html: str) -> Page:
    """The elements and blocks of a page. Faulty markup never fails: what isn't closed
    ends with its parent, and what closes nothing is passed over."""
    root = Element("", -1, 0, False, False)
    elements, blocks = [root], []
    stack = [0]
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                blocks.append((text, stack[-1]))
                elements[stack[-1]].parts.append(text)

    def close(depth: int) -> None:
        """Ends all elements from that place of the stack on."""
        flush()
        while len(stack) > depth:
            done = elements[stack.pop()]
            joined = done.tag + "\x1f" + "\x1f".join(done.parts)
            done.digest = xxhash.xxh64_intdigest(joined.encode("utf-8", "surrogatepass")) >> 1
            done.parts = []
            elements[stack[-1]].parts.append(str(done.digest))

    def find(names: set[str], stops: set[str]) -> int:
        """Place of the innermost open element of that name, before any stop; or 0."""
        for depth in range(len(stack) - 1, 0, -1):
            tag = elements[stack[depth]].tag
            if tag in names:
                return depth
            if tag in stops:
                return 0
        return 0

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.match(html, at)
        at = token.end()
        name = token["name"] or token["name2"]
        if name is None:
            if token[0][:2] not in ("<!", "<?"):
                buffer.append(token[0])
            continue
        tag = name.lower()
        rest = token["rest"] or token["rest2"] or ""
        if token["end"] or token["end2"]:
            wide = tag in BLOCK or tag in ASIDE_TAGS or tag in WRAPPING_TAGS
            depth = find({tag}, set() if wide else BLOCK)
            if depth and (tag in BLOCK or elements[stack[depth]].mark):
                close(depth)
            continue
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
            at = stop.start() if stop else size
            continue
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag not in HEAD and tag != "head" and find({"head"}, set()):
            close(find({"head"}, set()))
        if tag in BLOCK:
            flush()
            depth = find({"p"}, BLOCK - {"p"})
            if depth:
                close(depth)
            if tag in SIBLINGS:
                depth = find(SIBLINGS[tag], SIBLING_SCOPE)
                if depth:
                    close(depth)
        inside = elements[stack[-1]]
        mark = _mark(tag, rest, inside.article)
        if mark:
            flush()
        if rest.endswith("/") and tag not in BLOCK:
            continue
        if tag in BLOCK or mark:
            elements.append(
                Element(
                    tag,
                    stack[-1],
                    mark,
                    inside.article or tag == "article",
                    inside.main or tag == "main" or re.search(r"role\s*=\s*[\"']?main", rest) is not None,
                )
            )
            stack.append(len(elements) - 1)
    close(1)
    _settle(elements, blocks)
    return Page(elements, blocks)
