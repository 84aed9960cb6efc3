"""The lines of a web page with the part of the page they stand in, and their alignment with another page's lines."""

from __future__ import annotations

import re
from html import unescape

MAIN, OPEN, CHROME = "main", "open", "chrome"

OPENING = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|(!--)|(!\[CDATA\[)|[!?])")
# The rest of a tag: quoted values may hold the closing sign; where quotes do not match they are letters like any other.
QUOTED_REST = re.compile(r"((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>")
# Each quote without its partner costs a look at all of the page, so after some of them quotes are not looked at any more.
MOST_UNMATCHED = 16
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Whatever stands in these is no text of the page.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg")}
DROPPED = frozenset("nav footer aside form button select option menu dialog head object canvas audio video map label".split())
CONTENT = frozenset(("article", "main"))
# Words in class, id or role that name such a part.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment "
    "commentlist comments complementary consent contentinfo cookie cookies disqus dropdown footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter overlay pager "
    "pagination popup promo respond share sharing sidebar "
    "signup skip sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
# Words that name such a part only if all others beside them do, or say no more than that it is a part.
WEAK_HINTS = frozenset(
    "alert aside copyright discussion form notice notices notification promoted promotion recommended related replies reply "
    "search social tags".split()
)
PLAIN_WORDS = frozenset(
    "area articles bar block bottom box button buttons card col column container content cookies field fixed global group header "
    "icons inner items left links list main module more navigation outer page panel posts right row section site sticky stories "
    "title top widget wrap wrapper".split()
)
HEADER_HINTS = frozenset(("header", "heading", "hero"))
NEVER_HINTED = frozenset(("html", "body", "article", "main"))


def attributes(text: str) -> dict[str, str]:
    return {name.lower(): unescape((value or "").strip("\"'")) for name, value in ATTRIBUTE.findall(text)}


def part_of(tag: str, attribute_text: str) -> str | None:
    """What an element is by its name and its hints: content, chrome, a header, or nothing of its own."""
    if tag in CONTENT:
        return MAIN
    if tag in DROPPED:
        return CHROME
    found = attributes(attribute_text) if attribute_text.strip() else {}
    if tag not in NEVER_HINTED and found:
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
            return CHROME
        if found.get("role") == "main":
            return MAIN
        named = set(re.findall(r"[a-z0-9]+", " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()))
        if named & HINTS or named & WEAK_HINTS and named <= WEAK_HINTS | PLAIN_WORDS:
            return CHROME
        if named & HEADER_HINTS:
            return "header"
    return "header" if tag == "header" else None


class Place:
    """The open elements around a place in a page, with counts, so that no look at them walks the whole stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str | None]] = []
        self.tags: dict[str, int] = {}
        self.parts: dict[str | None, int] = {}
        self.headings = 0

    def step(self, tag: str, part: str | None, by: int) -> None:
        self.tags[tag] = self.tags.get(tag, 0) + by
        self.parts[part] = self.parts.get(part, 0) + by
        self.headings += by * (tag in HEADINGS)

    def push(self, tag: str, part: str | None) -> None:
        self.stack.append((tag, part))
        self.step(tag, part, 1)

    def pop(self) -> str:
        tag, part = self.stack.pop()
        self.step(tag, part, -1)
        return tag

    def close(self, tag: str) -> bool:
        """Leave the innermost element of this name and all within it, if there is one."""
        if not self.tags.get(tag):
            return False
        while self.pop() != tag:
            pass
        return True

    def part(self) -> str:
        if self.parts.get(CHROME):
            return CHROME
        inside = self.parts.get(MAIN)
        if self.parts.get("header") and not (inside and self.headings):
            return CHROME
        return MAIN if inside else OPEN


def page_lines(html: str) -> list[tuple[str, str]]:
    """``(part, text)`` of every block in page order; white space is one space, character references are decoded.

    Inside an article only navigation, forms, asides, comments and the like are chrome; of its header the headings count.
    Elements that are never closed end with the element around them, a paragraph ends at the next block.  A ``<`` that no
    ``>`` follows is text.  The time is linear in the page, whatever it holds.
    """
    place = Place()
    lines, pieces = [], {MAIN: [], OPEN: [], CHROME: []}
    unmatched, last_end = 0, html.rfind(">")

    def flush():
        for part, texts in pieces.items():
            if texts:
                if line := " ".join("".join(texts).split()):
                    lines.append((part, line))
                texts.clear()

    # ``part`` is that of the text that follows; a paragraph may be chrome of its own, up to the next block.
    part, hinted, text_from, at, n = OPEN, False, 0, 0, len(html)
    while at < n:
        found = OPENING.search(html, at)
        if not found:
            break
        start, at = found.start(), found.end()
        if found.group(3) or found.group(4):
            sign = "-->" if found.group(3) else "]]>"
            end = html.find(sign, at)
            pieces[part].append(unescape(html[text_from:start]))
            at = text_from = n if end < 0 else end + len(sign)
            continue
        if at > last_end:
            # No tag ends any more: what is left is text, up to a comment.
            at = start + 1
            rest = re.compile(r"<!--|<!\[CDATA\[").search(html, at)
            at = rest.start() if rest else n
            continue
        closing, tag = found.group(1, 2)
        whole = QUOTED_REST.match(html, at) if tag and unmatched < MOST_UNMATCHED else None
        if whole:
            attribute_text, end = whole.group(1), whole.end()
        else:
            unmatched += tag is not None
            end = html.index(">", at) + 1
            attribute_text = html[at : end - 1]
        pieces[part].append(unescape(html[text_from:start]))
        at = text_from = end
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
            part, hinted = place.part(), False
        elif tag == "br":
            pieces[part].append(" ")
        if closing:
            if place.close(tag) and not hinted:
                part = place.part()
            continue
        if tag in RAW:
            if not attribute_text.rstrip().endswith("/"):
                close = RAW[tag].search(html, at)
                at = text_from = close.start() if close else n
            continue
        if tag == "p":
            if part_of(tag, attribute_text) == CHROME:
                part, hinted = CHROME, True
            continue
        if tag in VOID or attribute_text.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag in HEADINGS and place.stack and place.stack[-1][0] in HEADINGS:
            place.pop()
        place.push(tag, part_of(tag, attribute_text))
        part = CHROME if hinted else place.part()
    pieces[part].append(unescape(html[text_from:]))
    flush()
    return lines


MOST_BITS = 1 << 28


def rows(a: list, b: list) -> list[int]:
    """After every element of ``a`` the differences of the LCS lengths along ``b`` as bits: zero where they grow."""
    places: dict = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        out.append(v)
    return out


def prefix_lengths(a: list, b: list) -> list[int]:
    """LCS lengths of ``a`` with every prefix of ``b``."""
    v = (1 << len(b)) - 1
    for last in rows(a, b)[-1:]:
        v = last
    bits = bin(v | (1 << len(b)))[:2:-1]
    out = [0]
    for bit in bits:
        out.append(out[-1] + (bit == "0"))
    return out


def shared(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, ascending.

    Lines that the other side lacks are left out first.  Where the table would be large the problem is halved, so memory
    stays bounded.
    """
    in_a, in_b = set(a), set(b)
    where = [i for i, x in enumerate(a) if x in in_b]
    return [where[i] for i in common([a[i] for i in where], [y for y in b if y in in_a])]


def common(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > MOST_BITS and len(a) > 1:
        middle = len(a) // 2
        front = prefix_lengths(a[:middle], b)
        back = prefix_lengths(a[:middle - 1:-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: front[j] + back[len(b) - j])
        return common(a[:middle], b[:cut]) + [middle + i for i in common(a[middle:], b[cut:])]
    table, out = rows(a, b), []
    i, j = len(a), len(b)
    while i and j:
        if table[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or table[i - 1] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


def main_text(lines: list[tuple[str, str]], shared_lines: set[int]) -> str:
    """The lines left when shared ones and chrome are deleted.

    Lines of an article or main element are content whether another page repeats them or not; where a page has such an
    element with text, what stands outside it is none.  Where every other line is shared, the comparison tells nothing and
    all stay.
    """
    content = [text for part, text in lines if part == MAIN]
    if not content:
        content = [text for i, (part, text) in enumerate(lines) if part == OPEN and i not in shared_lines]
    if not content:
        content = [text for part, text in lines if part == OPEN]
    return "\n".join(content)
