"""A small HTML reader: tags to a tree of branches and text blocks (pure Python).

It follows the parts of the HTML standard that decide where text belongs: raw
text elements, void elements, elements that close an open paragraph or list item,
end tags that close everything opened since, and pages that end anywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(>|\Z)|<[!?/][^>]*(?:>|\Z)""",
                  re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "br"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
            "table", "ul"}
# an opened element of the left closes the nearest open one of the right, unless a list or table is between
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}}
FENCE = {"ul", "ol", "dl", "table", "select", "menu"}

NEST = 200                           # elements nested deeper leave their text to the branch above

# Branches whose role the page itself names.
NOISE_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "object",
              "template", "fieldset"} | RAW
MAIN_TAGS = {"article", "main"}
NEVER_NAMED = {"html", "body", "main", "article"}            # no class, id or role makes these noise
WRAPPERS = {"form", "fieldset", "dialog", "header"}          # tags that sites also put around whole pages
# whole class names and ids ('_' as '-'): a part of one, as in 'no-sidebar', says nothing
NOISE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "breadcrumb", "breadcrumbs",
               "comment", "comments", "cookie", "cookies", "consent", "disqus", "footer", "masthead", "menu", "nav",
               "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "share", "sharing",
               "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
               "ad-banner", "ad-container", "ad-slot", "ad-unit", "comment-list", "comment-respond", "comments-area",
               "cookie-banner", "cookie-consent", "cookie-notice", "main-menu", "main-nav", "main-navigation",
               "nav-menu", "related-articles", "related-posts", "share-buttons", "share-links", "site-footer",
               "site-nav", "site-navigation", "social-links", "social-share", "widget-area"}
# parts of a class name or id that make a branch the readers' comments, unless a part says it only speaks of them
COMMENT_PARTS = {"comment", "comments", "commentlist", "disqus", "livefyre", "replies", "respond", "guestbook"}
ABOUT_COMMENTS = {"no", "without", "has", "have", "with", "open", "closed", "enabled", "disabled", "count", "link", "single"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CARD_HEAD = 12                       # words of the line that names a comment's author and date, at most
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog"}


@dataclass
class Branch:
    tag: str
    label: str                       # what the style tree compares: tag, class, id
    kind: str = ""                   # "noise", "main", "open" (the site's tree decides, in a main part too) or "" (it decides)
    children: list[Branch | str] = field(default_factory=list)
    asks: bool = False               # an open branch is below
    links: int = 0                   # links in its own blocks
    linked: int = 0                  # characters of them
    timed: bool = False              # its first block has a time element


def _of_comments(name: str) -> bool:
    parts = set(re.split("[-_]+", name))
    return bool(parts & COMMENT_PARTS) and not parts & ABOUT_COMMENTS


def _kind(tag: str, names: set[str], role: str, inside_main: bool) -> str:
    """As Branch.kind, or "named": noise by a name or wrapper, which _settle has yet to confirm."""
    if tag not in NEVER_NAMED:
        if tag in NOISE_TAGS - WRAPPERS or any(map(_of_comments, names)):
            return "noise"
        if tag in WRAPPERS and (tag != "header" or not inside_main) or role in NOISE_ROLES:
            return "named"
        if names & NOISE_NAMES or names & {"header", "site-header"} and not inside_main:
            return "named"
    return "main" if tag in MAIN_TAGS or role == "main" else ""


def _below(branch: Branch) -> list[Branch]:
    return [c for c in branch.children if isinstance(c, Branch)]


def _settle(root: Branch) -> None:
    """Decide the named branches once the whole page is known.

    A branch around html, body or a main element is no noise, whatever it is called (a
    head or nav that was never closed); nor is a named one that holds more than half of
    the page's text.  A smaller one around an article stays noise beside another main
    part, as a list of related articles; without one, the site's counts decide on it all.
    """
    sizes: dict[int, int] = {}
    holds: dict[int, str] = {}           # "anchor", "article" or "": the strongest main part with text below

    def weigh(branch: Branch) -> None:
        size, held = sum(len(c) for c in branch.children if isinstance(c, str)), ""
        for c in _below(branch):
            if c.tag in RAW:
                continue
            weigh(c)
            if c.kind == "noise" and holds[id(c)] != "anchor":
                continue
            size += sizes[id(c)]
            own = sizes[id(c)] and ("anchor" if c.tag in NEVER_NAMED and c.tag != "article"
                                    or c.kind == "main" and c.tag != "article" else
                                    "article" if c.kind == "main" else "")
            held = "anchor" if "anchor" in (held, own, holds[id(c)]) else held or own or holds[id(c)]
        sizes[id(branch)], holds[id(branch)] = size, held

    weigh(root)
    late: list[Branch] = []

    def decide(branch: Branch, demote: bool = False) -> None:
        for c in _below(branch):
            if c.kind == "noise" and c.tag not in RAW and holds[id(c)] == "anchor":
                c.kind = ""
            elif c.kind == "named":
                if holds[id(c)] == "anchor" or 2 * sizes[id(c)] > sizes[id(root)]:
                    c.kind = "open"
                else:
                    c.kind = "noise"
                    if holds[id(c)]:
                        late.append(c)
            elif demote and c.kind == "main":
                c.kind = ""
            if c.kind != "noise":
                decide(c, demote)
            branch.asks |= c.kind == "open" or c.kind != "noise" and c.asks

    decide(root)
    if late and not has_main(root):
        for c in late:
            c.kind = "open"
            decide(c, demote=True)


def has_text(branch: Branch) -> bool:
    return any(isinstance(c, str) or c.kind != "noise" and has_text(c) for c in branch.children)


def has_main(branch: Branch) -> bool:
    return any(has_main(c) if c.kind != "main" else has_text(c) for c in _below(branch) if c.kind != "noise")


def parse(html: str) -> Branch:
    """The page as a tree; inline elements vanish, their text stays with the block."""
    root = Branch("", "")
    stack: list[Branch] = [root]
    deeper: list[str] = []               # open elements below NEST: no branches of their own
    text: list[str] = []
    link = [False, 0, 0]                 # inside a link; links and their characters in the block
    timed = [False]

    def flush() -> None:
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            branch = stack[-1]
            branch.timed |= timed[0] and not branch.children
            branch.links += link[1]
            branch.linked += min(link[2], len(block))
            branch.children.append(block)
        link[1:], timed[0] = [0, 0], False

    def add(piece: str) -> None:
        text.append(piece)
        if link[0]:
            link[2] += len(piece.strip())

    def close(upto: int) -> None:
        flush()
        del stack[upto:]
        deeper.clear()

    at = 0
    for match in iter(lambda: _TAG.search(html, at), None):
        add(unescape(html[at:match.start()]))
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag or not match[4] and at == len(html):         # a comment, or a tag cut off by the end
            continue
        if match[1]:
            if tag in INLINE:
                link[0] &= tag != "a"
                continue
            if tag in deeper:
                flush()
                while deeper.pop() != tag:
                    pass
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag == "br":
            text.append(" ")
        if tag in INLINE:
            if tag == "a":
                link[:2] = True, link[1] + 1
            timed[0] |= tag == "time"
            continue
        flush()
        if tag in VOID:
            continue
        if len(stack) > NEST and tag not in RAW:
            deeper.append(tag)
            continue
        for i in range(len(stack) - 1, 0, -1):
            open_tag = stack[i].tag
            if open_tag in SIBLINGS.get(tag, ()) or open_tag == "p" and (tag in CLOSES_P or tag in SIBLINGS):
                close(i)
                if tag not in SIBLINGS:
                    break
            elif open_tag in FENCE:
                break
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(match[3] or "")}
        named = f"{found.get('class', '')} {found.get('id', '')}".lower()
        inside = any(b.kind == "main" for b in stack)
        kind = _kind(tag, set(named.replace("_", "-").split()), found.get("role", "").lower(), inside)
        branch = Branch(tag, f"{tag} {named.strip()}".strip(), kind)
        stack[-1].children.append(branch)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]|</{re.escape(tag)}\Z", re.I).search(html, at)
            body = html[at:end.start() if end else len(html)]
            branch.children.append(" ".join(body.split()))
            at = len(html) if end is None else html.find(">", end.start()) + 1 or len(html)
        elif not match[3].endswith("/") or tag not in ("svg", "path"):
            stack.append(branch)
    add(unescape(html[at:]))
    close(1)
    _settle(root)
    return root


_MONTH = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_DATE = re.compile(rf"\b(?:\d{{1,2}}[:h]\d\d|\d{{4}}-\d\d-\d\d|\d{{1,2}}[./]\d{{1,2}}[./]\d{{2,4}}"
                   rf"|\d{{1,2}}(?:st|nd|rd|th)?\.? (?:{_MONTH})[a-z]*|(?:{_MONTH})[a-z]* \d{{1,2}}"
                   r"|(?:\d+|an?) (?:second|minute|min|hour|day|week|month|year)s? ago|yesterday|today)\b", re.I)


def texts(branch: Branch) -> list[str]:
    """All text blocks outside noise, in order."""
    return [t for c in branch.children for t in ([c] if isinstance(c, str) else texts(c) if c.kind != "noise" else ())]


def _first(branch: Branch) -> Branch:
    """The branch whose own block comes first."""
    for c in branch.children:
        if isinstance(c, str):
            return branch
        if c.kind != "noise" and has_text(c):
            return _first(c)
    return branch


def _headed(branch: Branch) -> bool:
    return branch.tag in HEADINGS or any(map(_headed, _below(branch)))


def is_card(branch: Branch) -> bool:
    """A short line with a name and a date, then text without a heading: what readers' comments look like."""
    if branch.kind or not _below(branch):
        return False
    said = texts(branch)
    if len(said) < 2 or len(said[0].split()) > CARD_HEAD or _headed(branch):
        return False
    date = _DATE.search(said[0])
    if not date:
        return _first(branch).timed
    return any(w.isalpha() for w in (said[0][:date.start()] + said[0][date.end():]).split()) or _first(branch).timed


def link_shares(root: Branch) -> dict[int, tuple[int, int, int]]:
    """By id of a branch: links, their characters and all characters of its text outside noise."""
    out: dict[int, tuple[int, int, int]] = {}

    def weigh(branch: Branch) -> tuple[int, int, int]:
        links, linked, size = branch.links, branch.linked, sum(len(c) for c in branch.children if isinstance(c, str))
        for c in _below(branch):
            if c.kind != "noise":
                more = weigh(c)
                links, linked, size = links + more[0], linked + more[1], size + more[2]
        out[id(branch)] = links, linked, size
        return out[id(branch)]

    weigh(root)
    return out


def cards(branch: Branch) -> set[int]:
    """ids of the child branches that are comments: two or more cards of one label.  Where they hold
    most of a branch's text, the branch itself is one (its id)."""
    found: dict[str, list[Branch]] = {}
    for c in _below(branch):
        if not c.kind and _below(c):
            found.setdefault(c.label, []).append(c)
    alike = [[c for c in some if is_card(c)] for some in found.values() if len(some) > 1]
    out = [c for some in alike if len(some) > 1 for c in some]
    said = sum(len(t) for c in out for t in texts(c))
    if out and branch.tag and branch.tag not in NEVER_NAMED and branch.kind != "main" and (
            2 * said > sum(map(len, texts(branch)))):
        return {id(branch)}
    return {id(c) for c in out}
