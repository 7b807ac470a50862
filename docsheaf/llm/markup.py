"""A small reader of HTML as found: elements, their subtree hashes, their text."""

from __future__ import annotations

import re
from html import unescape

import xxhash

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not markup; it ends at their own end tag only.
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol
    p pre section summary table tbody td tfoot th thead tr ul""".split())
# What a start tag closes if it is open, up to the nearest element of the second set.
_SCOPE = frozenset("table ul ol dl body html article section div td th main aside nav form".split())
CLOSES = {t: (frozenset(["p"]), _SCOPE) for t in BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}}
CLOSES |= {
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr"]), frozenset(["table"])),
}

DROPPED = frozenset("""head script style noscript template iframe object svg canvas nav header footer aside
    form button select textarea input dialog menu title""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_NAMES = frozenset("""ad ads adbox advert advertisement adverts advertising adsense banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe subscription signup
    sidebar sidenav menu navbar nav navigation breadcrumb breadcrumbs header masthead footer
    comment comments respond reply replies disqus discussion share sharing social related recommended recommendations
    widget toolbar pagination pager""".split())
HOLDERS = frozenset(["html", "body", "article", "main"])

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME = re.compile(r"[^a-z0-9]+")


class Page:
    """Elements in page order. ``items`` of one are its texts and the numbers of its children."""

    def __init__(self, html: str | None) -> None:
        self.tag, self.parent, self.attrs, self.items = ["#root"], [-1], [""], [[]]
        html = html or ""
        stack, at = [0], 0
        while at < len(html):
            found = _MARKUP.search(html, at)
            end = found.start() if found else len(html)
            if end > at:
                self.items[stack[-1]].append(unescape(html[at:end]))
            if not found:
                break
            at = found.end()
            if found[1]:
                self._close(stack, found[1].lower())
            elif found[2]:
                tag = found[2].lower()
                self._implied(stack, tag)
                node = len(self.tag)
                self.tag.append(tag)
                self.parent.append(stack[-1])
                self.attrs.append(found[3].strip())
                self.items.append([])
                self.items[stack[-1]].append(node)
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s>/])[^>]*>", re.I).search(html, at)
                    self.items[node].append(html[at:close.start() if close else len(html)])
                    at = close.end() if close else len(html)
                elif tag not in VOID and not found[3].endswith("/"):
                    stack.append(node)

    def _implied(self, stack: list[int], tag: str) -> None:
        if tag in CLOSES:
            closes, scope = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if self.tag[stack[depth]] in closes:
                    del stack[depth:]
                elif self.tag[stack[depth]] in scope:
                    break

    def _close(self, stack: list[int], tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] == tag:
                del stack[depth:]
                return

    def attributes(self, node: int) -> dict[str, str]:
        return {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(self.attrs[node])}

    def dropped(self) -> list[bool]:
        """Per element whether it or what is around it is no part of a main text."""
        holds = [t in ("article", "main") for t in self.tag]
        heading = [t == "h1" for t in self.tag]
        for node in range(len(self.tag) - 1, 0, -1):
            up = self.parent[node]
            holds[up] = holds[up] or holds[node]
            heading[up] = heading[up] or heading[node]
        out, inside = [False] * len(self.tag), [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            up, tag = self.parent[node], self.tag[node]
            inside[node] = inside[up] or tag in ("article", "main")
            title = tag == "header" and inside[node] and heading[node]
            out[node] = out[up] or tag in DROPPED and not title or self._named(node, holds[node], title)
        return out

    def _named(self, node: int, holds: bool, title: bool) -> bool:
        """Whether class, id, role or visibility say that an element is none of the text."""
        if not self.attrs[node]:
            return False
        a = self.attributes(node)
        if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
            return True
        if holds and not (self.tag[node] == "article" and "comment" in _NAME.split(a.get("class", "").lower())):
            return False
        if self.tag[node] in HOLDERS and self.tag[node] != "article" or title:
            return False
        names = _NAME.split(f"{a.get('class', '')} {a.get('id', '')}".lower())
        return a.get("role", "").lower() in DROPPED_ROLES or not DROPPED_NAMES.isdisjoint(names)

    def mains(self, dropped: list[bool]) -> list[int]:
        """The elements whose text counts: outermost articles, else mains, else the whole page."""
        for kind in ("article", "main"):
            found: list[int] = []
            within = [False] * len(self.tag)
            for node in range(1, len(self.tag)):
                up = self.parent[node]
                within[node] = within[up] or self.tag[node] == kind
                if self.tag[node] == kind and not within[up] and not dropped[node]:
                    found.append(node)
            if found:
                return found
        return [0]

    def digests(self) -> list[int | None]:
        """A hash of each subtree: tags, order and text, not attributes. None without text."""
        out: list[int | None] = [None] * len(self.tag)
        for node in range(len(self.tag) - 1, -1, -1):
            if self.tag[node] in RAW:
                continue
            parts, text = [self.tag[node]], False
            for item in self.items[node]:
                if isinstance(item, int):
                    parts.append(f"{self.tag[item]}:{out[item]}")
                    text = text or out[item] is not None
                elif plain := " ".join(item.split()):
                    parts.append(f"#{plain}")
                    text = True
            if text:
                value = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "replace"))
                out[node] = value - (1 << 64) if value >= 1 << 63 else value
        return out

    def blocks(self, top: int, skip: list[bool]) -> list[str]:
        """The texts of blocks under an element in page order."""
        out: list[str] = []
        held: list[str] = []

        def flush() -> None:
            if text := " ".join("".join(held).split()):
                out.append(text)
            held.clear()

        todo: list[int | str | None] = [top]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                held.append(item)
            elif not skip[item] and self.tag[item] not in RAW:
                if self.tag[item] == "br":
                    held.append(" ")
                block = self.tag[item] in BLOCK
                if block:
                    flush()
                    todo.append(None)
                todo.extend(reversed(self.items[item]))
            elif self.tag[item] in BLOCK:
                flush()
        flush()
        return out


def candidates(page: Page) -> tuple[list[int], int]:
    """Hashes of the subtrees that could be furniture, and one of the page's main text."""
    dropped = page.dropped()
    digests = page.digests()
    tops = page.mains(dropped)
    inside = [False] * len(page.tag)
    for top in tops:
        inside[top] = True
    found = set()
    for node in range(1, len(page.tag)):
        inside[node] = inside[node] or inside[page.parent[node]]
        if inside[node] and not dropped[node] and node not in tops and digests[node] is not None:
            found.add(digests[node])
    body = xxhash.xxh64_intdigest("\n".join(b for t in tops for b in page.blocks(t, dropped)).encode("utf-8", "replace"))
    return sorted(found), body - (1 << 64) if body >= 1 << 63 else body


def main_text(page: Page, templates: set[int]) -> str:
    """The main text without elements whose subtree is in ``templates``."""
    skip = page.dropped()
    tops = page.mains(skip)
    if templates:
        digests = page.digests()
        skip = [s or d in templates and n not in tops for n, (s, d) in enumerate(zip(skip, digests))]
    return "\n".join(b for top in tops for b in page.blocks(top, skip))
