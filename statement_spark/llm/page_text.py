"""Plain text, title, language, character set and links of an HTML page, on its UTF-8 bytes.

Every step goes once over the page: an opening without its end is met once, since what follows the last end is left out
of the search, so pages of unclosed comments, tags or scripts take time in proportion to their length.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

from statement_spark.llm.warc_patterns import BLOCK_TAGS, ENTITIES, HIDDEN_TAGS

BLOCK_TAG = re.compile(rf"</?(?:{BLOCK_TAGS})(?:[ \t\r\n/][^>]*)?>".encode(), re.I)
ANY_TAG = re.compile(rb"<[A-Za-z/!?][^>]*>")
NUMBERED = re.compile(rb"&#(?:([0-9]{1,7})|[xX]([0-9A-Fa-f]{1,6}));")
NAMED = re.compile(b"&(" + "|".join(ENTITIES).encode() + b");")
VALUES = {name.encode(): value.encode() for name, value in ENTITIES.items()}
HIDDEN = [(f"<{tag}".encode(), re.compile(rf"</{tag}[ \t\r\n]*>".encode())) for tag in HIDDEN_TAGS]
HREF = re.compile(rb"""href[ \t\r\n]*=[ \t\r\n]*["']([^"'>]*)["']""", re.I)
LANG = re.compile(rb"""(?=[ \t\r\n]lang[ \t\r\n]*=[ \t\r\n]*["']([^"'>]*)["'])""", re.I)
CHARSET = re.compile(rb"""(?=charset[ \t\r\n]*=[ \t\r\n]*["']?([A-Za-z0-9_-]+))""", re.I)
WHITE = bytes.maketrans(b"\t\r\f\x0b", b"    ")
BLANKS, LINES = re.compile(rb" {2,}"), re.compile(rb" ?\n[ \n]*")


def without_comments(page: bytes) -> bytes:
    parts, at = [], 0
    while (start := page.find(b"<!--", at)) >= 0 and (end := page.find(b"-->", start + 4)) >= 0:
        parts += page[at:start], b" "
        at = end + 3
    return b"".join((*parts, page[at:])) if parts else page


def without_hidden(page: bytes) -> bytes:
    """Without scripts, styles and the like, each a blank; one kind after the other."""
    for opening, closing in HIDDEN:
        low, parts, at, seek = page.lower(), [], 0, 0
        while (start := low.find(opening, seek)) >= 0:
            seek = start + len(opening)
            if low[seek:seek + 1] not in (b" ", b"\t", b"\r", b"\n", b">"):
                continue
            end = closing.search(low, seek + 1)
            if end is None:
                break
            parts += page[at:start], b" "
            at = seek = end.end()
        page = b"".join((*parts, page[at:])) if parts else page
    return page


def without_tags(page: bytes) -> bytes:
    """Block tags as line feeds, other tags away."""
    for pattern, put in ((BLOCK_TAG, b"\n"), (ANY_TAG, b"")):
        last = page.rfind(b">") + 1
        page = pattern.sub(put, page[:last]) + page[last:]
    return page


def _char(mark: re.Match) -> bytes:
    number = int(mark.group(1)) if mark.group(1) else int(mark.group(2), 16)
    return chr(number if 1 <= number <= 0xD7FF or 0xE000 <= number <= 0x10FFFF else 0xFFFD).encode()


def decoded(text: bytes) -> bytes:
    """Character references to characters, numbers first."""
    if b"&" not in text:
        return text
    return NAMED.sub(lambda m: VALUES[m.group(1)], NUMBERED.sub(_char, text))


def tidy(text: bytes) -> bytes:
    """One blank between words, one line feed between lines, none at the ends."""
    blanks = BLANKS.sub(b" ", text.translate(WHITE).replace(b"\xc2\xa0", b" "))
    return LINES.sub(b"\n", blanks).strip(b" \n")


def plain_text(page: bytes) -> bytes:
    return tidy(decoded(without_tags(without_hidden(without_comments(page)))))


def title(page: bytes, low: bytes) -> bytes:
    """What stands in the first title element."""
    start = low.find(b"<title")
    opened = page.find(b">", start) if start >= 0 else -1
    end = low.find(b"</title", opened + 1) if opened >= 0 else -1
    return tidy(decoded(re.sub(rb"[\r\n]+", b" ", page[opened + 1:end]))) if end >= 0 else b""


def _tags(page: bytes, low: bytes, name: bytes) -> Iterator[tuple[int, int]]:
    """Stretches from a tag of this name to its end; tags begun inside one add nothing to it."""
    at = 0
    while (start := low.find(name, at)) >= 0:
        at = page.find(b">", start)
        at = len(page) if at < 0 else at
        yield start, at


def attribute(page: bytes, low: bytes, name: bytes, pattern: re.Pattern) -> bytes:
    """The last match in the first tag of this name that has one."""
    for start, end in _tags(page, low, name):
        found = [m.group(1) for m in pattern.finditer(page, start + len(name), end)]
        if found:
            return found[-1]
    return b""


def links(page: bytes, low: bytes) -> Iterator[bytes]:
    """Targets of all anchors, in order, decoded and without white space."""
    at = 0
    while (start := low.find(b"<a", at)) >= 0:
        at = start + 2
        if low[at:at + 1] not in (b" ", b"\t", b"\r", b"\n"):
            continue
        end = page.find(b">", at)
        end = len(page) if end < 0 else end
        found = HREF.search(page, at + 1, end)
        if found is None:
            at = end
            continue
        yield re.sub(rb"[ \t\r\n]+", b"", decoded(found.group(1)))
        at = found.end()


def read_page(page: bytes) -> dict:
    low = page.lower()
    return {
        "plain": plain_text(page), "title": title(page, low), "lang": attribute(page, low, b"<html", LANG),
        "charset": attribute(page, low, b"<meta", CHARSET).lower(), "links": list(links(page, low))}
