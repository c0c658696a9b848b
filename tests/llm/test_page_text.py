"""Page texts against the plain sequence of patterns, on tag soup; time in proportion on pages of unclosed openings."""
import random
import re
import time

import pytest

from statement_spark.llm import page_text, warc_sql
from statement_spark.llm.warc_patterns import ENTITIES


def by_patterns(page):
    ascii_ = re.ASCII

    def decode(text):
        def char(m):
            n = int(m.group()[3:-1], 16) if m.group()[2] in "xX" else int(m.group()[2:-1])
            return chr(n if 1 <= n <= 0xD7FF or 0xE000 <= n <= 0x10FFFF else 0xFFFD)

        text = re.sub(warc_sql.NUMBERED, char, text)
        for name, value in ENTITIES.items():
            text = text.replace(f"&{name};", value)
        return text

    def tidy(text):
        return re.sub(" ?\n[ \n]*", "\n", re.sub("[ \t\r\f\x0b\xa0]+", " ", text)).strip(" \n")

    text = page
    for pattern, put in warc_sql.STEPS:
        text = re.sub(pattern, put, text, flags=ascii_)
    one = lambda pattern: (m.group(1) if (m := re.search(pattern, page, ascii_)) else "")
    return {
        "plain": tidy(decode(text)), "title": tidy(decode(re.sub("[\r\n]+", " ", one(warc_sql.TITLE)))), "lang": one(warc_sql.LANG),
        "charset": one(warc_sql.CHARSET).lower(), "links": [re.sub("[ \t\r\n]+", "", decode(u)) for u in re.findall(warc_sql.LINK, page, ascii_)]}


PIECES = ["<", ">", "<!--", "-->", "<script>", "<SCRIPT ", "</script >", "</script", "<style>", "</style>", "<template ", "</template>", "<p>", "</P >", "<br/>",
          "<div class='x'", "<a href=\"u&amp;v\">", "<a  HREF='x y'", "<a ", "href=\"z\"", "data-href='w'", "<title>", "<titles", "</title", "</title>", "<html lang='de'>",
          "<html", " lang=\"fr\"", "<meta charset=utf-8>", "<META http='charset=x'", "charset = \"y", "&lt;", "&amp;lt;", "&#38;lt;", "&#x41;", "&#0;", "&#xD800;", "&#9999999;",
          "&copy", "&nbsp;", "\xa0", "\n", " \n ", "  ", "\t", "é漢", "text", "\"", "'", "=", "/", "!", "İ", "\r\n", "\x0b"]


def test_tag_soup():
    rng = random.Random(8)
    for _ in range(6000):
        page = "".join(rng.choices(PIECES, k=rng.randint(0, 25)))
        got = page_text.read_page(page.encode())
        got = {k: [u.decode() for u in v] if k == "links" else v.decode() for k, v in got.items()}
        assert got == by_patterns(page), page


@pytest.mark.parametrize("opening", ["<!--", "<script>", "<script ", "<STYLE>", "<div ", "<a ", "<a href=", "<title", "<title>", "<html ", "<meta charset=", "&", "&#", "<", "<a <p>", "--> <!--"])
def test_unclosed_openings(opening):
    page = (opening * (1_000_000 // len(opening))).encode()
    start = time.perf_counter()
    page_text.read_page(page)
    assert time.perf_counter() - start < 8
