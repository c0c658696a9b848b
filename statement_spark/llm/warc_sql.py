"""The SQL twin of the WARC query, put together from the same patterns."""
from __future__ import annotations

from functools import reduce

from statement_spark.llm.warc_derivatives import BASE32, NO_DATE
from statement_spark.llm.warc_patterns import BLOCK_TAGS, ENTITIES, HIDDEN_TAGS

HIDDEN = [rf"(?is)<{tag}[ \t\r\n>].*?</{tag}[ \t\r\n]*>" for tag in HIDDEN_TAGS]
BLOCK_TAG = rf"(?i)</?(?:{BLOCK_TAGS})(?:[ \t\r\n/][^>]*)?>"
STEPS = [(r"(?s)<!--.*?-->", " "), *[(p, " ") for p in HIDDEN], (BLOCK_TAG, "\n"), (r"<[A-Za-z/!?][^>]*>", "")]
NUMBERED = r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
LINK = r"""(?i)<a[ \t\r\n][^>]*?href[ \t\r\n]*=[ \t\r\n]*["']([^"'>]*)["']"""
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LANG = r"""(?i)<html[^>]*[ \t\r\n]lang[ \t\r\n]*=[ \t\r\n]*["']([^"'>]*)["']"""
CHARSET = r"""(?i)<meta[^>]*charset[ \t\r\n]*=[ \t\r\n]*["']?([A-Za-z0-9_-]+)"""


def lit(text: str) -> str:
    plain = "'" + text.replace("'", "''") + "'"
    for char in "\t\r\f\v\n ":
        plain = plain.replace(char, f"' || chr({ord(char)}) || '")
    return f"({plain})"


def _decoded(text: str) -> str:
    gaps, marks = f"regexp_split_to_array({text}, {lit(NUMBERED)})", f"regexp_extract_all({text}, {lit(NUMBERED)})"
    number = ("CASE WHEN lower(m[3]) = 'x' THEN CAST(('0x' || m[4:-2]) AS BIGINT) ELSE CAST(m[3:-2] AS BIGINT) END")
    char = (f"CASE WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INTEGER)) "
            "ELSE chr(65533) END")
    numbered = (f"CASE WHEN contains({text}, '&#') THEN array_to_string(list_transform(list_zip({gaps}, {marks}), lambda z: z[1] || "
                f"coalesce(list_transform([z[2]], lambda m: {char})[1], '')), '') ELSE {text} END")
    return reduce(lambda t, e: f"replace({t}, {lit(f'&{e[0]};')}, {lit(e[1])})", ENTITIES.items(), f"({numbered})")


def _tidy(text: str) -> str:
    lines = f"regexp_replace({text}, {lit('[ ' + chr(9) + chr(13) + chr(12) + chr(11) + chr(160) + ']+')}, ' ', 'g')"
    return f"trim(regexp_replace({lines}, {lit(' ?' + chr(10) + '[ ' + chr(10) + ']*')}, chr(10), 'g'), ' ' || chr(10))"


def _digest(body: str) -> str:
    number = f"CAST(('0x' || substr(sha1({body}), 5 * i + 1, 5)) AS BIGINT)"
    chars = " || ".join(f"substr('{BASE32}', CAST((({number} >> {shift}) & 31) + 1 AS INTEGER), 1)" for shift in (15, 10, 5, 0))
    return f"'sha1:' || array_to_string(list_transform(range(0, 8), lambda i: {chars}), '')"


def _id(parts: str) -> str:
    h = f"md5({parts})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


def _line(name: str, value: str) -> str:
    return f"coalesce('{name}: ' || {value} || chr(13) || chr(10), '')"


def pages_sql() -> str:
    bare = reduce(lambda t, s: f"regexp_replace({t}, {lit(s[0])}, {lit(s[1])}, 'g')", STEPS, "html")
    title = f"nullif({_tidy(_decoded('t'))}, '')"
    link = f"regexp_replace({_decoded('u')}, {lit('[ ' + chr(9) + chr(13) + chr(10) + ']+')}, '', 'g')"
    fields = " || ".join([
        _line("title", title), _line("lang", f"nullif(regexp_extract(html, {lit(LANG)}, 1), '')"),
        _line("charset", f"nullif(lower(regexp_extract(html, {lit(CHARSET)}, 1)), '')"),
        f"array_to_string(list_transform(regexp_extract_all(html, {lit(LINK)}, 1), lambda u: 'outlink: ' || {link} || chr(13) || chr(10)), '')",
    ])
    header = " || ".join(["'WARC/1.1' || chr(13) || chr(10)"] + [_line(name, value) for name, value in (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"), ("WARC-Payload-Digest", "payload_digest"), ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"), ("Content-Length", "CAST(content_length AS VARCHAR)"))])
    return f"""
WITH p AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS html FROM pages),
s AS (SELECT *, {_digest('html')} AS payload_digest,
             regexp_replace(regexp_extract(html, {lit(TITLE)}, 1), {lit('[' + chr(13) + chr(10) + ']+')}, ' ', 'g') AS t FROM p),
r AS (SELECT *, {_id("concat_ws('|', 'response', CAST(page_id AS VARCHAR), target_uri, payload_digest)")} AS refers_to FROM s),
b AS (
  SELECT page_id, target_uri, payload_digest, refers_to, 'metadata' AS warc_type, 'application/warc-fields' AS content_type, {fields} AS block FROM r
  UNION ALL
  SELECT page_id, target_uri, payload_digest, refers_to, 'conversion', 'text/plain; charset=utf-8', {_tidy(_decoded('bare'))}
  FROM (SELECT *, {bare} AS bare FROM r)),
d AS (
  SELECT *, '{NO_DATE}' AS date, {_id("concat_ws('|', warc_type, refers_to)")} AS record_id,
         octet_length(encode(block)) AS content_length, {_digest('block')} AS block_digest FROM b)
SELECT page_id, warc_type, record_id, refers_to, target_uri, date, content_type, content_length, block_digest, payload_digest,
       {header} AS header, block FROM d
"""
