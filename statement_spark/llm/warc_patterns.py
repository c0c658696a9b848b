"""Fixed values of the WARC derivatives: named characters, tags that hide or break text."""

# Named characters, with what they stand for; the ampersand comes last.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™", "middot": "·",
    "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•",
    "laquo": "«", "raquo": "»", "euro": "€", "pound": "£", "sect": "§", "deg": "°", "times": "×", "eacute": "é", "egrave": "è",
    "agrave": "à", "ccedil": "ç", "auml": "ä", "ouml": "ö", "uuml": "ü", "szlig": "ß", "ntilde": "ñ", "amp": "&",
}
HIDDEN_TAGS = ("script", "style", "noscript", "template")
BLOCK_TAGS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|"
              "html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul")
