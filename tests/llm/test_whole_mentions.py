"""Mentions go as a whole: names of any shape and wherever they recur, account numbers with letters, long secrets."""
import re

from statement_spark.llm import surrogates

SECRET = "aB3_" * 400
CASES = [
    ("Then Mr. O'Brien left, and O'Brien's car stayed.", ["Brien"]),
    ("Ask Dr. McDonald or Dr McDonald again.", ["Donald", "Mc"]),
    ("Mme Anne-Marie Roux est ici; Roux parle.", ["Anne", "Marie", "Roux"]),
    ("Dr. Anna Maria Schmidt and Frau Eva Maria Luise Braun came.", ["Anna", "Maria", "Schmidt", "Eva", "Luise", "Braun"]),
    ("Mrs Anna Weber came. Weber said that Anna and Weberly agree.", ["Anna", "Weber "]),
    ("Pay GB29 NWBK 6016 1331 9268 19 AND wait", ["NWBK", "6016", "1331", "9268", " 19 "]),
    ("Pay NL91ABNA0417164300 now, or IE29AIBK93115212345678.", ["ABNA", "0417164300", "AIBK", "93115212345678"]),
    ("Pay DE89 3704 0044 0532 0130 00 NOW", ["3704", "0044", "0532", "0130"]),
    (f"token = '{SECRET}' end", ["aB3_"]),
    (f"see sk-{'a1B2' * 30} end", ["a1B2a1B2"]),
]
REST = [["left, and", "'s car stayed"], ["Ask Dr. ", "again."], ["est ici; ", "parle."], [" and Frau ", "came."],
        ["came. ", "said that", "and Weberly agree."], ["Pay GB", " AND wait"], ["Pay NL", "now, or IE"], ["Pay DE", " NOW"], ["token = '", "' end"], ["see ", " end"]]


def test_whole_mentions(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in surrogates.replace(docs, "k").collect()}
    for i, (text, gone) in enumerate(CASES):
        new = rows[i]["text"]
        assert not [g for g in gone if g in new.replace("Weberly", "")], (text, new)
        assert all(part in new for part in REST[i]), (text, new)
    assert re.search(r"Mrs (\w+) (\w+) came\. \2 said that \1 and", rows[4]["text"]) and rows[4]["replaced"] == {"given": 2, "surname": 2}
    assert re.search(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d AND", rows[5]["text"]) and rows[5]["replaced"] == {"iban": 1}
    assert len(rows[8]["text"]) == len(CASES[8][0]) and rows[8]["replaced"] == {"secret": 1}


def test_country_codes_tell_phones_apart(spark):
    rows = [(1, "call +1 (212) 555-0100 now"), (2, "call +44 2125550100 now"), (3, "call (212) 555-0100 now"), (4, "call 0044 2125550100 now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: "".join(c for c in r["text"] if c.isdigit()) for r in surrogates.replace(docs, "k").collect()}
    assert out[1][-10:] == out[3][-10:] and out[2][-10:] != out[1][-10:]
