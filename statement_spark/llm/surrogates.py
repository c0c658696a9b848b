"""Personal data and secrets replaced by keyed surrogates, in DataFrame functions only.

Mentions are found by one pattern. A mention has a type and a canonical form, so that "+1 (212) 555-0100" and
"212.555.0100" are one entity. An entity's surrogate is drawn from a keyed hash of type and canonical form, in the same
format: digits for digits, letters for letters, card numbers with a valid check digit, names in the same script with
the ending of their gender (as the title tells), mail domains below reserved names. Equal entities get equal surrogates
in all documents; no two entities of a type share one and none equals a real entity, which is checked over the whole
corpus: of entities that collide one keeps the draw and the others draw again, with longer names at each turn.

Null texts stay null; texts without mentions, empty ones included, stay as they are. Repeated rows are replaced alike.
All columns of `docs` are kept; `out` holds how many mentions were replaced, by type, in place of a column of that name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.common import boxed, unboxed
from statement_spark.session import staged

MAX_TURNS = 40
# A name's part ends in a letter, without a possessive s; in look-behinds its length has to be bounded.
NAME = r"\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}](?<!['’]s)"
NEAR_NAME = NAME.replace("*", "{0,40}")
IBAN = (r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: ?(?:(?=[A-Z]{0,3}\d)[A-Z0-9]{4}|[A-Z]{4}(?= ?[A-Z]{0,3}\d))){2,7}(?: ?(?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)")
MORE_PARTS = 4  # of a name, after its first
NEAR_PARTS = f"(?:{NEAR_NAME} " * MORE_PARTS + ")?" * MORE_PARTS  # a look-behind takes no repeated groups
MALE = r"(?:Mr|Herrn|Herr|Monsieur|Señor|Sr|Г-н)"
FEMALE = r"(?:Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Г-жа)"
TITLE_WORDS = f"{MALE[3:-1]}|{FEMALE[3:-1]}|Dr|Prof"
TITLE = rf"(?<![\p{{L}}])(?:{TITLE_WORDS})"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
KEY_WORDS = r"(?i:token|secret|passwo?r?d|api[_-]?key|access[_-]?key|auth[_-]?key)"
# Every alternative begins with a test of one character or two, so that the dear look-behinds run at few places.
PATTERNS = {
    "secret": rf"(?<=[\"'=:\s])(?<=[:=]\s{{0,2}}[\"']?)(?<={KEY_WORDS}[\"']?\s{{0,2}}[:=]\s{{0,2}}[\"']?)[A-Za-z0-9_/+.=~-]{{8,}}+"
              r"|(?=[Agsx])\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,})\b",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ip": rf"(?=\d)(?<!\d|\d\.)(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "iban": rf"(?=[A-Z]{{2}}\d)\b{IBAN}\b",
    "card": r"(?=\d)(?<![\d-])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?![\d-])",
    "ssn": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?=[+(\d])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|(?<!\d)\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
             r"|\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d))",
    "name": rf"(?=\p{{Lu}})(?<= )(?<={TITLE}\.? {NEAR_PARTS}){NAME}",
}
MENTION = "|".join(PATTERNS.values())
# what a mention is, told by its own characters; the first that fits
SHAPES = {
    "email": r"^[^@]+@[^@]+$", "ip": rf"^(?:{OCTET}\.){{3}}{OCTET}$", "iban": f"^{IBAN}$", "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "card": r"^\d[\d -]{13,18}$", "phone": r"^[+(\d][\d ().-]{6,}$", "name": rf"^{NAME}$",
}
DIGIT_TYPES = ("card", "ssn", "phone")
# Syllables that generated names are made of, by script.
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ke", "li", "mo", "pa", "ze"],
    "cyrillic": ["ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ке", "ли", "мо", "па", "зе"],
    "greek": ["βα", "δε", "φι", "γο", "λυ", "μα", "νε", "ρι", "σο", "τυ", "πα", "κε", "λι", "μο", "ζα", "θε"],
}
ENDINGS = {
    "latin": {"male": "n", "female": "na", "": "r"}, "cyrillic": {"male": "н", "female": "на", "": "р"},
    "greek": {"male": "ν", "female": "να", "": "ρ"},
}


def _type(mention: Column, before: Column, after: Column) -> Column:
    """The type of a mention; that of a name tells part, gender and script. `before` and `after` are its neighbourhood."""
    plain = F.lit("secret")
    for kind, shape in reversed(SHAPES.items()):
        plain = F.when(mention.rlike(shape), F.lit(kind)).otherwise(plain)
    script = F.when(mention.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(mention.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    parts = rf"\.? (?:{NAME} ){{0,{MORE_PARTS}}}$"
    gender = (F.when(before.rlike(FEMALE + parts), "female").when(before.rlike(MALE + parts), "male")
              .otherwise(""))
    titled = before.rlike(TITLE + parts)
    given = titled & after.rlike(rf"^ {NAME}")
    name = F.when(given, F.concat(F.lit("given:"), gender, F.lit(":"), script)).otherwise(F.concat(F.lit("surname::"), script))
    # a value after "password =" may look like a name; only a title makes it one
    return F.when(plain != "name", plain).when(titled, name).otherwise(F.lit("secret"))


def may_hold(text: Column) -> Column:
    """Cheap test that any text with a mention passes: its marks, or the words that go before names and keys."""
    firsts = "".join(sorted({word[0] for word in TITLE_WORDS.split("|")}))
    return text.rlike(rf"[0-9@:=]|(?=[{firsts}])(?:{TITLE_WORDS})[. ]|(?=[Agsx])(?:AKIA|gh[pousr]_|sk-|xox)")


def mentions(texts: DataFrame, text: str) -> DataFrame:
    """(_key, at, type, mention) of every mention, by its place among those of the text; `texts` has `_key`."""
    # columns of their own, so that the pattern runs twice a text and not for every mention
    split = texts.select(
        "_key", F.regexp_extract_all(F.col(text), F.lit(MENTION), F.lit(0)).alias("found"), F.split(F.col(text), MENTION, -1).alias("gaps"))
    found, gaps = F.col("found"), F.col("gaps")

    def tail(i: Column) -> Column:
        """The end of what stands before mention i, with the mention before it and those that only blanks part from it."""
        out, close = F.right(F.get(gaps, i), F.lit(48)), F.lit(True)
        for k in range(1, MORE_PARTS + 1):
            out = F.concat(F.when(close & (i >= k), F.right(F.get(found, i - k), F.lit(64))).otherwise(F.lit("")), out)
            close = close & (i >= k) & (F.get(gaps, i - (k - 1)) == " ")
            out = F.concat(F.when(close, F.right(F.get(gaps, i - k), F.lit(48))).otherwise(F.lit("")), out)
        return out

    def head(i: Column) -> Column:
        return F.concat(F.left(F.get(gaps, i + 1), F.lit(2)), F.coalesce(F.left(F.get(found, i + 1), F.lit(32)), F.lit("")))

    around = F.transform(found, lambda m, i: F.struct(i.alias("at"), m.alias("mention"), tail(i).alias("before"), head(i).alias("after")))
    return split.select("_key", F.inline(around)).select(
        "_key", "at", _type(F.col("mention"), F.col("before"), F.col("after")).alias("type"), "mention")


def canonical(kind: Column, mention: Column) -> Column:
    digits = F.regexp_replace(mention, r"\D", "")
    dialled = F.regexp_replace(digits, "^00", "")  # a country code tells numbers apart; only that of the ten-digit plan may be left out
    return (
        F.when(kind == "phone", F.when((F.char_length(dialled) == 11) & dialled.startswith("1"), F.right(dialled, F.lit(10))).otherwise(dialled))
        .when(kind.isin(*DIGIT_TYPES), digits).when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).when((kind == "email") | kind.contains(":"), F.lower(mention)).otherwise(mention)
    )


def _number(digest: Column, i: Column) -> Column:
    """A number from 0 to 65535 out of four of the digest's hex digits."""
    return F.conv(F.substring(digest, 4 * i + 1, F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def _same_shape(value: Column, digest: Column) -> Column:
    """Another string with digits, small and capital letters where `value` has them; hex stays hex."""
    hexes, small, capital = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def other(c: Column, i: Column) -> Column:
        n = _number(digest, i)
        return (
            F.when(c.between("0", "9"), _pick("0123456789", n))
            .when(c.between("a", "z"), F.when(hexes, _pick(small[:6], n)).otherwise(_pick(small, n)))
            .when(c.between("A", "Z"), F.when(hexes, _pick(capital[:6], n)).otherwise(_pick(capital, n))).otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), other), "")


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid."""
    reversed_digits = F.split(F.reverse(body), "")
    weighed = F.transform(reversed_digits, lambda c, i: F.when(
        i % 2 == 0, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(c.cast("int")))
    total = F.aggregate(weighed, F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def digest_of(kind: Column, form: Column, key: str, turn: int) -> Column:
    """The keyed hash of an entity at a turn, four hex digits for every character of its form and more."""
    parts = F.sequence(F.lit(0), F.floor(F.char_length(form) / 16).cast("int"))
    return F.array_join(F.transform(parts, lambda p: F.sha2(F.concat_ws(
        "\u0001", F.lit(key), kind, form, F.lit(str(turn)), p.cast("string")), 256)), "")


def draw(kind: Column, form: Column, digest: Column, key: str, turn: int) -> Column:
    """The surrogate of a canonical form at a turn."""
    digits = _same_shape(form, digest)
    body = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(
        i == 0, 1 + _number(digest, i) % 223).otherwise(_number(digest, i) % 256).cast("string")), ".")
    domain = F.substring_index(form, "@", -1)
    host = F.concat(F.lit("m"), F.left(F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain), 256), F.lit(8)), F.lit(".example.org"))
    mail = F.concat(_same_shape(F.substring_index(form, "@", 1), digest), F.lit("@"), host)
    names = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        stem = F.concat(*[F.element_at(F.array(*map(F.lit, syllables)), _number(digest, F.lit(i)) % len(syllables) + 1)
                          for i in range(min(3 + turn, 15))])
        for gender, ending in ENDINGS[script].items():
            names = F.when(kind.endswith(f":{gender}:{script}"), F.initcap(F.concat(stem, F.lit(ending)))).otherwise(names)
    return (
        F.when(kind == "ip", octets).when(kind == "email", mail).when(kind.contains(":"), names)
        .when(kind == "iban", F.concat(F.left(form, F.lit(2)), F.substring(digits, F.lit(3), F.char_length(digits))))
        .when(kind == "card", F.concat(body, _check_digit(body))).otherwise(digits)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(type, form, surrogate) for the distinct (type, form) of `entities`: distinct by type, and no real form."""
    known = staged(entities.select("type", "form").distinct(), "entities")
    real = known.select("type", F.lower("form").alias("drawn")).distinct()
    settled, waiting, turn = None, known, 0
    while settled is None or not waiting.isEmpty():
        if turn >= MAX_TURNS:
            raise ValueError("entities left without a distinct surrogate")
        hashed = waiting.withColumn("digest", digest_of(F.col("type"), F.col("form"), key, turn))
        drawn = hashed.withColumn("surrogate", draw(F.col("type"), F.col("form"), F.col("digest"), key, turn)).select(
            "type", "form", "surrogate", F.lower("surrogate").alias("drawn"))
        free = drawn.join(real, ["type", "drawn"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("type", "drawn"), ["type", "drawn"], "left_anti")
        won = free.groupBy("type", "drawn").agg(F.min_by(F.struct("form", "surrogate"), "form").alias("first")).select(
            "type", "drawn", "first.form", "first.surrogate")
        settled = staged(won if settled is None else settled.unionByName(won), "surrogates")
        waiting = staged(known.join(settled, ["type", "form"], "left_anti"), "waiting")
        turn += 1
    return settled.select("type", "form", "surrogate")


def rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's format: separators, leading digits outside the canonical form, and capitals."""

    def step(state: Column, c: Column) -> Column:
        digit = c.between("0", "9") | ((kind == "iban") & c.between("A", "Z"))
        put = F.when(digit & (state["at"] >= 0), F.substring(surrogate, state["at"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(state["out"], put).alias("out"), (state["at"] + digit.cast("int")).alias("at"))

    before = F.char_length(surrogate) - F.char_length(F.when(kind == "iban", surrogate).otherwise(F.regexp_replace(mention, r"\D", "")))
    filled = F.aggregate(F.split(mention, ""), F.struct(F.lit("").alias("out"), before.alias("at")), step, lambda s: s["out"])
    return (
        F.when(kind.isin(*DIGIT_TYPES, "iban"), filled)
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate)).otherwise(surrogate)
    )


def replace(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", out: str = "replaced") -> DataFrame:
    """`docs` with mentions in `text` replaced, and `out`: map<type, count> (empty if there are none).

    Only rows with mentions are shuffled, by a digest of id and text; rows that agree in both have equal results."""
    body = F.coalesce(F.col(text), F.lit(""))
    has = may_hold(body) & body.rlike(MENTION)
    digest = F.md5(F.concat_ws("\u0001", F.col(doc_id).cast("string"), F.col(text)))
    touched = boxed(docs.where(has), _key=digest, _text=F.col(text))
    places = staged(
        mentions(touched, "_text").withColumn("form", canonical(F.col("type"), F.col("mention"))).distinct(), "mentions")
    named = assign(places, key)
    by_row = places.join(named, ["type", "form"]).select(
        "_key", F.struct("at", "type", rendered(F.col("type"), F.col("mention"), F.col("surrogate")).alias("put"), "mention").alias("p")
    ).groupBy("_key").agg(F.array_sort(F.collect_list("p")).alias("_puts"))
    split = touched.join(by_row, "_key").withColumn("_gaps", F.split(F.col("_text"), MENTION, -1))
    # a found name stands for the same person where it recurs without a title; longer names go first
    names = F.array_sort(F.array_distinct(F.transform(F.filter("_puts", lambda p: p["type"].contains(":")), lambda p: F.struct(
        (-F.char_length(p["mention"])).alias("by"), p["mention"].alias("mention"), p["put"].alias("put"),
        F.substring_index(p["type"], ":", 1).alias("kind")))))
    alone = split.withColumn("_names", F.transform(names, lambda n: F.struct(
        n["put"].alias("put"), n["kind"].alias("kind"),
        F.concat(F.lit(r"(?<![\p{L}\p{M}])"), n["mention"], F.lit(r"(?![\p{L}\p{M}])")).alias("pattern"))))
    gaps = F.when(F.size("_names") == 0, F.col("_gaps")).otherwise(F.transform("_gaps", lambda gap: F.aggregate(
        F.col("_names"), gap, lambda text, n: F.regexp_replace(text, n["pattern"], n["put"]))))
    recurring = F.flatten(F.transform("_names", lambda n: F.array_repeat(
        n["kind"], F.aggregate(F.col("_gaps"), F.lit(0), lambda total, gap: total + F.regexp_count(gap, n["pattern"])))))
    rebuilt = F.array_join(F.zip_with(
        gaps, F.transform("_puts", lambda p: p["put"]), lambda gap, put: F.concat(gap, F.coalesce(put, F.lit("")))), "")
    kinds = F.concat(F.transform("_puts", lambda p: F.substring_index(p["type"], ":", 1)), recurring)
    counts = F.map_from_entries(F.transform(
        F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)))))
    changed = unboxed(alone, docs.columns, **{text: rebuilt, out: counts})
    none = F.create_map().cast("map<string,int>")
    return changed.unionByName(unboxed(boxed(docs.where(~has)), docs.columns, **{out: none}))
