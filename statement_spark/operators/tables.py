"""Financial tables of pages: heading, scale, class, text, and the statement-row reader."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fiscal, numbers, patterns as P, text as T
from ..sources.html import full_text

GAAP = ("income_statement", "balance_sheet", "cash_flow")


def _rx(c: Column, pattern: str) -> Column:
    return c.rlike(P.ci(pattern))


def page_tables(pages: DataFrame) -> DataFrame:
    """One row per table of a segmented page, with its heading and nearest scale caption.

    Everything a table needs from the rest of its page is computed on the page's own row, so
    this is a projection and an explode without a shuffle.
    """
    def last(a: Column) -> Column:
        return F.try_element_at(F.filter(a, lambda x: x.isNotNull()), F.lit(-1))

    captions = F.transform(
        "segments", lambda s: last(F.transform(s["nodes"], T.dominant_scale))
    )
    keys = [c for c in pages.columns if c != "segments"]
    scaled = pages.select(
        *keys, "segments", captions.alias("captions"),
        T.dominant_scale(full_text(F.col("segments"))).alias("doc_scale"),
    )
    shaped = F.filter(
        F.transform("segments", lambda s, i: F.struct(
            i.alias("table_idx"), F.col("doc_scale"),
            last(F.slice("captions", F.lit(1), i + 1)).alias("near_scale"),
            F.array_join(s["heading"], "\n").alias("context"),
            s["rows"].alias("rows"), s["cols"].alias("cols"),
        )),
        lambda t: t["rows"].isNotNull(),
    )
    return scaled.select(*keys, F.inline(shaped))


def markdown(rows: Column) -> Column:
    filled = F.filter(rows, lambda r: F.exists(r, lambda c: c != ""))
    return F.array_join(
        F.transform(filled, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))),
        "\n",
    )


def footnote_share(rows: Column) -> Column:
    """Share of non-empty rows that begin with a footnote marker."""
    lines = F.filter(
        F.transform(rows, lambda r: F.array_join(r, " ")), lambda x: F.trim(x) != ""
    )
    marked = F.filter(lines, lambda x: F.concat(x, F.lit(" ")).rlike(P.FOOTNOTE_ROW))
    return F.when(F.size(lines) > 0, F.size(marked) / F.size(lines)).otherwise(0.0)


def classify(tables: DataFrame) -> DataFrame:
    """Add ``table_type``: a GAAP statement, segment, non_gaap, drop, or other.

    Each pattern is tested once per probe; one ordered choice over the results decides. The
    choice leaves through a one-element explode, so that a filter on the class stays above it
    and does not test the patterns a second time.
    """
    body = F.array_join(F.flatten("rows"), " ")
    ctx = F.col("context")
    probes = (
        tables.withColumn("body", body)
        .withColumn("whole", F.concat(ctx, F.lit(" "), F.col("body")))
        .withColumn("head", F.concat(F.right(ctx, F.lit(P.PROBE_CHARS)), F.lit(" "),
                                     F.substring("body", 1, P.PROBE_CHARS)))
        .withColumn("opening", F.substring("body", 1, P.PROBE_CHARS))
    )

    def statement(c: Column) -> Column:
        return _rx(c, P.INCOME_TABLE) | _rx(c, P.BALANCE_TABLE) | _rx(c, P.CASH_TABLE)

    c = {n: F.col(n) for n in ("whole", "head", "opening")}
    flags = probes.withColumns({
        "ctx_non": _rx(ctx, P.NON_GAAP_TABLE),
        "ctx_seg": _rx(ctx, P.SEGMENT_TABLE),
        "ctx_bank_bs": _rx(ctx, P.BANK_BALANCE_CONTEXT),
        "bank": _rx(c["whole"], P.BANK_TABLE),
        "non": _rx(c["whole"], P.NON_GAAP_TABLE),
        "seg": _rx(c["whole"], P.SEGMENT_TABLE),
    })
    f = F.col
    excused = (
        (~f("ctx_non") & statement(ctx))
        | ((F.trim(ctx) == "") & ~_rx(c["opening"], P.NON_GAAP_TABLE) & statement(c["opening"]))
        | (f("seg") & ~f("ctx_non"))
    )
    kind = (
        F.when(f("ctx_seg") & ~f("ctx_non"), "segment")
        .when(f("bank") & ~f("ctx_bank_bs"), "segment")
        .when(f("non") & ~excused, "non_gaap")
    )
    for probe in ("head", "whole"):
        x = c[probe]
        if probe == "whole":
            kind = kind.when(f("seg"), "segment")
        kind = (
            kind.when(_rx(x, P.INCOME_TABLE), "income_statement")
            .when(_rx(x, P.CASH_TABLE), "cash_flow")
            .when(_rx(x, P.BALANCE_TABLE) & f("bank"), "other")
            .when(_rx(x, P.BALANCE_TABLE), "balance_sheet")
        )
        if probe == "head":
            kind = kind.when(_rx(x, P.SEGMENT_TABLE), "segment")
    kind = (
        kind.when(_rx(c["whole"], P.CONTACT_BLOCK), "drop")
        .when(_rx(c["whole"], P.STOCK_COMP), "drop")
        .when(_rx(ctx, P.GUIDANCE), "drop")
        .when(footnote_share(f("rows")) >= P.FOOTNOTE_SHARE, "drop")
        .otherwise("other")
    )
    return flags.select(*tables.columns, F.explode(F.array(kind)).alias("table_type"))


def entries(tables: DataFrame) -> DataFrame:
    """Add ``section`` and ``entry``: heading and markdown, with a scale caption put in front
    of a GAAP or segment table that names no scale itself."""
    md = markdown(F.col("rows"))
    bare = F.when(F.trim("context") != "", F.concat(F.col("context"), F.lit("\n"), md)).otherwise(md)
    scale = F.coalesce("near_scale", "doc_scale")
    own = bare.rlike(P.ci(P.OWN_SCALE))
    wanted = F.col("table_type").isin(*GAAP, "segment") & ~own & scale.isNotNull()
    entry = F.when(wanted, F.concat(F.lit("(in "), scale, F.lit(")\n"), bare)).otherwise(bare)
    return tables.withColumns({
        "section": F.when(F.col("table_type") == "segment", "other").otherwise(F.col("table_type")),
        "entry": entry,
        "is_gaap": F.col("table_type").isin(*GAAP, "segment"),
    })


def order_key(exhibit: Column, table: Column, row: Column) -> Column:
    """Place of a row in its filing, one number that sorts by exhibit (from 1), table and row: up to 1000 exhibits of a
    million tables of four thousand million rows."""
    wide = lambda c, bits: F.shiftleft(c.cast("bigint"), bits)
    return wide(exhibit - 1, 52) + wide(table, 32) + row


def table_key(exhibit: Column, table: Column) -> Column:
    """Number of a table among all tables of its filing."""
    return (F.shiftleft(exhibit - 1, 20) + table).cast("int")


def read_tables_of_exhibits(tables: DataFrame, filing: str, keep: DataFrame | None = None) -> DataFrame:
    """Tables whose rows are read, over all exhibits of a filing.

    The main exhibit gives income statements, segments and undecided tables, supplements income statements and
    relevant segment tables; a supplement without any gives none. Of the undecided ones a response may say no
    (``keep``: filing, exhibit_no, table_idx, keep), unless that would leave the filing without a table.
    """
    main, kind = F.col("exhibit_no") == 1, F.col("table_type")
    words = F.concat_ws(" ", "context", F.array_join(F.flatten("rows"), " "))
    relevant = ~main & ((kind == "income_statement") | ((kind == "segment") & _rx(words, P.SUPPLEMENT_RELEVANT)))
    chosen = tables.filter(relevant | (main & kind.isin("income_statement", "segment", "other")))
    if keep is None:
        return chosen
    place = [filing, "exhibit_no", "table_idx"]
    pending = (kind == "other") & main
    flags = tables.select(*place, "table_type", relevant.alias("relevant")).join(keep.select(*place, "keep"), place, "left").withColumn(
        "keep", F.coalesce("keep", F.lit(True)))
    per_filing = flags.groupBy(filing).agg(
        F.bool_or((main & kind.isin(*GAAP, "segment")) | F.col("relevant")).alias("has_gaap"), F.bool_or(pending & F.col("keep")).alias("any_kept"))
    out = flags.filter(pending & ~F.col("keep")).join(per_filing.filter("has_gaap or any_kept"), filing, "left_semi").select(*place)
    return chosen.join(out, place, "left_anti")


def selected_entries(tables: DataFrame, filing: str, keep: DataFrame | None = None) -> DataFrame:
    """Entries that go on to extraction, main and supplementary exhibits together.

    The main exhibit gives income statements, segments, and undecided tables unless a response
    (``keep``: filing, table_idx, keep) says no; when that drops them all and no GAAP table was
    found, they all stay. Supplements give income statements and relevant segment tables.
    """
    t = entries(tables.filter(~F.col("table_type").isin("drop", "non_gaap")))
    if "exhibit_no" not in t.columns:
        t = t.withColumn("exhibit_no", F.lit(1))
    main = F.col("exhibit_no") == 1
    pending = main & (F.col("table_type") == "other")
    if keep is not None:
        t = t.join(keep.select(filing, "table_idx", "keep"), [filing, "table_idx"], "left")
    else:
        t = t.withColumn("keep", F.lit(None).cast("boolean"))
    kept = F.coalesce("keep", F.lit(True))
    relevant = ~main & (
        (F.col("table_type") == "income_statement")
        | ((F.col("table_type") == "segment") & _rx(F.col("entry"), P.SUPPLEMENT_RELEVANT))
    )
    per_filing = t.groupBy(filing).agg(
        F.bool_or((main & F.col("is_gaap")) | relevant).alias("has_gaap"),
        F.bool_or(pending & kept).alias("any_kept"),
    )
    t = t.join(per_filing, filing)
    wanted = (
        relevant
        | (main & F.col("section").isin("income_statement", "other") & ~pending)
        | (pending & (kept | (~F.col("any_kept") & ~F.col("has_gaap"))))
    )
    prefix = F.when(~main, F.concat(F.lit("[SUPPLEMENTAL EXHIBIT ("), F.col("exhibit_no"),
                                    F.lit(")] "))).otherwise("")
    return t.filter(wanted).withColumn("entry", F.concat(prefix, "entry")).drop(
        "has_gaap", "any_kept", "keep"
    )


def assembled_text(selected: DataFrame, narrative: DataFrame, filing: str) -> DataFrame:
    """Per filing: entries under section headers, then the narrative."""
    rank = F.when(F.col("section") == "income_statement", 0).otherwise(1)
    label = F.when(rank == 0, P.SECTION_LABELS["income_statement"]).otherwise(
        P.SECTION_LABELS["other"]
    )
    parts = selected.select(
        filing, rank.alias("rank"), "exhibit_no", "table_idx",
        F.concat(F.lit("=== "), label, F.lit(" ===\n"), "entry").alias("part"),
    )
    told = narrative.filter(F.trim("prose") != "").select(
        filing, F.lit(2).alias("rank"), F.lit(1).alias("exhibit_no"), F.lit(0).alias("table_idx"),
        F.concat(F.lit("=== NARRATIVE ===\n"), "prose").alias("part"),
    )
    return parts.unionByName(told).groupBy(filing).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "exhibit_no", "table_idx", "part"))),
                lambda x: x["part"],
            ),
            "\n\n",
        ).alias("raw_text")
    )


def fallback_text(tables: DataFrame, narrative: DataFrame, filing: str) -> DataFrame:
    """Text of a filing without GAAP tables: balance sheets left out, other tables inline."""
    parts = tables.filter("table_type <> 'balance_sheet'").groupBy(filing).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("table_idx", markdown(F.col("rows")).alias("md")))),
            lambda x: x["md"],
        ).alias("mds")
    )
    joined = narrative.join(parts, filing, "left")
    text = F.concat_ws("\n", "prose", F.array_join("mds", "\n"))
    return joined.select(filing, T.strip_boilerplate(text).alias("raw_text"))


def section_counts(tables: DataFrame, *by: str) -> DataFrame:
    return tables.groupBy(*by, "table_type").agg(F.count(F.lit(1)).alias("n_tables"))


# ---- statement-row reader -----------------------------------------------------------------------

def _dash(cell: Column) -> Column:
    return cell.rlike(r"^[-–—]+$")


def _is_year(cell: Column) -> Column:
    return cell.rlike(r"^\s*(19|20)\d{2}\s*$")


def _names_year(cell: Column) -> Column:
    return cell.rlike(r"\b(?:19|20)\d{2}\b")


def _lines(tables: DataFrame, rows: str, cols: Column) -> DataFrame:
    """Add ``lines``: each row's label, its filled cells (text, first column, column behind it, whether it names a year,
    number) and their numbers alone.

    A percentage counts as its number; lone currency and percent signs are no cells. Each step is a column of its own,
    so that no pattern runs twice on a cell.
    """
    blank = r"(?U)^[\s$)%]*$"

    def filled(row: Column, at: Column) -> Column:
        placed = F.transform(row, lambda c, i: F.struct(
            c.alias("text"), F.get(at, i).alias("at"), F.get(at, i + 1).alias("to"), i.alias("i")))
        return F.filter(placed, lambda c: (c["i"] > 0) & ~c["text"].rlike(blank))

    def parsed(c: Column) -> Column:
        percent = F.when(c["text"].contains("%"), F.regexp_replace(c["text"], r"\s*%\s*$", "")).otherwise(c["text"])
        return F.struct(c["text"], c["at"], c["to"], _names_year(c["text"]).alias("dated"), numbers.parse_number(percent).alias("value"))

    def judged(c: Column) -> Column:
        counts = F.when(c["value"].isNotNull(), ~c["dated"] | ~_is_year(c["text"])).otherwise(_dash(c["text"]))
        return F.struct(c["text"], c["at"], c["to"], c["dated"], c["value"], counts.alias("counts"))

    out = tables.withColumn("lines", F.zip_with(rows, cols, lambda row, at: F.struct(
        F.trim(F.coalesce(F.get(row, F.lit(0)), F.lit(""))).alias("label"), filled(row, at).alias("cells"))))
    for step in (parsed, judged):
        out = out.withColumn("lines", F.transform("lines", lambda x: F.struct(x["label"], F.transform(x["cells"], step).alias("cells"))))
    return out.withColumn("lines", F.transform("lines", lambda x: F.struct(
        x["label"], x["cells"], F.transform(x["cells"], lambda c: c["value"]).alias("vals"))))


def read_rows(tables: DataFrame, target_end: Column, annual: Column) -> DataFrame:
    """Every labelled row below a statement's header: row_idx, key, n_cells, raw_value, current_end, is_stale.

    The header rows name the period columns. The current column is the one that ends at ``target_end`` (the latest
    when the header does not name it); of several with that end the longest is taken for an annual filing and the
    shortest otherwise. Where the cells' columns agree with the header's, the value stands below the current
    period; else values are lined up by order with the periods, or with all header cells when a change or note column
    stands among them. A row that fits neither has cells but no value; a row without cells is a parent's label.
    A table whose current period is not that of the filing is stale.
    """
    keys = [c for c in tables.columns if c not in ("rows", "cols")]
    cols = F.col("cols") if "cols" in tables.columns else F.transform(
        "rows", lambda r: F.sequence(F.lit(0), F.size(r)))
    cells = _lines(tables.withColumns({"target_end": target_end, "annual": annual}), "rows", cols)

    def is_data(x: Column) -> Column:
        return (x["label"] != "") & F.exists(x["cells"], lambda c: c["counts"]) & ~F.exists(
            x["cells"], lambda c: c["dated"] & c["value"].isNull())

    first = F.array_position(F.transform("lines", is_data), F.lit(True)).cast("int")
    headed = cells.withColumn("first", F.when(first > 0, first)).withColumn(
        "heads", F.slice("lines", F.lit(1), F.col("first") - 1)).withColumn(
        "header", F.array_join(F.flatten(F.transform(
            "heads", lambda x: F.concat(F.array(x["label"]), F.transform(x["cells"], lambda c: c["text"])))), " | "))
    month = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"
    dated = headed.withColumns({
        "full": F.regexp_extract_all("header", F.lit(P.ci(f"({month}\\s+\\d{{1,2}},?\\s+\\d{{4}})")), F.lit(1)),
        "day": F.regexp_extract("header", P.ci(f"({month}\\s+\\d{{1,2}}),?(?!\\s*\\d{{4}})"), 1),
        "years": F.regexp_extract_all("header", F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)),
        "spans": F.regexp_extract_all(
            "header",
            F.lit(P.ci(r"((?:three|six|nine|twelve|thirteen|twenty-six|thirty-nine|fifty-two"
                       r"|fifty-three|\d{1,2})\s+(?:weeks|months)\s+ended|years?\s+ended)")),
            F.lit(1)),
        "top": F.array_max(F.transform("heads", lambda x: F.struct(
            F.size(F.filter(x["cells"], lambda c: c["dated"])).alias("n"),
            F.transform(x["cells"], lambda c: F.struct(c["at"], c["to"], c["dated"])).alias("cells")))),
    })
    n_dates = F.when(F.size("full") > 0, F.size("full")).otherwise(F.size("years"))

    def days(phrase: Column) -> Column:
        n, unit = fiscal.duration_count(phrase), fiscal.duration_unit(phrase)
        return F.when(unit == "weeks", n * 7).when(unit == "months", n * 30).otherwise(365)

    def column(i: Column) -> Column:
        text = F.when(F.size("full") > 0, F.get("full", i)).when(
            F.col("day") != "", F.concat("day", F.lit(", "), F.get("years", i))
        ).otherwise(F.concat(F.lit("December 31, "), F.get("years", i)))
        span = F.get("spans", F.floor(i * F.size("spans") / F.col("n_dates")).cast("int"))
        return F.struct(
            fiscal.period_end_date(text).alias("end"),
            F.coalesce(days(span), F.lit(0)).alias("days"), i.cast("int").alias("i"),
        )

    timed = dated.withColumn("n_dates", n_dates).withColumn(
        "periods",
        F.when(F.col("n_dates") > 0,
               F.transform(F.sequence(F.lit(0), F.col("n_dates") - 1), column)),
    )
    wanted_end = F.when(
        F.exists("periods", lambda p: p["end"] == F.col("target_end")), F.col("target_end")
    ).otherwise(F.array_max(F.transform("periods", lambda p: p["end"])))
    best = F.array_min(F.transform(
        F.filter("periods", lambda p: p["end"] == F.col("current_end")),
        lambda p: F.struct(F.when(F.col("annual"), -p["days"]).otherwise(p["days"]), p["i"].alias("i")),
    ))
    off = F.abs(F.datediff("current_end", "target_end")) > P.PERIOD_END_TOLERANCE
    told = (F.size("full") > 0) | (F.col("day") != "")
    body = F.slice("lines", F.col("first"), F.size("lines"))
    heads, in_order = F.col("top.cells"), F.filter("top.cells", lambda h: h["dated"])
    aligned = (F.size(in_order) == F.col("n_dates")) & F.forall(body, lambda x: F.forall(
        F.filter(x["cells"], lambda c: c["value"].isNotNull()),
        lambda c: F.exists(heads, lambda h: (h["at"] <= c["at"]) & (c["at"] < h["to"]))))
    places = F.filter(F.transform(heads, lambda h, i: F.when(h["dated"], i)), lambda i: i.isNotNull())
    picked = timed.withColumn("current_end", wanted_end).withColumn("pick", best["i"]).withColumns({
        "aligned": aligned, "below": F.get(in_order, F.col("pick")), "place": F.get(places, F.col("pick")),
        "n_heads": F.size(heads), "n_dated": F.size(in_order), "n_dates": F.coalesce("n_dates", F.lit(0)),
        "is_stale": F.coalesce(off & (told | (F.year("current_end") != F.year("target_end"))), F.lit(False)),
    })
    rows = picked.select(
        *keys, "current_end", "is_stale", "pick", "n_dates", "aligned", "below", "place", "n_heads", "n_dated",
        F.posexplode(body).alias("row_idx", "line"),
    )  # a table without data rows has a null slice and gives none
    values = F.col("line.vals")
    under = F.filter("line.cells", lambda c: c["value"].isNotNull() & (c["at"] >= F.col("below.at")) & (c["at"] < F.col("below.to")))
    value = (
        F.when(F.col("aligned") & F.col("below").isNotNull(), F.get(under, F.lit(0))["value"])
        .when(F.size(values) == F.col("n_dates"), F.get(values, F.col("pick")))
        .when((F.size(values) == F.col("n_heads")) & (F.col("n_dated") == F.col("n_dates")), F.get(values, F.col("place")))
        .when((F.size(values) == 1) & (F.col("n_dates") <= 1), F.get(values, F.lit(0)))
    )
    return rows.filter("line.label <> ''").select(
        *keys, "row_idx", F.col("line.label").alias("key"), F.size("line.cells").alias("n_cells"), "current_end", "is_stale",
        F.explode(F.array(value)).alias("raw_value"),  # once, whatever is filtered on it
    )


def statement_rows(tables: DataFrame, target_end: Column, annual: Column) -> DataFrame:
    """Label and current-period value of every row of a statement that has one."""
    return read_rows(tables, target_end, annual).filter("raw_value is not null").drop("n_cells")


def statement_rejects(tables: DataFrame, target_end: Column, annual: Column) -> DataFrame:
    """Rows with cells from which no value was read."""
    return read_rows(tables, target_end, annual).filter("raw_value is null and n_cells > 0").drop("raw_value")
