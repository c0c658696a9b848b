"""Company registry, company dimension and filing lists."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fiscal
from ..session import small

SUBMISSION_SCHEMA = (
    "cik string, filings struct<recent struct<form array<string>, items array<string>, "
    "accessionNumber array<string>, primaryDocument array<string>, reportDate array<string>, "
    "filingDate array<string>>>"
)


def normalize_cik(cik: Column) -> Column:
    """Ten digits, zero-padded; a longer number is kept whole."""
    digits = F.regexp_replace(cik.cast("string"), r"^\s*0*(?=\d)", "")
    return F.when(F.length(digits) >= 10, digits).otherwise(F.lpad(digits, 10, "0"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a registry file: one JSON object whose values are the companies."""
    raw = spark.read.text(path, wholetext=True)
    entry = "map<string,struct<cik_str:bigint,ticker:string,title:string>>"
    return raw.select(F.posexplode(F.from_json("value", entry)).alias("pos", "k", "x")).select(
        "pos", "x.cik_str", "x.ticker", "x.title"
    )


def registry(entries: DataFrame) -> DataFrame:
    """(ticker, cik, title): the last entry wins per ticker, and the last title per CIK.

    Both picks are aggregates, so a ticker that occurs often is combined before the shuffle.
    """
    clean = entries.select(
        "pos",
        F.upper(F.trim(F.coalesce("ticker", F.lit("")))).alias("ticker"),
        normalize_cik(F.col("cik_str")).alias("cik"),
        F.trim(F.coalesce("title", F.lit(""))).alias("title"),
        (F.coalesce("cik_str", F.lit(0)) != 0).alias("has_cik"),
    ).filter("has_cik and ticker <> ''")
    by_ticker = clean.groupBy("ticker").agg(F.max_by("cik", "pos").alias("cik"))
    by_cik = clean.groupBy("cik").agg(
        F.max_by("title", "pos").alias("title"), F.max_by("ticker", "pos").alias("cik_ticker")
    )
    return by_ticker.join(by_cik, "cik").select("ticker", "cik", "title", "cik_ticker")


def resolve_companies(wanted: DataFrame, reg: DataFrame) -> DataFrame:
    """Requested ``id_kind`` (ticker or cik) and ``id`` to registry rows; ``found`` tells misses."""
    norm = F.when(F.col("id_kind") == "cik", normalize_cik(F.col("id"))).otherwise(F.upper("id"))
    names = reg.select(F.lit("ticker").alias("id_kind"), F.col("ticker").alias("norm"),
                       "cik", "ticker", "title")
    ciks = reg.filter("ticker = cik_ticker").select(
        F.lit("cik").alias("id_kind"), F.col("cik").alias("norm"), "cik", "ticker", "title"
    )
    return wanted.withColumn("norm", norm).join(
        small(names.unionByName(ciks)), ["id_kind", "norm"], "left"
    ).withColumn("found", F.col("cik").isNotNull()).drop("norm")


def companies(raw: DataFrame) -> DataFrame:
    """Company dimension with the month its fiscal year ends in."""
    code = F.coalesce(F.nullif(F.col("corporate_info.fiscal_year_end"), F.lit("")), F.lit("1231"))
    return raw.select(
        F.col("cik").cast("string").alias("cik"),
        F.upper("ticker_symbol").alias("ticker"),
        F.coalesce("name", "ticker_symbol").alias("name"),
        code.alias("fye_code"),
        fiscal.fye_month(code).alias("fye_month"),
    )


def submissions(raw: DataFrame) -> DataFrame:
    """Parallel arrays of a filing list to rows; what a short array lacks is an empty string."""
    r = "filings.recent."
    names = {
        "form": "form", "items": "items", "accession": "accessionNumber",
        "primary_doc": "primaryDocument", "report_date": "reportDate", "filing_date": "filingDate",
    }
    zipped = F.arrays_zip(*[F.col(r + src).alias(dst) for dst, src in names.items()])
    keys = [c for c in raw.columns if c != "filings"]
    rows = raw.select(*keys, F.posexplode(zipped).alias("pos", "x"))
    return rows.select(
        *keys, "pos",
        *[F.coalesce(F.col(f"x.{n}"), F.lit("")).alias(n) for n in names if "date" not in n],
        *[F.col(f"x.{n}").try_cast("date").alias(n) for n in names if "date" in n],
    ).filter("form <> ''")


def latest_8k(subs: DataFrame, by: str = "cik") -> DataFrame:
    """Newest 8-K with Item 2.02 of each company, else its newest 8-K of any kind."""
    rest = [c for c in subs.columns if c != by]
    order = F.struct(~F.col("items").contains("2.02"), "pos")
    best = subs.filter("form = '8-K'").groupBy(by).agg(F.min_by(F.struct(*rest), order).alias("f"))
    return best.select(by, "f.*")


def primary_url(cik: Column, accession: Column, primary_doc: Column, exhibit: Column) -> Column:
    """First exhibit, else the primary document, else null."""
    folder = F.concat(
        F.lit("https://www.sec.gov/Archives/edgar/data/"),
        F.regexp_replace(cik, r"^0+(?=\d)", ""), F.lit("/"), F.regexp_replace(accession, "-", ""),
    )
    doc = F.when(primary_doc != "", F.concat(folder, F.lit("/"), primary_doc))
    return F.coalesce(exhibit, doc)
