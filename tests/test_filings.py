"""Period inference, registry and sinks on small inputs; a hot key against brute force."""
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from statement_spark.operators import periods as PR
from statement_spark.session import staged, work_dir
from statement_spark.sources import filings as FL, sinks
from statement_spark.streaming import streams as ST

SUBS = "cik string, pos bigint, form string, items string, accession string, primary_doc string, report_date date, filing_date date"


def d(s):
    return date.fromisoformat(s) if s else None


def subs(spark, rows):
    return spark.createDataFrame([("c", i, f, "2.02", str(i), "p", d(r), d(x)) for i, (f, r, x) in enumerate(rows)], SUBS)


@pytest.mark.parametrize("rows,end,method", [
    ([("8-K", "2026-05-20", "2026-05-28"), ("10-Q", "2025-04-27", "2025-05-29")], "2026-04-27", "projected"),
    ([("8-K", "2026-06-10", "2026-06-10"), ("10-K", "2025-05-31", "2025-06-18")], "2026-05-31", "projected"),
    ([("8-K", "2026-03-29", "2026-05-01")], "2026-03-29", "unchecked"),
    ([("8-K", "2026-04-30", "2026-05-20"), ("10-Q", "2026-01-31", "2026-03-01")], "2026-04-30", "reported"),
    ([("8-K", "2026-05-20", "2026-05-20"), ("10-Q", "2026-04-30", "2026-05-20")], "2026-04-30", "last_period"),
    ([("8-K", "2026-05-20", "2026-05-20"), ("10-Q", "2026-01-31", "2026-03-01")], "2026-04-20", "estimated"),
    ([("8-K", None, "2026-05-20"), ("10-Q", "2026-01-31", "2026-03-01")], None, None),
    ([("8-K", "2024-02-10", "2024-02-29"), ("10-K", "2022-12-31", "2023-02-28")], "2023-12-31", "projected"),
])
def test_period_end(spark, rows, end, method):
    s = subs(spark, rows)
    got = PR.infer_period_end(s.filter("form = '8-K'"), s).first()
    assert (got.period_end, got.method) == (d(end), method)


def test_fiscal_period_of_8k(spark):
    s = subs(spark, [("8-K", None, "2026-05-01"), ("10-Q", "2026-03-31", "2026-04-25")])
    f = s.filter("form = '8-K'").withColumn("fye_month", F.lit(12))
    got = PR.infer_fiscal_period(f, s).first()
    assert (got.fiscal_year, got.quarter, got.period_type) == (2026, 1, "quarterly")
    s = subs(spark, [("8-K", None, "2026-02-01"), ("10-Q", "2025-09-30", "2025-10-25")])
    got = PR.infer_fiscal_period(s.filter("form = '8-K'").withColumn("fye_month", F.lit(12)), s).first()
    assert (got.fiscal_year, got.quarter) == (2025, 4)


def test_next_filing(spark):
    s = subs(spark, [("8-K", "2026-07-20", "2026-07-20"), ("8-K", "2026-04-20", "2026-04-20")])
    last = spark.createDataFrame([("c", d("2026-03-31")), ("x", d("2026-03-31"))], "cik string, last_end date")
    got = {r.cik: (r.available, r.latest_report_date) for r in PR.next_filing(last, s).collect()}
    assert got == {"c": (True, d("2026-07-20")), "x": (False, None)}


def test_registry_last_wins(spark):
    e = spark.createDataFrame([(0, 320193, "aapl", "Apple"), (1, 5, "dup", "Old"), (2, 6, " DUP ", "New"), (3, 0, "zero", "Z"), (4, 7, None, "N"),
                               (5, 12345678901, "long", "Long")], "pos int, cik_str bigint, ticker string, title string")
    got = {r.ticker: (r.cik, r.title) for r in FL.registry(e).collect()}
    assert got == {"AAPL": ("0000320193", "Apple"), "DUP": ("0000000006", "New"), "LONG": ("12345678901", "Long")}


def test_registry_file(spark):
    path = work_dir(spark, "registry")
    spark.createDataFrame([('{"0": {"cik_str": 1, "ticker": "a", "title": "A"}, "1": {"cik_str": 2, "ticker": "b", "title": "B"}}',)], "value string").coalesce(1).write.text(path)
    got = FL.registry(FL.read_registry(spark, path)).select("ticker", "cik").collect()
    assert sorted((r.ticker, r.cik) for r in got) == [("A", "0000000001"), ("B", "0000000002")]


def test_submissions_pads_short_arrays(spark):
    raw = spark.createDataFrame([("c", '{"recent": {"form": ["8-K", "10-Q"], "items": ["2.02"], "accessionNumber": ["1", "2"], '
                                       '"primaryDocument": [], "reportDate": ["2026-01-31", "bad"], "filingDate": ["2026-02-01"]}}')],
                                "cik string, j string").select(
        "cik", F.from_json("j", FL.SUBMISSION_SCHEMA.split("filings struct<", 1)[1].rsplit(">", 1)[0]).alias("filings"))
    got = FL.submissions(raw).orderBy("pos").collect()
    assert [(r.form, r["items"], r.primary_doc, r.report_date) for r in got] == [
        ("8-K", "2.02", "", d("2026-01-31")), ("10-Q", "", "", None)]


def test_hot_key_asof_and_nearest_match_brute_force(spark):
    """A third of all rows belong to one company; every probe is checked."""
    rows = []
    for i in range(900):
        cik = "hot" if i % 3 == 0 else f"c{i % 40}"
        day = date(2020, 1, 1) + timedelta(days=(i * 37) % 700)
        rows.append((cik, i, ("10-Q", "8-K", "10-K", "8-K", "8-K")[i % 5], "", str(i), "", day - timedelta(days=i % 50), day))
    s = spark.createDataFrame(rows, SUBS)
    probes, periodic = [r for r in rows if r[2] == "8-K"], [r for r in rows if r[2] != "8-K"]
    kinds = "form in ('10-Q', '10-K')"
    asof = PR.asof_previous(s.filter("form = '8-K'"), s.filter(kinds), ["cik"], "filing_date", "report_date",
                            F.struct("report_date", "accession"), F.col("pos"), "p")
    near = PR.nearest_by_day(s.filter("form = '8-K'"), s.filter(kinds), ["cik"], "filing_date", "filing_date",
                             F.struct("accession"), F.col("pos"), 20, "n")
    got_a = {r.accession: r.p.accession if r.p else None for r in asof.collect()}
    got_n = {r.accession: r.n.accession if r.n else None for r in near.collect()}
    assert len(got_a) == len(got_n) == len(probes)
    for p in probes:
        before = [r for r in periodic if r[0] == p[0] and r[6] < p[7]]
        want = min(before, key=lambda r: (-r[6].toordinal(), r[1]))[4] if before else None
        assert got_a[p[4]] == want
        close = [r for r in periodic if r[0] == p[0] and abs((r[7] - p[7]).days) <= 20]
        want = min(close, key=lambda r: (abs((r[7] - p[7]).days), r[1]))[4] if close else None
        assert got_n[p[4]] == want


def test_running_max_in_ranges(spark):
    data = [("hot" if i % 3 else f"k{i % 5}", i, (i * 7919) % 1000) for i in range(500)]
    df = ST.running_max_before(spark.createDataFrame(data, "k string, o int, v int"), "k", "o", "v", "before", 16)
    got = {r.o: r.before for r in df.collect()}
    for k, o, _ in data:
        seen = [v for k2, o2, v in data if k2 == k and o2 < o]
        assert got[o] == (max(seen) if seen else None)


VALUE = ("concept_id string, cik string, form_type string, end_date date, quarter int, value double, created_at timestamp, "
         "period_type string, fiscal_year int")


def value(c, end, q, v, at, t="quarterly"):
    from datetime import datetime
    return (c, "k", "10-Q" if q else "10-K", d(end), q, v, datetime.fromisoformat(at), t, int(end[:4]))


def test_upsert_and_delete(spark):
    path = work_dir(spark, "t")
    first = spark.createDataFrame([value("a", "2025-03-31", 1, 1.0, "2026-01-01"), value("b", "2025-03-31", 1, 2.0, "2026-01-01"),
                                   value("a", "2024-12-31", None, 9.0, "2026-01-01", "annual")], VALUE)
    sinks.upsert_values(spark, first, path)
    again = spark.createDataFrame([value("a", "2025-03-31", 1, 5.0, "2026-01-02"), value("a", "2025-06-30", 2, 6.0, "2026-01-02")], VALUE)
    sinks.upsert_values(spark, again, path)
    sinks.upsert_values(spark, again, path)
    read = lambda: sorted((r.concept_id, str(r.end_date), r.value) for r in spark.read.schema(first.schema).parquet(path).collect())
    assert read() == [("a", "2024-12-31", 9.0), ("a", "2025-03-31", 5.0), ("a", "2025-06-30", 6.0), ("b", "2025-03-31", 2.0)]
    gone = spark.createDataFrame([("k", "quarterly", 2025, 1), ("k", "annual", 2024, None)], "cik string, period_type string, fiscal_year int, quarter int")
    assert sinks.delete_periods(spark, gone, path, first.schema) == 3
    assert read() == [("a", "2025-06-30", 6.0)]


def test_a_load_rewrites_the_buckets_of_its_companies_only(spark):
    path, n = work_dir(spark, "t"), 40
    row = lambda i, v, at: (f"c{i}", f"k{i}", "10-Q", d("2025-03-31"), 1, v, datetime.fromisoformat(at), "quarterly", 2025)
    first = spark.createDataFrame([row(i, 1.0, "2026-01-01") for i in range(n)], VALUE)
    sinks.bucket_count(spark, path, first, ["fiscal_year"], rows_per_bucket=5)
    sinks.upsert_values(spark, first, path)
    assert sinks.bucket_count(spark, path) == 8
    files = lambda: {f.split("bucket=")[1].split("/")[0]: f for f in spark.read.schema(first.schema).parquet(path).inputFiles()}
    before = files()
    sinks.upsert_values(spark, spark.createDataFrame([row(3, 2.0, "2026-01-02")], VALUE), path)
    changed = {b for b, f in files().items() if before[b] != f}
    assert len(before) > 4 and len(changed) == 1
    gone = spark.createDataFrame([("k7", "quarterly", 2025, 1)], "cik string, period_type string, fiscal_year int, quarter int")
    before = files()
    assert sinks.delete_periods(spark, gone, path, first.schema) == 1
    assert len({b for b, f in before.items() if files().get(b) != f}) == 1
    grown = work_dir(spark, "grown")
    sinks.rebucket(spark, path, grown, "cik", sinks.VALUE_PARTITIONS, 16)
    sinks.upsert_values(spark, spark.createDataFrame([row(3, 3.0, "2026-01-03"), row(50, 5.0, "2026-01-03")], VALUE), grown)
    assert sinks.bucket_count(spark, grown) == 16
    got = {r.concept_id: r.value for r in spark.read.schema(first.schema).parquet(grown).collect()}
    assert got == {f"c{i}": 1.0 for i in range(n) if i not in (3, 7)} | {"c3": 3.0, "c50": 5.0}


def test_rejects_of_a_repeated_load(spark):
    path = work_dir(spark, "t")
    rows = spark.createDataFrame([value("a", "2025-03-31", 1, 1.0, "2026-01-01"), (*value("b", "2025-03-31", 1, 2.0, "2026-01-01")[:-1], None)], VALUE)
    for load in (0, 1, 1):
        sinks.upsert_values(spark, rows, path, load)
    assert sorted((r.load, r.concept_id) for r in spark.read.parquet(sinks.rejects_path(path)).collect()) == [(0, "b"), (1, "b")]
    assert spark.read.parquet(path).count() == 1


def test_run_without_id_fails(spark):
    runs = spark.createDataFrame([(None, "T")], "_id string, ticker string")
    with pytest.raises(Exception, match="_id"):
        sinks.upsert_runs(spark, runs, work_dir(spark, "r"))


def test_staged_reads_back(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert staged(df, "s").agg(F.sum("x")).first()[0] == 20
