"""Values that follow from other values: roll-ups over the concept tree and identities."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..session import matched
from .concepts import children, parent_path


def role_values(values: DataFrame, concepts: DataFrame, filing: str, order: str) -> DataFrame:
    """One row per filing, one column ``v_<role>`` per role: the first valued concept of it."""
    joined = values.join(matched(concepts.filter("role is not null").select(filing, "concept_id", "role", "concept_ord")),
                         [filing, "concept_id"])
    return joined.groupBy(filing).agg(*[
        F.min_by("value", F.when(F.col("role") == r, F.struct(order, "concept_id"))).alias(f"v_{r}")
        for r in P.ROLES
    ])


def roll_up(values: DataFrame, concepts: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Resolve cost of revenue, gross profit and operating expenses over the concept tree.

    A parent with all children valued takes their sum; else its own value stays. Without one,
    gross profit is revenue less cost, and operating expenses are gross profit less operating
    income. Only concepts that have children are resolved, and children stay.

    ``values``: filing, concept_id, value, key_ord; ``concepts``: filing, concept_id, path,
    concept_ord, role.
    """
    tree = children(concepts, filing)
    kids = tree.join(
        matched(values.select(filing, F.col("concept_id").alias("child_id"), F.col("value").alias("child_value"))),
        [filing, "child_id"], "left",
    ).groupBy(filing, F.col("parent_id").alias("concept_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count("child_value").alias("n_valued"),
        F.sum("child_value").alias("total"),
    )
    wanted = ("cost_of_revenue", "gross_profit", "total_opex")
    parents = concepts.filter(F.col("role").isin(*wanted)).join(matched(kids), [filing, "concept_id"]).join(
        matched(values.select(filing, "concept_id", "value")), [filing, "concept_id"], "left"
    )
    info = F.struct("concept_id", "value", F.when(F.col("n") == F.col("n_valued"), F.col("total")).alias("total"))
    first = parents.groupBy(filing).agg(*[
        F.min_by(info, F.when(F.col("role") == r, F.col("concept_ord"))).alias(r) for r in wanted
    ])
    operands = values.join(
        matched(concepts.filter(F.col("role").isin("revenue", "operating_income")).select(
            filing, "concept_id", "concept_ord", "role")), [filing, "concept_id"],
    ).groupBy(filing).agg(*[
        F.min_by("value", F.when(F.col("role") == r, F.col("concept_ord"))).alias(r)
        for r in ("revenue", "operating_income")
    ])
    wide = first.join(matched(operands), filing, "left")
    cost = F.coalesce("cost_of_revenue.total", "cost_of_revenue.value")
    gross = F.coalesce("gross_profit.value", F.when(
        F.col("gross_profit").isNotNull(), F.col("revenue") - cost))
    opex = F.coalesce("total_opex.total", "total_opex.value", F.when(
        F.col("total_opex").isNotNull(), F.col("g") - F.col("operating_income")))
    solved = wide.withColumn("c", cost).withColumn("g", gross).withColumn("o", opex)
    new = solved.select(filing, F.inline(F.array(*[
        F.struct(F.col(f"{r}.concept_id").alias("concept_id"), F.col(v).alias("new_value"))
        for r, v in zip(wanted, ("c", "g", "o"))
    ]))).filter("concept_id is not null and new_value is not null")
    return values.join(matched(new), [filing, "concept_id"], "full").select(
        filing, "concept_id",
        F.coalesce("new_value", "value").alias("value"),
        F.col("value").isNull().alias("rolled_up"),
        *[c for c in values.columns if c not in (filing, "concept_id", "value")],
    )


def _sum_present(*cols: Column) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(F.coalesce(*cols).isNotNull(), total)


def _bounded(c: Column, limit: float) -> Column:
    return F.when(c.between(-limit, limit), c)


def _per_share(ni: Column, shares: Column) -> Column:
    return _bounded(F.when(shares > 0, ni / F.nullif(shares, F.lit(0.0))), 1000.0)


def _percent(part: Column, whole: Column) -> Column:
    return _bounded(part / F.nullif(whole, F.lit(0.0)) * 100.0, 200.0)


def rules() -> list[tuple[str, Column]]:
    """Ordered (role, formula); a result is an operand of the rules after it."""
    v = {r: F.col(f"v_{r}") for r in P.ROLES}
    items = (v["rd_expense"], v["sm_expense"], v["ga_expense"])
    below = F.coalesce(v["interest_income"], v["interest_expense"], v["other_income_net"])
    return [
        ("gross_profit", v["revenue"] - v["cost_of_revenue"]),
        ("operating_income", v["gross_profit"] - v["total_opex"]),
        ("operating_income", v["gross_profit"] - _sum_present(*items)),
        ("total_opex", v["gross_profit"] - v["operating_income"]),
        ("total_opex", _sum_present(*items)),
        ("pretax_income", F.when(below.isNull(), v["operating_income"])),
        ("net_income", v["pretax_income"] - v["tax_expense"]),
        ("eps_basic", _per_share(v["net_income"], v["shares_basic"])),
        ("eps_diluted", _per_share(v["net_income"], v["shares_diluted"])),
        ("gross_margin_pct", _percent(v["gross_profit"], v["revenue"])),
        ("operating_margin_pct", _percent(v["operating_income"], v["revenue"])),
        ("net_margin_pct", _percent(v["net_income"], v["revenue"])),
    ]


DERIVED_ROLES = list(P.RULE_OPERANDS)


def solve(known: DataFrame, missing: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Known role values plus all values the rules give, one wide row per filing.

    A rule fills its role only where an unmapped concept of the filing wants it, so a value
    nobody asked for is no operand either.
    """
    asked = missing.groupBy(filing).agg(*[
        F.coalesce(F.bool_or(F.col("role") == r), F.lit(False)).alias(f"t_{r}") for r in DERIVED_ROLES
    ])
    return _applied(known.join(matched(asked), filing, "left"))


def _applied(wide: DataFrame) -> DataFrame:
    """The rules in order on rows with ``v_<role>`` (value) and ``t_<role>`` (wanted)."""
    for role, formula in rules():
        name = f"v_{role}"
        valid = F.when(F.col(f"t_{role}") & ~F.isnan(formula), formula)
        wide = wide.withColumn(name, F.coalesce(F.col(name), valid))
    return wide


def derive(values: DataFrame, concepts: DataFrame, filing: str = "filing_id",
           order: str = "key_ord") -> DataFrame:
    """(filing, concept_id, value): values of unmapped concepts that follow from the others."""
    missing = concepts.join(matched(values.select(filing, "concept_id")), [filing, "concept_id"], "left_anti")
    solved = solve(role_values(values, concepts, filing, order), missing, filing)
    by_role = solved.select(filing, F.inline(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(f"v_{r}").alias("value")) for r in DERIVED_ROLES
    ]))).filter("value is not null")
    return missing.filter(F.col("role").isin(*DERIVED_ROLES)).select(filing, "concept_id", "role").join(
        matched(by_role), [filing, "role"]
    ).select(filing, "concept_id", "role", "value")


def gaps(values: DataFrame, concepts: DataFrame, filing: str = "filing_id",
         order: str = "key_ord") -> DataFrame:
    """Concepts whose derivation was blocked, with the operands that are missing."""
    missing = concepts.join(matched(values.select(filing, "concept_id")), [filing, "concept_id"], "left_anti")
    solved = solve(role_values(values, concepts, filing, order), missing, filing)
    lacking = [
        F.struct(
            F.lit(r).alias("role"), F.col(f"v_{r}").alias("value"),
            F.array_compact(F.array(*[
                F.when(F.col(f"v_{o}").isNull(), F.lit(o)) for o in ops
            ])).alias("missing"),
        )
        for r, ops in P.RULE_OPERANDS.items()
    ]
    by_role = solved.select(filing, F.inline(F.array(*lacking))).filter(
        "value is null and size(missing) > 0"
    )
    return missing.select(filing, "concept_id", "role").join(
        matched(by_role.select(filing, "role", "missing")), [filing, "role"]
    )


ROLLED_UP = ("cost_of_revenue", "gross_profit", "total_opex")


def company_trees(concepts: DataFrame) -> DataFrame:
    """One row per company: ``list``, its concepts in order, and ``tree``, per rolled-up role the first parent with the
    ids of its children. A company's dictionary is one filing's worth of rows, whatever the number of filings."""
    item = F.struct("concept_ord", "concept_id", "path", "role")
    lists = concepts.groupBy("cik").agg(F.array_sort(F.collect_list(item)).alias("list"))
    placed = lists.withColumn("ups", F.transform("list", lambda x: F.struct(
        x["concept_id"].alias("id"), parent_path(x["path"]).alias("up"))))

    def first_parent(role: str) -> Column:
        parents = F.transform(
            F.filter("list", lambda x: (x["role"] == role) & (x["path"] != "")),
            lambda x: F.struct(x["concept_id"].alias("id"), F.transform(
                F.filter("ups", lambda k: k["up"] == x["path"]), lambda k: k["id"]).alias("kids")))
        return F.get(F.filter(parents, lambda p: F.size(p["kids"]) > 0), F.lit(0))

    return placed.select("cik", "list", F.struct(*[first_parent(r).alias(r) for r in ROLLED_UP]).alias("tree"))


def resolve(values: DataFrame, trees: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, concept_id, value, derived): mapped values, roll-ups and values by the rules, as ``roll_up`` and ``derive``
    give them, on one row per filing: the values are gathered once, meet their company's tree once, and leave once.

    ``values``: filing, cik, concept_id, value, key_ord, a concept at most once a filing; ``trees``: ``company_trees``.
    """
    filed = values.groupBy(filing, "cik").agg(F.collect_list(F.struct("concept_id", "value", "key_ord")).alias("vals"))
    row = filed.join(matched(trees), "cik", "left")

    def of(concept: Column) -> Column:
        return F.get(F.filter("vals", lambda v: v["concept_id"] == concept), F.lit(0))["value"]

    def first_valued(role: str) -> Column:
        found = F.transform(F.filter("list", lambda x: x["role"] == role), lambda x: of(x["concept_id"]))
        return F.get(F.filter(found, lambda v: v.isNotNull()), F.lit(0))

    row = row.withColumns({
        **{f"own_{r}": of(F.col(f"tree.{r}.id")) for r in ROLLED_UP},
        **{f"kids_{r}": F.transform(F.col(f"tree.{r}.kids"), of) for r in ROLLED_UP},
        "in_revenue": first_valued("revenue"), "in_operating": first_valued("operating_income"),
    })
    total = {r: F.when(F.forall(f"kids_{r}", lambda v: v.isNotNull()),
                       F.aggregate(f"kids_{r}", F.lit(0.0), lambda a, v: a + v)) for r in ROLLED_UP}
    there = {r: F.col(f"tree.{r}").isNotNull() for r in ROLLED_UP}
    row = row.withColumn("new_cost_of_revenue", F.coalesce(total["cost_of_revenue"], F.col("own_cost_of_revenue")))
    row = row.withColumn("new_gross_profit", F.coalesce("own_gross_profit", F.when(
        there["gross_profit"], F.col("in_revenue") - F.col("new_cost_of_revenue"))))
    row = row.withColumn("new_total_opex", F.coalesce(total["total_opex"], F.col("own_total_opex"), F.when(
        there["total_opex"], F.col("new_gross_profit") - F.col("in_operating"))))
    new = F.filter(F.array(*[F.struct(F.col(f"tree.{r}.id").alias("id"), F.col(f"new_{r}").cast("double").alias("value")) for r in ROLLED_UP]),
                   lambda n: n["id"].isNotNull() & n["value"].isNotNull())
    row = row.withColumn("new", new)

    def renewed(concept: Column) -> Column:
        return F.get(F.filter("new", lambda n: n["id"] == concept), F.lit(0))["value"]

    kept = F.transform("vals", lambda v: F.struct(
        v["concept_id"].alias("concept_id"), F.coalesce(renewed(v["concept_id"]), v["value"]).alias("value"),
        v["key_ord"].alias("key_ord"), v["value"].isNull().alias("derived")))
    added = F.transform(
        F.filter("new", lambda n: ~F.exists("vals", lambda v: v["concept_id"] == n["id"])),
        lambda n: F.struct(n["id"].alias("concept_id"), n["value"].alias("value"),
                           F.lit(None).cast(values.schema["key_ord"].dataType).alias("key_ord"), F.lit(True).alias("derived")))
    row = row.withColumn("rolled", F.concat(kept, added))
    row = row.withColumns({
        "roles": F.transform("rolled", lambda v: F.get(F.filter("list", lambda x: x["concept_id"] == v["concept_id"]), F.lit(0))["role"]),
        "missing": F.filter("list", lambda x: ~F.exists("rolled", lambda v: v["concept_id"] == x["concept_id"])),
    })
    ordered = F.array_sort(F.zip_with("rolled", "roles", lambda v, role: F.struct(
        v["key_ord"].alias("key_ord"), v["concept_id"].alias("concept_id"), v["value"].alias("value"), role.alias("role"))))
    row = row.withColumn("ordered", ordered)

    def known_value(role: str) -> Column:
        return F.get(F.filter("ordered", lambda v: v["role"] == role), F.lit(0))["value"]

    def wanted(role: str) -> Column:
        return F.coalesce(F.exists("missing", lambda x: x["role"] == role), F.lit(False))

    known = {f"v_{r}": known_value(r) for r in P.ROLES}
    asked = {f"t_{r}": wanted(r) for r in DERIVED_ROLES}
    solved = _applied(row.select(filing, "rolled", "missing", *[v.alias(k) for k, v in (known | asked).items()]))
    by_role = F.create_map(*[x for r in DERIVED_ROLES for x in (F.lit(r), F.col(f"v_{r}").cast("double"))])
    found = solved.select(filing, "rolled", "missing", by_role.alias("by_role"))
    follows = F.filter(F.transform("missing", lambda x: F.struct(
        x["concept_id"].alias("concept_id"), F.col("by_role")[x["role"]].alias("value"), F.lit(True).alias("derived"))),
        lambda x: x["value"].isNotNull())
    plain = F.transform("rolled", lambda v: F.struct(v["concept_id"], v["value"], v["derived"]))
    return found.select(filing, F.inline(F.concat(plain, F.coalesce(follows, F.slice(plain, 1, 0)))))
