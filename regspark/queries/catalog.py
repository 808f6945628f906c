"""Registered queries over the driver's test tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the same
library operators the registry views use, so the DuckDB oracle
(:mod:`regspark.queries.oracle`) checks the real code. Every query reads the
whole tables; no id subsets or row caps (a limit appears only where top-N is
the feature).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.operators.lookup import attach, lookup
from regspark.operators.preferred import dedup, flag_first, preferred_row
from regspark.queries.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- shared building blocks ---------------------------------------------------

def _preferred_orders(orders: DataFrame) -> DataFrame:
    """W1 on the test tables: per customer, urgent first, then date, then key."""
    return preferred_row(
        orders,
        ["o_custkey"],
        [flag_first("o_orderpriority", "1-URGENT"), "o_orderdate", "o_orderkey"],
    )


def _preferred_customers(customer: DataFrame) -> DataFrame:
    """W2 on the test tables: per company key, first by name."""
    return preferred_row(customer, ["c_custkey"], ["c_name"])


def _with_newcomers(customer: DataFrame) -> DataFrame:
    """All customers, and for every seventh one more company under a key that no
    order has (no branch, no partner)."""
    extra = customer.where(F.col("c_custkey") % 7 == 0).withColumn("c_custkey", -F.col("c_custkey"))
    return customer.unionByName(extra)


def _with_branch(companies: DataFrame, branches: DataFrame, cols: list[str]) -> DataFrame:
    """Company LEFT JOIN its preferred branch on the company key."""
    slim = branches.select(F.col("o_custkey").alias("c_custkey"), *cols)
    return attach(companies, slim, ["c_custkey"])


def _order_date(col: str = "o_orderdate") -> F.Column:
    return F.col(col).cast("date").alias(col)


# --- W1 / W2 / J1 / J2 / J3 / J4 / views ------------------------------------------

@register
def preferred_order(spark: SparkSession, d: str) -> DataFrame:
    pref = _preferred_orders(table(spark, d, "orders"))
    return pref.select(
        "o_custkey", "o_orderkey", _order_date(), "o_orderpriority",
        "o_orderstatus", "o_totalprice",
    )


@register
def preferred_order_context(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer")
    pref = _preferred_orders(table(spark, d, "orders"))
    out = _with_branch(customer, pref, ["o_orderkey", "o_orderdate", "o_orderpriority"])
    out = lookup(out, table(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
                 {"n_name": "nation_name"})
    return out.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        "nation_name", "o_orderkey", _order_date(), "o_orderpriority",
    )


@register
def preferred_company(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer")
    pref = preferred_row(
        customer,
        ["c_nationkey", "c_mktsegment"],
        ["c_name", "c_custkey"],
    )
    return pref.select("c_nationkey", "c_mktsegment", "c_custkey", "c_name")


@register
def preferred_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """J1 with companies that have no branch: every seventh has a twin under an unknown key."""
    pref = _preferred_orders(table(spark, d, "orders"))
    out = _with_branch(_with_newcomers(table(spark, d, "customer")), pref, ["o_orderkey", "o_orderdate"])
    return out.select("c_custkey", "c_name", "o_orderkey", _order_date())


@register
def company_context(spark: SparkSession, d: str) -> DataFrame:
    companies = _preferred_customers(table(spark, d, "customer"))
    pref = _preferred_orders(table(spark, d, "orders"))
    out = _with_branch(
        companies, pref,
        ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"],
    )
    out = lookup(out, table(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
                 {"n_name": "nation_name", "n_regionkey": "region_code"})
    out = lookup(out, table(spark, d, "region"), {"region_code": "r_regionkey"},
                 {"r_name": "region_name"})
    return out.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", "o_orderkey",
        _order_date(), "o_orderpriority", "o_orderstatus", "o_totalprice",
        "nation_name", "region_code", "region_name",
    )


@register
def branch_context(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import full_id

    orders = table(spark, d, "orders")
    out = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        full_id(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"),
                F.col("o_orderstatus")).alias("full_id"),
    )
    out = lookup(out, table(spark, d, "customer"), {"o_custkey": "c_custkey"},
                 {"c_name": "customer_name", "c_nationkey": "nation_code"})
    out = lookup(out, table(spark, d, "nation"), {"nation_code": "n_nationkey"},
                 {"n_name": "nation_name"})
    return out.select(
        "o_orderkey", "o_custkey", "full_id", "o_orderstatus", "o_totalprice",
        _order_date(), "customer_name", "nation_code", "nation_name",
    )


@register
def partner_context(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    out = lookup(lines, table(spark, d, "part"), {"l_partkey": "p_partkey"},
                 {"p_name": "part_name"})
    out = lookup(out, table(spark, d, "supplier"), {"l_suppkey": "s_suppkey"},
                 {"s_name": "supplier_name"})
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "part_name", "l_suppkey",
        "supplier_name", "l_quantity", "l_returnflag",
    )


def _partner_counts(spark: SparkSession, d: str) -> DataFrame:
    """A6 on the test tables: lines per customer.

    Lines are pre-aggregated per order (map-side partial aggregation) before
    the join to orders, so the join shuffles one row per order, not per line.
    """
    per_order = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (
        per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("n").alias("partner_count"))
    )


@register
def consolidated(spark: SparkSession, d: str) -> DataFrame:
    companies = _preferred_customers(_with_newcomers(table(spark, d, "customer")))
    pref = _preferred_orders(table(spark, d, "orders"))
    out = _with_branch(
        companies, pref, ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    )
    out = attach(out, _partner_counts(spark, d), ["c_custkey"])
    out = out.withColumn("partner_count", F.coalesce(F.col("partner_count"), F.lit(0).cast("bigint")))
    out = lookup(out, table(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
                 {"n_name": "nation_name"})
    return out.select(
        "c_custkey", "c_name", "c_mktsegment", "o_orderkey", _order_date(),
        "o_orderpriority", "o_orderstatus", "nation_name", "partner_count",
    )


# --- A1 deduplication -----------------------------------------------------------

@register
def dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return dedup(events, ["user_id", "event_type"]).select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )


# --- P5 / P10 / N1 / P11 / P12 cleansing ----------------------------------------------

# Marker texts injected into the test tables (the data has none of its own).
_MARKERS = ["", "  ", "null", " N/A ", "na", "NaN", "nao aplicavel", "não aplicável"]


def _inject(value: F.Column, selector: F.Column, variants: list[str]) -> F.Column:
    """Replace ``value`` by ``variants[selector]`` for selector < len(variants)."""
    out = F.concat(F.lit(" "), value, F.lit(" "))
    for i in reversed(range(len(variants))):
        out = F.when(selector == i, F.lit(variants[i])).otherwise(out)
    return out


@register
def null_markers(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import null_marker

    n = len(_MARKERS) + 1
    ev = table(spark, d, "events").select(
        F.lit("events").alias("source_table"), F.col("event_id").alias("row_id"),
        _inject(F.col("event_type"), F.col("event_id") % n, _MARKERS).alias("raw_value"),
    )
    docs = table(spark, d, "documents").select(
        F.lit("documents").alias("source_table"), F.col("doc_id").alias("row_id"),
        _inject(F.col("lang"), F.col("doc_id") % n, _MARKERS).alias("raw_value"),
    )
    both = ev.unionByName(docs)
    return both.withColumn("clean_value", null_marker("raw_value"))


@register
def string_tidy(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import tidy

    cust = table(spark, d, "customer").select(
        F.lit("customer").alias("source_table"), F.col("c_custkey").alias("row_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(' "'), "c_name", F.lit('" ')))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("'"), "c_name", F.lit("'")))
        .otherwise(F.concat(F.lit(' " '), "c_name", F.lit(' " '))).alias("raw_value"),
    )
    docs = table(spark, d, "documents").select(
        F.lit("documents").alias("source_table"), F.col("doc_id").alias("row_id"),
        F.col("text").alias("raw_value"),
    )
    return cust.unionByName(docs).withColumn("tidy_value", tidy("raw_value"))


def _brazilian_money(x: F.Column) -> F.Column:
    """1234.5 -> '1.234,50' (thousands '.', decimal ',')."""
    return F.translate(F.format_number(x, 2), ",.", ".,")


@register
def money_parse(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import parse_money

    c = table(spark, d, "customer")
    br = _brazilian_money(F.col("c_acctbal"))
    sel = F.col("c_custkey") % 5
    text = (
        F.when(sel == 0, br)
        .when(sel == 1, F.concat(F.lit("R$ "), br))
        .when(sel == 2, F.expr("format_number(c_acctbal, '0.00')"))
        .when(sel == 3, F.concat(F.lit('"'), br, F.lit('"')))
        .otherwise(F.concat(br, F.lit(".5")))  # malformed: two decimal parts
    )
    return c.select("c_custkey", text.alias("money_text")).withColumn(
        "capital_social", parse_money("money_text")
    )


@register
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import cast_dataset

    raw = F.date_format("o_orderdate", "yyyyMMdd")
    sel = F.col("o_orderkey") % 7
    broken = (
        F.when(sel == 0, F.lit("00000000"))
        .when(sel == 1, F.concat(raw, F.lit("x")))
        .when(sel == 2, F.substring(raw, 1, 7))
        .when(sel == 3, F.concat(F.substring(raw, 1, 6), F.lit("31")))
        .when(sel == 4, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(raw)
    )
    o = table(spark, d, "orders").select("o_orderkey", broken.alias("data_inicio"))
    return cast_dataset(o, money=[], dates=["data_inicio"])


# --- A8 / A9 / A10 / F1 / O1 / A11 / U1 / U2 / O3 rollups --------------------------------

def _orders_by_month(spark: SparkSession, d: str) -> DataFrame:
    from regspark.queries.tables import order_month

    return table(spark, d, "orders").withColumn("data_version", order_month())


@register
def month_distinct(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import distinct_per_month

    return distinct_per_month(_orders_by_month(spark, d), "o_custkey")


@register
def year_month_distinct(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import distinct_per_year_month

    return distinct_per_year_month(_orders_by_month(spark, d), "o_custkey")


@register
def year_filtered_distinct(spark: SparkSession, d: str) -> DataFrame:
    """A9 + F2: the months of one year."""
    from regspark.operators.rollups import distinct_per_year_month

    return distinct_per_year_month(_orders_by_month(spark, d), "o_custkey", year="1996")


@register
def year_distinct(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import distinct_per_year

    return distinct_per_year(_orders_by_month(spark, d), "o_custkey")


@register
def month_slice_top(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import month_slice_top as top

    out = top(_orders_by_month(spark, d), "1997-05", ["o_orderkey"], 100)
    return out.select("o_orderkey", "o_custkey", "data_version", "o_totalprice")


def _flawed_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with derived flaws, so that every rule fails somewhere: missing
    and malformed names, unknown nations, an odd segment, repeated keys."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer").withColumns({
        "c_name": F.when(k % 41 == 0, F.lit(None)).when(k % 43 == 0, F.lit("  ")).when(k % 37 == 0, F.lower("c_name"))
        .otherwise(F.col("c_name")),
        "c_nationkey": F.when(k % 31 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")),
        "c_mktsegment": F.when(k % 29 == 0, F.lit("OTHER")).otherwise(F.col("c_mktsegment")),
    })
    return c.unionByName(c.where(k % 47 == 0))


def _customer_rules(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    """Q6 rules over customers: required, format, valid code, range, domain, unique."""
    from regspark.operators.quality import unique_key_rule

    c = _flawed_customers(spark, d)
    c = lookup(c, table(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
               {"n_nationkey": "__nation_found"})
    c = unique_key_rule(c, ["c_custkey"], "__unique")
    rules = {
        "required_name": F.col("c_name").isNotNull() & (F.trim("c_name") != ""),
        "name_format": F.col("c_name").rlike("^Customer#[0-9]{9}$"),
        "valid_nation": F.col("__nation_found").isNotNull(),
        "balance_range": F.col("c_acctbal").between(0, 10000),
        "segment_domain": F.col("c_mktsegment").isin(
            "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
        "unique_key": F.col("__unique"),
    }
    return c, rules


def _customer_scores(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.quality import score_rules

    c, rules = _customer_rules(spark, d)
    return score_rules(c, rules).select(
        "c_custkey", "c_nationkey", "rules_passed", "rules_total", "quality_score", "quality_band"
    )


@register
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    return _customer_scores(spark, d)


@register
def quality_alerts(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.quality import rule_alerts

    c, rules = _customer_rules(spark, d)
    spec = {
        "required_name": (rules["required_name"], "c_name", "ERROR"),
        "name_format": (rules["name_format"], "c_name", "WARNING"),
        "valid_nation": (rules["valid_nation"], "c_nationkey", "ERROR"),
        "balance_range": (rules["balance_range"], "c_acctbal", "WARNING"),
        "segment_domain": (rules["segment_domain"], "c_mktsegment", "WARNING"),
        "unique_key": (rules["unique_key"], "c_custkey", "CRITICAL"),
    }
    alerts = rule_alerts(c, spec, "c_custkey", created_at=F.lit(None).cast("timestamp"))
    return alerts.drop("created_at")


@register
def state_rollup(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import state_rollup as rollup

    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    # exact decimals: the mean does not depend on the order of the sum
    scores = _customer_scores(spark, d).select(
        "c_custkey", "c_nationkey", F.col("quality_score").cast("decimal(9,6)").alias("quality_score")).distinct()
    o = lookup(o, scores, {"o_custkey": "c_custkey"},
               {"c_nationkey": "nation_code", "quality_score": "quality_score"})
    o = lookup(o, table(spark, d, "nation"), {"nation_code": "n_nationkey"}, {"n_name": "uf"})
    return rollup(o, "uf", "o_custkey", "quality_score")


@register
def table_sizes(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import table_sizes as sizes

    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return sizes({n: table(spark, d, n) for n in names})


@register
def months_present(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.rollups import months_present as present
    from regspark.queries.tables import order_month

    o = table(spark, d, "orders").select(order_month("o_orderdate").alias("data_version"))
    li = table(spark, d, "lineitem").select(order_month("l_shipdate").alias("data_version"))
    return present([o, li])


# --- Q1 / Q6 / A3 / A4 / P9 quality ---------------------------------------------------------

@register
def null_rate(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.quality import key_null_stats

    ev = table(spark, d, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("user_id"))
    )
    return key_null_stats(ev, ["user_id", "event_type"], threshold=90)


@register
def orphan_codes(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.quality import orphans

    code = F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    o = table(spark, d, "orders").select("o_orderkey", code.alias("o_custkey"))
    return orphans(o, table(spark, d, "customer"), {"o_custkey": "c_custkey"})


def _documents_with_bad_chars(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import REPLACEMENT_CHAR

    return table(spark, d, "documents").select(
        "doc_id", "lang",
        F.replace(F.col("text"), F.lit("é"), F.lit(REPLACEMENT_CHAR)).alias("text"),
        F.when(F.col("source") == "src7", F.lit("src" + REPLACEMENT_CHAR))
        .otherwise(F.col("source")).alias("source"),
    )


@register
def bad_char_cells(spark: SparkSession, d: str) -> DataFrame:
    from regspark.functions.cleanse import strip_replacement
    from regspark.operators.quality import replacement_cells, replacement_flags

    docs = _documents_with_bad_chars(spark, d)
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *replacement_flags(["text", "source"]),
        replacement_cells(["text", "source"]),
        F.sum(F.length(strip_replacement("text"))).cast("bigint").alias("clean_chars"),
    )


# --- Q2 / Q3 profiling --------------------------------------------------------------------------

def _flawed_text() -> F.Column:
    """Document texts with derived flaws: mojibake, control characters, U+FFFD."""
    k = F.col("doc_id") % 7
    return (F.when(k == 1, F.concat(F.lit("Ã©Â© "), "text")).when(k == 2, F.concat("text", F.lit("\x01\x02")))
            .when(k == 3, F.concat(F.lit("\ufffd"), "text")).otherwise(F.col("text")))


def _doc_encodings(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.profile import best_encoding

    raw = F.encode(_flawed_text(), "UTF-8")
    # every seventh text ends in a byte that is no UTF-8
    raw = F.when(F.col("doc_id") % 7 == 4, F.concat(raw, F.unhex(F.lit("E9")))).otherwise(raw)
    docs = table(spark, d, "documents").select("doc_id", "source", raw.alias("raw"))
    return best_encoding(docs, "raw").drop("raw")


@register
def encoding_score(spark: SparkSession, d: str) -> DataFrame:
    return _doc_encodings(spark, d)


@register
def encoding_vote(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.profile import encoding_vote as vote

    return vote(_doc_encodings(spark, d), "source")


@register
def folder_encoding_scores(spark: SparkSession, d: str) -> DataFrame:
    """Q2 on files: documents written as text, one folder per language; every
    candidate's summed score over the files of a folder."""
    from regspark.operators.profile import TERMS, file_encodings
    from regspark.session import scratch_path

    base = scratch_path(spark, "encodings")
    table(spark, d, "documents").select("lang", _flawed_text().alias("value")).write.partitionBy("lang").text(base)
    files = file_encodings(spark.read.text(base))
    folder = F.regexp_extract("file_path", "lang=([^/]*)/", 1)
    return files.groupBy(folder.alias("folder"), "encoding").agg(*[F.sum(c).alias(c) for c in ("score", *TERMS)])


@register
def folder_layout_profile(spark: SparkSession, d: str) -> DataFrame:
    """Q3 on files: lines and field counts per folder of written text files."""
    from regspark.operators.profile import file_profile, folder_profile
    from regspark.session import scratch_path

    base = scratch_path(spark, "profile")
    table(spark, d, "documents").select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(base)
    out = folder_profile(file_profile(spark.read.text(base), delimiter=","))
    return out.select(F.regexp_extract("folder", "lang=(.*)$", 1).alias("folder"), "n_lines", "min_fields", "max_fields")


@register
def field_profile(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.profile import text_profile

    docs = table(spark, d, "documents").select("doc_id", "text")
    return text_profile(docs, "text", delimiter=",").drop("text")


# --- K3 / K4 / K1 / K2 sinks ------------------------------------------------------------------

@register
def typed_to_text(spark: SparkSession, d: str) -> DataFrame:
    """S7 + K3 + K4: the target's columns come from the catalog."""
    from regspark.sinks.mart import mart_projection, target_columns

    target = "c_custkey string, c_name string, c_nationkey string, c_mktsegment string, c_comment string"
    spark.createDataFrame([], target).createOrReplaceTempView("mart_customer")
    return mart_projection(table(spark, d, "customer"), target_columns(spark, "mart_customer"))


@register
def month_overwrite_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write all months, replace one with a subset, empty another, read back."""
    from regspark.session import scratch_path
    from regspark.sinks.lake import publish_month, publish_months, read_table

    root = scratch_path(spark, "roundtrip")
    orders = _orders_by_month(spark, d).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "data_version"
    )
    publish_months(orders, root, "gold", "orders")
    replaced = orders.where((F.col("data_version") == "1997-05") & (F.col("o_orderstatus") == "F"))
    publish_month(replaced.drop("data_version"), root, "gold", "orders", "1997-05")
    publish_month(orders.where(F.lit(False)).drop("data_version"), root, "gold", "orders", "1998-01")
    back = read_table(spark, root, "gold", "orders")
    return back.groupBy("data_version").agg(F.count(F.lit(1)).alias("n_orders"))


@register
def manifest_publish(spark: SparkSession, d: str) -> DataFrame:
    """K1/K2/K6 by manifest: a reader planned before a publish keeps its rows, a
    rival publisher of the same month is refused, a dropped month is gone."""
    from regspark.session import scratch_path
    from regspark.sinks.lake import PublishConflict, drop_month, publish_month, publish_months, read_table

    root = scratch_path(spark, "manifest")
    orders = _orders_by_month(spark, d).select("o_orderkey", "o_orderstatus", "data_version")
    publish_months(orders, root, "gold", "orders")
    before = read_table(spark, root, "gold", "orders")
    month = orders.where("data_version = '1997-05'").drop("data_version")
    done: list = []

    def rival() -> None:
        if not done:
            done.append(publish_month(month.where("o_orderstatus = 'F'"), root, "gold", "orders", "1997-05"))

    try:
        publish_month(month.where("o_orderstatus = 'O'"), root, "gold", "orders", "1997-05", meanwhile=rival)
        refused = False
    except PublishConflict:
        refused = True
    dropped = drop_month(spark, root, "gold", "orders", "1998-01", dry_run=True)
    drop_month(spark, root, "gold", "orders", "1998-02")
    old = before.where("data_version <> '1998-02'").groupBy("data_version").agg(F.count(F.lit(1)).alias("n_before"))
    new = read_table(spark, root, "gold", "orders").groupBy("data_version").agg(F.count(F.lit(1)).alias("n_after"))
    return old.join(new, "data_version", "full").select(
        "data_version", "n_before", "n_after", F.lit(refused).alias("rival_refused"), F.lit(dropped).alias("would_drop"))


# --- A12-A19 / O2 run metrics ------------------------------------------------------------------

def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Run table from events: stage = event type, an error event is a failed
    run, duration = value seconds ending at ``ts``, records = user id."""
    e = table(spark, d, "events")
    secs = F.col("value").cast("decimal(18,6)")
    return e.select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.lit("events").alias("dataset"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.date_format("ts", "yyyy-MM").alias("data_version"),
        (F.col("ts") - F.make_dt_interval(secs=secs)).alias("started_at"),
        F.col("ts").alias("finished_at"),
        F.col("value").cast("decimal(12,2)").alias("duration_seconds"),
        F.col("user_id").alias("records"),
        F.when(F.col("event_type") == "error", F.col("event_id") % 11).otherwise(0).alias("records_failed"),
    )


@register
def runs_by_state(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import runs_by

    return runs_by(_runs(spark, d), ["stage", "dataset", "status", "data_version"])


@register
def record_rates(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import record_rates as rates

    return rates(_runs(spark, d), ["stage"])


@register
def recent_failed_runs(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import recent_runs as recent

    return recent(_runs(spark, d), 20, status="failed").select("run_id", "stage", "status", "finished_at")


@register
def recent_critical_alerts(spark: SparkSession, d: str) -> DataFrame:
    """O2 + F5: the newest alerts of one severity; error events are alerts."""
    from regspark.operators.runs import recent_alerts

    alerts = table(spark, d, "events").where(F.col("event_type") == "error").select(
        F.col("event_id").alias("record_line"), F.col("ts").alias("created_at"),
        F.when(F.col("value") >= 100, "CRITICAL").otherwise("WARNING").alias("severity"))
    return recent_alerts(alerts, 20, severity="CRITICAL")


@register
def runs_by_stage(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import runs_by

    return runs_by(_runs(spark, d), ["stage", "dataset"])


@register
def run_rates(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import run_rates as rates

    return rates(_runs(spark, d))


@register
def run_duration_hist(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import duration_histogram

    return duration_histogram(_runs(spark, d), ["stage"])


@register
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import latest_run as latest

    return latest(_runs(spark, d), ["stage", "dataset", "status"])


@register
def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import recent_runs as recent

    return recent(_runs(spark, d), 20).select("run_id", "stage", "status", "finished_at")


@register
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """A13 with one run per user: its events span the run, error events are alerts."""
    from regspark.operators.runs import run_summary as summary

    e = table(spark, d, "events")
    runs = e.groupBy(F.col("user_id").alias("run_id")).agg(
        F.when(F.count_if(F.col("event_type") == "error") > 0, "failed")
        .otherwise("completed").alias("status"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("finished_at"),
    )
    alerts = e.where(F.col("event_type") == "error").select(
        F.col("user_id").alias("run_id"),
        F.when(F.col("value") >= 100, "CRITICAL").otherwise("WARNING").alias("severity"),
    )
    return summary(runs, alerts)


@register
def run_current_state(spark: SparkSession, d: str) -> DataFrame:
    """K10 read side: events as run events (one run per user), the latest
    event of each run is its current state."""
    from regspark.operators.runs import current_runs

    e = table(spark, d, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id"), F.col("ts").alias("event_ts"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
    )
    return current_runs(e).select("run_id", "event_id", "event_ts", "status")


@register
def alert_counts(spark: SparkSession, d: str) -> DataFrame:
    from regspark.operators.runs import alerts_by

    return alerts_by(quality_alerts(spark, d))
