"""Claim, report and alert tables derived from the star-schema test data.

Every row of the source tables takes part; attributes the data lacks (education
date, effect of the education, missing codes) follow from keys and amounts by
fixed rules that SQL can state as well. Enrichment joins happen only for the code
columns asked for, so most queries read ``lineitem`` alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators.features import code_entries
from billshift.operators.weights import INTERCEPT

RUN_DATE = "2001-12-31"
PROVIDER_OFFSET = 3_000_000_000
RETURN_FLAGS = {"A": "A", "B": "N", "DME": "R"}

ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Declared, so that a read starts without a job to infer them.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# Where a line lacks its service code or first diagnosis. The date leaves providers
# educated in the second month without a single complete claim before.
NO_HCPCS = "tax_percent = 8"
NO_DIAGNOSIS = f"(discount_percent = 0 OR {fixed.SERVICE_DATE} < date '1995-02-01')"

# Code column -> SQL over the table that carries it.
LINE_CODES = {
    fixed.HCPCS: (
        f"CASE WHEN NOT ({NO_HCPCS}) THEN concat('Q', cast(cast(l_quantity AS int) AS string)) END"
    ),
    fixed.MODIFIERS[0]: "CASE WHEN l_linestatus = 'F' THEN '' ELSE l_linestatus END",
    fixed.MODIFIERS[1]: "cast(l_linenumber AS string)",
    fixed.PRINCIPAL_DIAGNOSIS: "concat('D', cast(discount_percent AS string))",
    fixed.DIAGNOSES[0]: (
        f"CASE WHEN NOT {NO_DIAGNOSIS} THEN concat('T', cast(tax_percent AS string)) END"
    ),
}
PART_CODES = {
    fixed.DIAGNOSES[1]: "p_type",
    fixed.DIAGNOSES[2]: "p_brand",
    fixed.NUMBERED_PROCEDURES[0]: "cast(p_size AS string)",
    fixed.NUMBERED_PROCEDURES[1]: "split_part(p_name, ' ', 1)",
    fixed.NUMBERED_PROCEDURES[2]: "split_part(p_name, ' ', 2)",
}
ORDER_CODES = {
    fixed.DIAGNOSES[3]: "o_orderpriority",
    fixed.PROCEDURE: "o_orderstatus",
    fixed.NUMBERED_PROCEDURES[4]: "o_orderstatus",
}
CUSTOMER_CODES = {
    fixed.STATE: "n_name",
    fixed.DIAGNOSES[4]: "c_mktsegment",
    fixed.NUMBERED_PROCEDURES[3]: "CASE WHEN c_acctbal < 0 THEN '' ELSE cast(n_regionkey AS string) END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def education_date(supplier_key: str) -> Column:
    """First of a month from 1995 to 2001, spread over the suppliers."""
    months = (F.col(supplier_key) * 31 % 84).cast("int")
    return F.add_months(F.lit("1995-01-01").cast("date"), months)


def claims(
    spark: SparkSession, sf_dir: str, kind: str | None = None, codes: Sequence[str] = ()
) -> DataFrame:
    """Claim lines with provider, type, period and amount, plus ``codes``.

    ``scored`` tells whether a model that skips missing codes could score the line.
    ``kind`` filters on the stored flag, so the scan receives it.
    """
    df = table(spark, sf_dir, "lineitem")
    if kind is not None:
        df = df.where(F.col("l_returnflag") == RETURN_FLAGS[kind])
    # A part's or an order's codes are made before the join, once, and only they are shuffled. Orders come
    # first: lines are at their narrowest when they are shuffled and sorted, and parts may be broadcast.
    of_orders = {**ORDER_CODES, **CUSTOMER_CODES}
    if any(c in of_orders for c in codes):
        orders = table(spark, sf_dir, "orders")
        if any(c in CUSTOMER_CODES for c in codes):
            # Customers first: the smaller join, so claims are shuffled only once more.
            nation = table(spark, sf_dir, "nation")
            customers = table(spark, sf_dir, "customer").join(
                nation, F.col("c_nationkey") == F.col("n_nationkey")
            )
            customers = _coded(customers, "c_custkey", CUSTOMER_CODES, codes)
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        orders = _coded(orders, "o_orderkey", {**ORDER_CODES, **{c: c for c in CUSTOMER_CODES}}, codes)
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if any(c in PART_CODES for c in codes):
        parts = _coded(table(spark, sf_dir, "part"), "p_partkey", PART_CODES, codes)
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"))

    # Two steps: Spark keeps a shared expression of the first one from being repeated.
    claim_type = F.lit(kind) if kind is not None else _claim_type()
    df = df.withColumns(
        {
            fixed.EDUCATION_DATE: education_date("l_suppkey"),
            fixed.SERVICE_DATE: F.col("l_shipdate").cast("date"),
            # Follows the quantity, which is a code too, so that there is something to learn.
            "charge": F.col("l_extendedprice") + F.col("l_quantity") * 2000,
            "tax_percent": (F.col("l_tax") * 100 + 0.5).cast("int"),
            "discount_percent": (F.col("l_discount") * 100 + 0.5).cast("int"),
        }
    ).withColumn(
        "period",
        F.when(F.col(fixed.SERVICE_DATE) >= F.col(fixed.EDUCATION_DATE), "after").otherwise("before"),
    )
    reduced = (F.col("period") == "after") & (F.col("l_suppkey") % 3 == 0)
    return df.select(
        (F.col("l_suppkey") + PROVIDER_OFFSET).alias(fixed.PROVIDER),
        claim_type.alias(fixed.CLAIM_TYPE),
        "period",
        fixed.SERVICE_DATE,
        fixed.EDUCATION_DATE,
        F.when(reduced, F.col("charge") * 0.8).otherwise(F.col("charge")).alias(fixed.AMOUNT),
        F.expr(f"NOT ({NO_HCPCS}) AND NOT {NO_DIAGNOSIS}").alias("scored"),
        F.col("l_quantity"),
        *ROW_KEY,
        *[F.expr(LINE_CODES.get(c, c)).alias(c) for c in codes],
    )


def _coded(df: DataFrame, key: str, expressions: Mapping[str, str], codes: Sequence[str]) -> DataFrame:
    """A side table's key and those of the codes it carries that are asked for."""
    return df.select(key, *[F.expr(expressions[c]).alias(c) for c in dict.fromkeys(codes) if c in expressions])


def _claim_type() -> Column:
    flag = F.col("l_returnflag")
    return F.coalesce(*[F.when(flag == stored, kind) for kind, stored in RETURN_FLAGS.items()])


def estimated(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Claims with a closed-form ``prediction``.

    One least-squares line of amount on quantity per claim type, fitted on the
    claims before education. The coefficients are one row per claim type.
    """
    df = claims(spark, sf_dir, kind)
    lines = (
        df.where((F.col("period") == "before") & F.col(fixed.CLAIM_TYPE).isin(fixed.CLAIM_TYPES))
        .groupBy(fixed.CLAIM_TYPE)
        .agg(
            F.regr_slope(F.col(fixed.AMOUNT), F.col("l_quantity")).alias("slope"),
            F.regr_intercept(F.col(fixed.AMOUNT), F.col("l_quantity")).alias("intercept"),
        )
    )
    # At most one row per fixed claim type, so the broadcast stays three rows.
    return df.join(F.broadcast(lines), fixed.CLAIM_TYPE, "left").select(
        *df.columns,
        (F.col("intercept") + F.col("slope") * F.col("l_quantity")).alias("prediction"),
    )


def code_effects(prepared: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A weights table in closed form: ``position, code, weight`` and the intercept's row.

    A code weighs its claims' mean charge less the mean of all, shared out over the columns and
    rounded to cents. ``prepared``: one type's training frame; a claim counts for the columns
    before its first missing code.
    """
    rows = prepared.where(F.col("label").isNotNull())
    mean = F.lit(rows.agg(F.avg("label")).first()[0])
    codes = rows.select("label", F.inline(code_entries(columns))).groupBy("position", "code").agg(F.avg("label").alias("at"))
    weights = codes.select("position", "code", F.round((F.col("at") - mean) / len(columns), 2).alias("weight"))
    intercept = rows.sparkSession.range(1).select(
        F.lit(INTERCEPT).alias("position"), F.lit(None).cast("string").alias("code"), F.round(mean, 2).alias("weight")
    )
    return weights.unionByName(intercept)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per supplier, and per customer (subjects that were never educated)."""
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias(fixed.REPORT),
        (F.col("s_suppkey") + PROVIDER_OFFSET).cast("string").alias(fixed.SUBJECT),
    )
    customers = table(spark, sf_dir, "customer").select(
        (-F.col("c_custkey") - 1).alias(fixed.REPORT),
        (-F.col("c_custkey") - 1).cast("string").alias(fixed.SUBJECT),
    )
    return suppliers.unionByName(customers)


def most_current_education(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias(fixed.REPORT),
        education_date("s_suppkey").alias(fixed.EDUCATION_DATE),
    )


def all_educated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Educated reports with their last alert, up to 1,000 days before the run."""
    days = F.floor(F.abs(F.col("s_acctbal")) / 10).cast("int")
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias(fixed.REPORT),
        (F.col("s_suppkey") + PROVIDER_OFFSET).cast("string").alias(fixed.SUBJECT),
        F.date_sub(F.lit(RUN_DATE).cast("date"), days).alias(fixed.MAX_ALERT_DATE),
    )


def educated_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports whose education lies far enough back to have claims after it."""
    cutoff = F.date_sub(F.lit(RUN_DATE).cast("date"), 210)
    return (
        most_current_education(spark, sf_dir)
        .where(F.col(fixed.EDUCATION_DATE) <= cutoff)
        .select(fixed.REPORT)
    )


def report_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which alerts concern which report: order lines, repeats included."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + 1).alias(fixed.REPORT), F.col("l_orderkey").alias(fixed.ALERT)
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alert per order; its model is the order's price band and priority."""
    band, priority = F.floor(F.col("o_totalprice") / 20000), F.left("o_orderpriority", F.lit(1)).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(fixed.ALERT),
        (band * 5 + priority - 1).cast("bigint").alias(fixed.MODEL),
        F.col("o_orderdate").cast("date").alias(fixed.ALERT_DATE),
    )


def alert_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models per nation, one for each priority."""
    region = F.col("n_regionkey")
    priority = F.explode(F.sequence(F.lit(0), F.lit(4)))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", priority.alias("p"))
    return nations.select(
        (F.col("n_nationkey") * 5 + F.col("p")).cast("bigint").alias(fixed.MODEL),
        F.when(region <= 2, "Active")
        .when(region == 3, "Inactive")
        .otherwise("Retired")
        .alias(fixed.MODEL_STATUS),
    )


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config entries, several per key; ``p_partkey`` tells which came last."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias(fixed.CONFIG_MODEL),
        F.col("p_brand").alias(fixed.CONFIG_KEY),
        F.col("p_name").alias(fixed.CONFIG_VALUE),
        F.col("p_partkey"),
    )
