"""Derived input views over the driver tables (see FIXTURES.md §B).

Each view stands in for one of the studied datasets. All are lazy DataFrames; every
aggregate is pre-reduced before it meets a join so the join input shrinks first.
The DuckDB text of the same views lives in ``oracle_views.py``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.functions.keys import hex_prefix_int, lineitem_key
from tabularis.sources.tables import Tables


def v_sales(t: Tables) -> DataFrame:
    """Weekly panel (store, week, weekly_sales): store = supplier nation, week = Monday of ship week."""
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_extendedprice")
    # Partial aggregate at (supplier, week) before the join: the join sees one row per group.
    per_supp = li.groupBy(
        "l_suppkey", F.to_date(F.date_trunc("week", "l_shipdate")).alias("week")
    ).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("s"))
    su = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store"))
    return (
        per_supp.join(su, "l_suppkey")
        .groupBy("store", "week")
        .agg(F.sum("s").cast("double").alias("weekly_sales"))
    )


def v_ratings(t: Tables) -> DataFrame:
    """Long ratings (user_id, item_id, rating, is_test); repeated pairs keep the last line."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    j = li.join(o, "l_orderkey").withColumn(
        "rating", F.floor(F.lit(1) + F.least(F.lit(4.0), F.col("l_quantity") / 10)).cast("double")
    )
    order_key = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    # keep-last as an aggregate (map-side combinable), not a full sort per pair
    kept = j.groupBy("user_id", F.col("l_partkey").alias("item_id")).agg(
        F.max_by("rating", order_key).alias("rating")
    )
    split_hex = F.substring(F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.col("item_id").cast("string"))), 1, 1)
    return kept.withColumn("is_test", F.when(split_hex.isin("0", "1", "2"), 1).otherwise(0))


def v_cust(t: Tables) -> DataFrame:
    """Customer profile: income = account balance, spending scaled to [1, 100]."""
    spend = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("sp")
    )
    c = t.customer.select(
        F.col("c_custkey").alias("cust_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("income"),
    )
    base = c.join(spend, c.cust_id == spend.o_custkey, "left").select(
        "cust_id", "segment", "nation", "income",
        F.coalesce(F.col("sp"), F.lit(0)).cast("double").alias("spend_raw"),
    )
    mn = base.select(F.min("spend_raw")).scalar()
    mx = base.select(F.max("spend_raw")).scalar()
    return base.withColumn("spending", F.lit(1.0) + F.lit(99.0) * (F.col("spend_raw") - mn) / (mx - mn))


def v_loans(t: Tables) -> DataFrame:
    """Loan-like table with injected NULLs (amount on key%17, priority on key%23)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment", "c_nationkey")
    j = o.join(c, "o_custkey")
    return j.select(
        F.col("o_orderkey").alias("loan_id"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("c_acctbal").alias("balance"),
        F.when(F.col("o_orderkey") % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
    )


def v_dirty(t: Tables) -> DataFrame:
    """V_LOANS plus full-row duplicates (key%29) and re-keyed range violations (key%31, key%37)."""
    loans = v_loans(t)
    dups = loans.filter(F.col("loan_id") % 29 == 0)
    bad = loans.filter((F.col("loan_id") % 31 == 0) | (F.col("loan_id") % 37 == 0)).select(
        (F.col("loan_id") + 100000000).alias("loan_id"),
        (-F.col("amount")).alias("amount"),
        F.when(F.col("loan_id") % 37 == 0, F.lit(float("inf"))).otherwise(F.col("balance")).alias("balance"),
        "priority", "segment", "label",
    )
    return loans.unionByName(dups).unionByName(bad)


def v_student(t: Tables) -> DataFrame:
    """Regression table: target = extended price; mixed numeric and string features."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice", "p_type")
    return li.join(p, "l_partkey").select(
        lineitem_key().alias("row_key"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("retail"),
        F.col("p_type").alias("ptype"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").alias("target"),
    )


def v_ops(t: Tables) -> DataFrame:
    """Sensor-style table with failure flags (one row per lineitem)."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag"
    )
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
    j = li.join(p, "l_partkey")
    ptype = F.when(F.col("l_returnflag") == "A", "L").when(F.col("l_returnflag") == "N", "M").otherwise("H")
    air = F.round(F.lit(295) + F.lit(100) * F.col("l_discount"), 2)
    process = F.round(F.lit(302.5) + F.lit(100) * F.col("l_discount") + F.lit(50) * F.col("l_tax"), 2)
    rpm = F.lit(1200) + F.lit(32) * F.col("p_size")
    torque = F.round(F.lit(1.4) * F.col("l_quantity"), 2)
    base = j.select(
        lineitem_key().alias("row_key"),
        "l_orderkey", "l_linenumber",
        ptype.alias("product_type"),
        air.alias("air_temperature_k"),
        process.alias("process_temperature_k"),
        rpm.alias("rotational_speed_rpm"),
        torque.alias("torque_nm"),
        (F.col("l_orderkey") % 250).alias("tool_wear_min"),
    )
    power = F.col("rotational_speed_rpm") * 2 * math.pi / 60 * F.col("torque_nm")
    osf_limit = F.when(F.col("product_type") == "L", 15500).when(F.col("product_type") == "M", 16000).otherwise(16500)
    flags = base.select(
        "*",
        ((F.col("process_temperature_k") - F.col("air_temperature_k") < 8.6) & (F.col("rotational_speed_rpm") < 1300)).cast("int").alias("hdf"),
        ((power < 250) | (power > 17500)).cast("int").alias("pwf"),
        (F.col("torque_nm") * F.col("tool_wear_min") > osf_limit).cast("int").alias("osf"),
        (F.col("tool_wear_min").between(200, 240) & (F.col("l_linenumber") == 7) & (F.col("torque_nm") > 50)).cast("int").alias("twf"),
        (F.col("l_orderkey") % 997 == 0).cast("int").alias("rnf"),
    )
    return flags.withColumn("failure", F.greatest("hdf", "pwf", "osf", "twf", "rnf")).drop("l_orderkey", "l_linenumber")


def v_scored(t: Tables) -> DataFrame:
    """V_OPS with a deterministic score in [0,1] (3 dp, so ties exist) and label = failure."""
    ops = v_ops(t)
    h = hex_prefix_int(F.md5(F.col("row_key")), 4).cast("double")
    raw = F.lit(0.7) * F.least(F.lit(1.0), F.col("torque_nm") * F.col("tool_wear_min") / 17500) + F.lit(0.3) * h / 65535
    return ops.select("row_key", "product_type", F.col("failure").alias("label"), F.round(raw, 3).alias("score"))


def v_tracks(t: Tables) -> DataFrame:
    """Embeddings as 64 double columns f0..f63 + label (wide feature table)."""
    e = t.embeddings
    return e.select(
        F.col("vec_id"),
        *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(64)],
        F.col("label"),
    )


def v_annot(t: Tables) -> DataFrame:
    """One annotation text line per lineitem row: (image_id, line_no, file, value, split)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    pk = F.col("l_partkey")
    size = F.concat(F.lit(" 0.5 0.25 0."), F.lpad((5 + pk % 40).cast("string"), 2, "0"), F.lit(" 0."), F.lpad((7 + pk % 53).cast("string"), 2, "0"))
    good = F.concat((F.col("l_suppkey") % 45).cast("string"), size)
    value = (
        F.when(pk % 101 == 0, F.concat(F.lit("abc "), F.col("l_linenumber").cast("string"), F.lit(" 0.5 0.1 0.1")))
        .when(pk % 103 == 0, F.lit("1 0.5 0.5 0.1"))
        .when(pk % 107 == 0, F.lit("3 1.2 0.5 0.1 0.1"))
        .when(pk % 109 == 0, F.lit("3 0.2 0.5 0 0.1"))
        .when(pk % 113 == 0, F.concat(good, F.lit("\r")))
        .when(pk % 127 == 0, F.concat(F.lit("\t"), good, F.lit(" \t")))
        .when(pk % 131 == 0, F.lit("3 0.5f 0.5 0.1 0.1"))
        .when(pk % 137 == 0, F.lit("99999999999 0.5 0.5 0.1 0.1"))
        .otherwise(good)
    )
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        F.row_number().over(w).alias("line_no"),
        F.concat(F.lit("labels/"), F.col("l_orderkey").cast("string"), F.lit(".txt")).alias("file"),
        value.alias("value"),
        image_split(F.col("l_orderkey")).alias("split"),
    )


def image_split(image_id):
    """train / val / test by the first md5 hex digit of the image id (10/3/3 of 16)."""
    d = F.substring(F.md5(image_id.cast("string")), 1, 1)
    return F.when(d.isin("a", "b", "c"), "val").when(d.isin("d", "e", "f"), "test").otherwise("train")


def v_images(t: Tables) -> DataFrame:
    """Image catalogue: every order is one image (orders without lines are negatives)."""
    return t.orders.select(F.col("o_orderkey").alias("image_id"), image_split(F.col("o_orderkey")).alias("split"))


VIEWS = {
    "v_sales": v_sales,
    "v_ratings": v_ratings,
    "v_cust": v_cust,
    "v_loans": v_loans,
    "v_dirty": v_dirty,
    "v_student": v_student,
    "v_ops": v_ops,
    "v_scored": v_scored,
    "v_tracks": v_tracks,
    "v_annot": v_annot,
    "v_images": v_images,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](Tables(spark, sf_dir))
