"""Scalar column helpers, grouped statistics and samplers as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularis.functions import columns as C
from tabularis.functions.keys import seeded_md5, unit_draw
from tabularis.operators import profile as P
from tabularis.operators import quality as Q
from tabularis.operators import splits as X
from tabularis.plans.common import Tables, round_cols, view
from tabularis.plans.oracle_views import with_views


def derived_columns(spark, sf_dir):
    """One column per helper over the parts' line items."""
    li = Tables(spark, sf_dir).lineitem.join(Tables(spark, sf_dir).part, F.col("l_partkey") == F.col("p_partkey"))
    li = Q.assert_non_negative(li, "l_extendedprice")
    day = F.date_format("l_shipdate", "dd-MM-yyyy")
    d = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.iso_date(C.parse_dmy(day)).alias("ship_day"),
        C.safe_name("p_name", 12).alias("name_key"),
        C.guarded_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        C.residual("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice")).alias("price_gap"),
        Q.label_map("l_returnflag", {"A": "accepted", "N": "none", "R": "returned"}).alias("return_name"),
        Q.to_string_keep_null("l_linenumber").alias("line_text"),
        *[c.alias(n) for c, n in zip(C.poly2(["l_quantity", "l_discount"])[2:], ("qq", "qd", "dd"))],
        C.params_json({"alpha": 1.5, "depth": 3, "name": "x"}).alias("params"),
    )
    return round_cols(d, 6)


def group_stats(spark, sf_dir):
    """A1, A3, A4: means per segment beside the exact median and the global statistics of income."""
    c = view(spark, sf_dir, "v_cust")
    per = P.group_profile(c, "segment", ["income", "spending"]).join(P.median_of(c, "income", by="segment"), "segment")
    whole = P.global_stats(c, "income").first()
    return round_cols(per.withColumns({f"all_{k}": F.lit(whole[k]) for k in ("nunique", "min", "max", "mean", "sum")}), 4)


def shuffled_sample(spark, sf_dir):
    """The first 100 rows of a seeded shuffle, with their draw in [0, 1)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    taken = X.shuffled_take(o, "o_orderkey", 100)
    return taken.withColumn("draw", F.round(unit_draw(seeded_md5(42, F.col("o_orderkey").cast("string"))), 9))


ORACLE = {
    "derived_columns": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
  substr(replace(replace(lower(p_name), ' ', '_'), '/', '_'), 1, 12) AS name_key,
  round(CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity ELSE 0 END, 6) AS unit_price,
  round(l_extendedprice - l_quantity * p_retailprice, 6) AS price_gap,
  CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS return_name,
  CAST(l_linenumber AS VARCHAR) AS line_text, round(l_quantity * l_quantity, 6) AS qq, round(l_quantity * l_discount + 0.0, 6) AS qd,
  round(l_discount * l_discount, 6) AS dd, '{"alpha":1.5,"depth":3,"name":"x"}' AS params
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "group_stats": with_views(
        """SELECT segment, count(*) AS n, round(avg(income), 4) AS avg_income, round(avg(spending), 4) AS avg_spending, round(median(income), 4) AS median,
  (SELECT count(DISTINCT income) FROM v_cust) AS all_nunique, (SELECT round(min(income), 4) FROM v_cust) AS all_min, (SELECT round(max(income), 4) FROM v_cust) AS all_max,
  (SELECT round(avg(income), 4) FROM v_cust) AS all_mean, (SELECT round(sum(income), 4) FROM v_cust) AS all_sum
FROM v_cust GROUP BY segment""",
        "v_cust",
    ),
    "shuffled_sample": """SELECT o_orderkey, o_orderstatus, round(CAST(('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0, 9) AS draw
FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)) LIMIT 100""",
}

QUERIES = {"derived_columns": derived_columns, "group_stats": group_stats, "shuffled_sample": shuffled_sample}
