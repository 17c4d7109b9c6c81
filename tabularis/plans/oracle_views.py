"""DuckDB text of the derived views (the oracle side of ``views.py``).

``with_views(sql, *names)`` prefixes a query with the CTEs it needs, so each oracle
string is self-contained over the pre-registered driver tables.
"""

from __future__ import annotations

LKEY = (
    "CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
    "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) || ':' || "
    "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "v_sales": ((), """v_sales AS (
  SELECT s.s_nationkey AS store, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS weekly_sales
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_nationkey, CAST(date_trunc('week', l.l_shipdate) AS DATE))"""),
    "v_ratings": ((), """v_ratings AS (
  SELECT user_id, item_id, rating,
         CASE WHEN substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), 1, 1) IN ('0','1','2')
              THEN 1 ELSE 0 END AS is_test
  FROM (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
               CAST(floor(1 + least(4.0, l.l_quantity / 10)) AS DOUBLE) AS rating,
               row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
                                  ORDER BY l.l_orderkey DESC, l.l_linenumber DESC, l.l_suppkey DESC, l.l_shipdate DESC) AS rn
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) x
  WHERE rn = 1)"""),
    "v_cust_base": ((), """v_cust_base AS (
  SELECT c.c_custkey AS cust_id, c.c_mktsegment AS segment, c.c_nationkey AS nation, c.c_acctbal AS income,
         CAST(coalesce(o.sp, 0) AS DOUBLE) AS spend_raw
  FROM customer c LEFT JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS sp
                             FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"""),
    "v_cust": (("v_cust_base",), """v_cust AS (
  SELECT *, 1.0 + 99.0 * (spend_raw - (SELECT min(spend_raw) FROM v_cust_base))
            / ((SELECT max(spend_raw) FROM v_cust_base) - (SELECT min(spend_raw) FROM v_cust_base)) AS spending
  FROM v_cust_base)"""),
    "v_loans": ((), """v_loans AS (
  SELECT o.o_orderkey AS loan_id,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_totalprice END AS amount,
         c.c_acctbal AS balance,
         CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
         c.c_mktsegment AS segment,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""),
    "v_dirty": (("v_loans",), """v_dirty AS (
  SELECT * FROM v_loans
  UNION ALL SELECT * FROM v_loans WHERE loan_id % 29 = 0
  UNION ALL SELECT loan_id + 100000000 AS loan_id, -amount AS amount,
                   CASE WHEN loan_id % 37 = 0 THEN CAST('inf' AS DOUBLE) ELSE balance END AS balance,
                   priority, segment, label
            FROM v_loans WHERE loan_id % 31 = 0 OR loan_id % 37 = 0)"""),
    "v_student": ((), f"""v_student AS (
  SELECT {LKEY} AS row_key, l.l_quantity AS quantity, CAST(p.p_size AS DOUBLE) AS size,
         p.p_retailprice AS retail, p.p_type AS ptype, l.l_returnflag AS flag, l.l_extendedprice AS target
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""),
    "v_ops_base": ((), f"""v_ops_base AS (
  SELECT {LKEY} AS row_key, l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'A' THEN 'L' WHEN l_returnflag = 'N' THEN 'M' ELSE 'H' END AS product_type,
         round(295 + 100 * (l_discount + 0.0), 2) AS air_temperature_k,
         round(302.5 + 100 * (l_discount + 0.0) + 50 * (l_tax + 0.0), 2) AS process_temperature_k,
         1200 + 32 * p.p_size AS rotational_speed_rpm,
         round(1.4 * l_quantity, 2) AS torque_nm,
         l_orderkey % 250 AS tool_wear_min
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""),
    "v_ops": (("v_ops_base",), """v_ops AS (
  SELECT row_key, product_type, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min,
         hdf, pwf, osf, twf, rnf, greatest(hdf, pwf, osf, twf, rnf) AS failure
  FROM (SELECT *,
          CAST(process_temperature_k - air_temperature_k < 8.6 AND rotational_speed_rpm < 1300 AS INTEGER) AS hdf,
          CAST(rotational_speed_rpm * 2 * pi() / 60 * torque_nm < 250 OR rotational_speed_rpm * 2 * pi() / 60 * torque_nm > 17500 AS INTEGER) AS pwf,
          CAST(torque_nm * tool_wear_min > CASE WHEN product_type = 'L' THEN 15500 WHEN product_type = 'M' THEN 16000 ELSE 16500 END AS INTEGER) AS osf,
          CAST(tool_wear_min BETWEEN 200 AND 240 AND l_linenumber = 7 AND torque_nm > 50 AS INTEGER) AS twf,
          CAST(l_orderkey % 997 = 0 AS INTEGER) AS rnf
        FROM v_ops_base) f)"""),
    "v_scored": (("v_ops",), """v_scored AS (
  SELECT row_key, product_type, failure AS label,
         round(0.7 * least(1.0, torque_nm * tool_wear_min / 17500)
               + 0.3 * CAST(('0x' || substr(md5(row_key), 1, 4))::INTEGER AS DOUBLE) / 65535, 3) AS score
  FROM v_ops)"""),
    "v_tracks": ((), "v_tracks AS (SELECT vec_id, "
                 + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))
                 + ", label FROM embeddings)"),
    "v_annot": ((), """v_annot AS (
  SELECT l_orderkey AS image_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS line_no,
         'labels/' || CAST(l_orderkey AS VARCHAR) || '.txt' AS file,
         CASE WHEN l_partkey % 101 = 0 THEN 'abc ' || CAST(l_linenumber AS VARCHAR) || ' 0.5 0.1 0.1'
              WHEN l_partkey % 103 = 0 THEN '1 0.5 0.5 0.1'
              WHEN l_partkey % 107 = 0 THEN '3 1.2 0.5 0.1 0.1'
              WHEN l_partkey % 109 = 0 THEN '3 0.2 0.5 0 0.1'
              WHEN l_partkey % 113 = 0 THEN good || chr(13)
              WHEN l_partkey % 127 = 0 THEN chr(9) || good || ' ' || chr(9)
              WHEN l_partkey % 131 = 0 THEN '3 0.5f 0.5 0.1 0.1'
              WHEN l_partkey % 137 = 0 THEN '99999999999 0.5 0.5 0.1 0.1'
              ELSE good END AS value,
         CASE WHEN substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 1) IN ('a','b','c') THEN 'val'
              WHEN substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 1) IN ('d','e','f') THEN 'test'
              ELSE 'train' END AS split
  FROM (SELECT *, CAST(l_suppkey % 45 AS VARCHAR) || ' 0.5 0.25 0.' || lpad(CAST(5 + l_partkey % 40 AS VARCHAR), 2, '0')
               || ' 0.' || lpad(CAST(7 + l_partkey % 53 AS VARCHAR), 2, '0') AS good FROM lineitem) li)"""),
    "v_images": ((), """v_images AS (
  SELECT o_orderkey AS image_id,
         CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) IN ('a','b','c') THEN 'val'
              WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) IN ('d','e','f') THEN 'test'
              ELSE 'train' END AS split
  FROM orders)"""),
}


def _resolve(names: tuple[str, ...], out: list[str]) -> None:
    for n in names:
        deps, _ = CTES[n]
        _resolve(deps, out)
        if n not in out:
            out.append(n)


def with_views(sql: str, *names: str, extra: str | None = None) -> str:
    """``WITH <needed views>[, extra] <sql>``; ``extra`` holds query-specific CTEs."""
    order: list[str] = []
    _resolve(tuple(names), order)
    parts = [CTES[n][1] for n in order]
    if extra:
        parts.append(extra)
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql
