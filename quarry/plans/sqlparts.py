"""Shared SQL fragments for oracle statements (DuckDB dialect)."""

TRADE_EDGES = """
trade_edges AS (
  SELECT cn.n_name AS src, sn.n_name AS dst, o.o_orderkey AS order_key, l.l_linenumber AS line,
         l.l_partkey AS item,
         strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') AS start_date,
         strftime(l.l_shipdate, '%-m/%-d/%Y %-H:%M') AS end_date,
         o.o_orderdate AS start_ts, l.l_shipdate AS end_ts
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
)"""

PART_CHAIN_EDGES = """
part_chain_edges AS (
  SELECT src, dst, order_key, line FROM (
    SELECT l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS dst,
           l_orderkey AS order_key, l_linenumber AS line
    FROM lineitem) t
  WHERE dst IS NOT NULL
)"""

RATINGS = """
ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId, CAST(l.l_partkey AS INTEGER) AS movieId,
         CAST(avg(CAST(least(ceil(l.l_quantity / 10), 5) AS DOUBLE)) AS FLOAT) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
