"""Profiling queries over lineitem, orders and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.common import LINEITEM, big, lineitem, plain, r6, split_events, chain
from riskloom.operators import profile
from riskloom.sources.tables import load_table, preview

QUERIES, SQL = {}, {}

LINEITEM_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
ORDER_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
CUSTOMER_COLUMNS = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
}
NUMBERS = [c for c, k in LINEITEM_COLUMNS.items() if k in ("bigint", "int", "double")]


def _union(columns, row) -> str:
    return "\nUNION ALL ".join(row(c) for c in columns)


# P1
QUERIES["profile_basic_shape"] = lambda s, d: plain(profile.basic_shape(load_table(s, d, "lineitem")))
SQL["profile_basic_shape"] = "SELECT count(*) AS num_rows, CAST(11 AS BIGINT) AS num_columns FROM lineitem"

# P2
QUERIES["profile_column_types"] = lambda s, d: plain(profile.column_types(load_table(s, d, "lineitem")))


def _types_sql(table: str, columns: dict) -> str:
    return _union(
        columns,
        lambda c: f"SELECT '{c}' AS \"column\", '{columns[c]}' AS dtype, count({c}) AS non_null_count, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS unique_count, {r6(f'(count(*) - count({c})) / count(*)', 'null_rate')}, "
        f"{r6(f'count(DISTINCT {c}) / count(*)', 'unique_rate')} FROM {table}",
    )


SQL["profile_column_types"] = _types_sql("lineitem", LINEITEM_COLUMNS)

# P3
QUERIES["profile_feature_groups"] = lambda s, d: plain(profile.feature_groups(load_table(s, d, "orders"), "o_orderstatus"))
SQL["profile_feature_groups"] = _union(
    [c for c in ORDER_COLUMNS if c != "o_orderstatus"],
    lambda c: f"SELECT '{c}' AS \"column\", '{'numeric' if ORDER_COLUMNS[c] in ('bigint', 'double') else 'categorical'}' AS feature_group, "
    f"{'true' if c == 'o_orderdate' else 'false'} AS datetime_like, count(DISTINCT {c}) > 1000 AS high_cardinality, count(DISTINCT {c}) AS unique_count FROM orders",
)


# P4: a projection with copies and missing values
def _overview(s, d):
    df = lineitem(s, d)
    q = F.when(F.col("l_quantity") <= 45, F.col("l_quantity"))
    return df.select("l_returnflag", "l_linestatus", "l_discount", q.alias("quantity"), "fraud")


QUERIES["profile_dataset_overview"] = lambda s, d: plain(profile.dataset_overview(_overview(s, d)))
SQL["profile_dataset_overview"] = f"""
WITH li AS ({LINEITEM}),
t AS (SELECT l_returnflag, l_linestatus, l_discount, CASE WHEN l_quantity <= 45 THEN l_quantity END AS quantity, fraud FROM li),
u AS (SELECT DISTINCT * FROM t),
n AS (SELECT count(*) AS rows, count(*) FILTER (quantity IS NULL) AS missing, sum(fraud) AS s FROM t)
SELECT rows AS num_rows, CAST(5 AS BIGINT) AS num_columns, rows - (SELECT count(*) FROM u) AS duplicate_rows,
  {r6('(rows - (SELECT count(*) FROM u)) / rows', 'duplicate_rate')}, missing AS total_missing_values,
  {r6('missing / (rows * 5)', 'total_missing_rate')}, 'fraud' AS target_column, {big('s', 'fraud_count')},
  {big('rows - s', 'non_fraud_count')}, {r6('s / rows', 'fraud_rate')} FROM n"""

# P5
QUERIES["profile_target_distribution"] = lambda s, d: plain(profile.target_distribution(lineitem(s, d)))
SQL["profile_target_distribution"] = f"""
WITH li AS ({LINEITEM})
SELECT {big('fraud', 'fraud')}, count(*) AS count, {r6('count(*) / (SELECT count(*) FROM li)', 'rate')} FROM li GROUP BY fraud"""


# P6
def _holes(s, d):
    o = load_table(s, d, "orders")
    return o.withColumns(
        {
            "o_totalprice": F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")),
            "o_orderpriority": F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        }
    )


_HOLES = """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS o_totalprice,
 o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders"""
QUERIES["profile_missing_report"] = lambda s, d: plain(profile.missing_report(_holes(s, d)))
SQL["profile_missing_report"] = f"WITH t AS ({_HOLES})\n" + _union(
    ORDER_COLUMNS,
    lambda c: f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, {r6(f'(count(*) - count({c})) / count(*)', 'missing_rate')}, count({c}) AS non_missing_count FROM t",
)

# P7
QUERIES["profile_column_overview"] = lambda s, d: plain(profile.column_overview(load_table(s, d, "customer")))
SQL["profile_column_overview"] = (
    "WITH t AS ("
    + _types_sql("customer", CUSTOMER_COLUMNS)
    + "), v AS ("
    + _union(CUSTOMER_COLUMNS, lambda c: f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM customer WHERE {c} IS NOT NULL")
    + "), r AS (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY v) AS rn FROM v),"
    " l AS (SELECT \"column\", string_agg(v, ', ' ORDER BY v) AS sample_values FROM r WHERE rn <= 5 GROUP BY 1)"
    " SELECT t.*, coalesce(sample_values, '') AS sample_values FROM t LEFT JOIN l USING (\"column\")"
)

# P8
QUERIES["profile_numeric_summary"] = lambda s, d: plain(profile.numeric_summary(load_table(s, d, "lineitem")))
SQL["profile_numeric_summary"] = _union(
    NUMBERS,
    lambda c: f"SELECT '{c}' AS \"column\", count({c}) AS count, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')}, {r6(f'min({c})', 'min')}, "
    + ", ".join(r6(f"quantile_cont(CAST({c} AS DOUBLE), {q})", n) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
    + f", {r6(f'max({c})', 'max')}, count(*) - count({c}) AS missing_count, {r6(f'(count(*) - count({c})) / count(*)', 'missing_rate')}, {r6(f'skewness({c})', 'skewness')} FROM lineitem",
)

# P9
QUERIES["profile_categorical_summary"] = lambda s, d: plain(profile.categorical_summary(_holes(s, d)))


def _categorical(c: str) -> str:
    return f"""(WITH n AS (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM t GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY k DESC, v ASC NULLS LAST) AS rn FROM n)
SELECT '{c}' AS "column", '{ORDER_COLUMNS[c]}' AS dtype, count(v) AS unique_count,
  CAST(coalesce(sum(k) FILTER (v IS NULL), 0) AS BIGINT) AS missing_count,
  {r6('coalesce(sum(k) FILTER (v IS NULL), 0) / sum(k)', 'missing_rate')},
  (SELECT string_agg(coalesce(v, 'nan') || ': ' || k, '; ' ORDER BY rn) FROM r WHERE rn <= 10) AS top_values FROM n)"""


SQL["profile_categorical_summary"] = f"WITH t AS ({_HOLES})\n" + _union(["o_orderstatus", "o_orderdate", "o_orderpriority"], _categorical)

# P10
QUERIES["profile_high_cardinality"] = lambda s, d: plain(profile.high_cardinality_report(load_table(s, d, "lineitem"), target="l_returnflag"))
SQL["profile_high_cardinality"] = (
    "SELECT \"column\", dtype, unique_count, unique_rate, 'high cardinality: do not one-hot as it is' AS note FROM ("
    + _types_sql("lineitem", LINEITEM_COLUMNS)
    + ") WHERE unique_count >= 1000 AND \"column\" <> 'l_returnflag'"
)

# P11
QUERIES["profile_rate_by_category"] = lambda s, d: plain(profile.rate_by_category(lineitem(s, d), "l_quantity"))
SQL["profile_rate_by_category"] = f"""
WITH li AS ({LINEITEM})
SELECT {r6('l_quantity', 'l_quantity')}, count(*) AS count, {r6('CAST(sum(fraud) AS DOUBLE)', 'fraud_count')}, {r6('avg(fraud)', 'fraud_rate')}
FROM li GROUP BY li.l_quantity HAVING count(*) >= 30"""

# P12
QUERIES["profile_correlation_pairs"] = lambda s, d: plain(profile.correlation_pairs(load_table(s, d, "lineitem")))
SQL["profile_correlation_pairs"] = _union(
    [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]],
    lambda p: f"SELECT '{p[0]}' AS feature_a, '{p[1]}' AS feature_b, {r6(f'abs(corr({p[0]}, {p[1]}))', 'abs_correlation')} FROM lineitem",
)

# P13
QUERIES["profile_histogram"] = lambda s, d: plain(profile.histogram(load_table(s, d, "lineitem"), "l_extendedprice"))
SQL["profile_histogram"] = f"""
WITH m AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 49) AS BIGINT) AS bin_id, count(*) AS n FROM lineitem, m GROUP BY 1)
SELECT g AS bin_id, {r6('lo + w * g', 'bin_start')}, {r6('lo + w * (g + 1)', 'bin_end')}, coalesce(n, 0) AS count
FROM range(50) r(g) CROSS JOIN m LEFT JOIN c ON c.bin_id = g"""

# P14
_LIFT = "{value}, count(*) AS count, {s}, {rate}, {lift}"


def _lift_sql(source: str, column: str, least: int) -> str:
    return f"""
SELECT {column}, count(*) AS count, {r6('CAST(sum(fraud) AS DOUBLE)', 'fraud_count')}, {r6('avg(fraud)', 'fraud_rate')},
  {r6(f'avg(fraud) / (SELECT avg(fraud) FROM {source})', 'lift')}
FROM {source} GROUP BY 1 HAVING count(*) >= {least}"""


QUERIES["profile_lift_table"] = lambda s, d: plain(profile.lift_table(lineitem(s, d), "l_suppkey"))
SQL["profile_lift_table"] = f"WITH li AS ({LINEITEM})" + _lift_sql("li", "l_suppkey AS value", 50)

_DECILES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
QUERIES["profile_decile_lift"] = lambda s, d: plain(profile.decile_lift_table(lineitem(s, d), "l_extendedprice"))
SQL["profile_decile_lift"] = f"""
WITH li AS ({LINEITEM}), e AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, {_DECILES}))) AS e FROM li),
b AS (SELECT CAST(greatest(len(list_filter(e, lambda x: x < l_extendedprice)) - 1, 0) AS BIGINT) AS bin_id, fraud FROM li, e)""" + _lift_sql("b", "bin_id", 1)

# P16
QUERIES["profile_class_ratio"] = lambda s, d: plain(profile.class_ratio(split_events(s, d)))
SQL["profile_class_ratio"] = chain(
    f"SELECT split, {big('fraud', 'fraud')}, count(*) AS count, {r6('count(*) / sum(count(*)) OVER (PARTITION BY split)', 'ratio')} FROM sev GROUP BY split, fraud"
)

# S7
QUERIES["preview_rows"] = lambda s, d: plain(preview(load_table(s, d, "orders"), 20, [F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "o_totalprice", "o_orderstatus"))
SQL["preview_rows"] = f"SELECT o_orderkey, {r6('o_totalprice', 'o_totalprice')}, o_orderstatus FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 20"
