"""Constraint queries (C1-C7) on the driver tables.

The documents are written for these tables: their limits come from values
measured there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import constraints as C
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.plans.registry import register
from tallyframe.sources.tables import table

EXACT = ProfileOptions(sketches=False)

# Lines hold 1 to 50 units, so "small lots" fails; "taxed lines" shows that a
# label says nothing about the check: its op is LT.
LINES_STRICT = {
    "valueConstraints": {
        "l_quantity": {"constraints": [
            {"name": "some units", "op": "GE", "value": 1.0},
            {"name": "small lots", "op": "LE", "value": 45.0, "verbose": True},
        ]},
        "l_tax": {"constraints": [
            {"name": "taxed lines", "op": "LT", "value": 0.07, "verbose": True},
        ]},
        "l_returnflag": {"constraints": [
            {"name": "known flags", "op": "NE", "value": "X"},
        ]},
    },
    "summaryConstraints": {
        "l_discount": {"constraints": [
            {"name": "cheapest discount", "first_field": "max", "op": "LE", "value": 0.1},
        ]},
        "l_colour": {"constraints": [
            {"name": "column that is not there", "first_field": "count", "op": "GT", "value": 0.0},
        ]},
    },
}

# Holds on every scale (camel-case spelling of the key).
LINES_LOOSE = {
    "summaryConstraints": {
        "l_quantity": {"constraints": [
            {"name": "lots on average", "firstField": "mean", "op": "GT", "value": 20.0},
            {"name": "no gaps", "firstField": "null_count", "op": "EQ", "value": 0.0},
        ]},
    },
}

CUSTOMER_SUMMARY = {
    "summaryConstraints": {
        "c_acctbal": {"constraints": [
            {"first_field": "min", "value": 0.0, "op": "GE"},
            {"first_field": "max", "value": 10000.0, "op": "LE"},
            {"first_field": "null_count", "value": 0.0, "op": "EQ"},
        ]},
        "c_nationkey": {"constraints": [
            {"first_field": "max", "value": 24.0, "op": "LE"},
            {"first_field": "min", "value": 0.0, "op": "GT"},
        ]},
    },
}

FIELD_PAIRS = {
    "summaryConstraints": {
        "l_extendedprice": {"constraints": [
            {"first_field": "min", "second_field": "max", "op": "LT"},
        ]},
        "l_discount": {"constraints": [
            {"first_field": "stddev", "second_field": "mean", "op": "LT"},
        ]},
        "l_quantity": {"constraints": [
            {"first_field": "mean", "second_field": "stddev", "op": "GT"},
            {"first_field": "max", "second_field": "count", "op": "GE"},
        ]},
    },
}


def _lineitem_profile(li):
    return profile(li, "lineitem", options=EXACT)


@register("value_constraints", sql="""
SELECT 'some units' AS name, 'l_quantity' AS "column", 'GE' AS op, 1.0::DOUBLE AS value, count(l_quantity) AS total,
  CAST(count_if(NOT (l_quantity >= 1)) AS BIGINT) AS failures, CAST(0 AS BIGINT) AS not_comparable, count(l_quantity) > 0 AND count_if(NOT (l_quantity >= 1)) = 0 AS passed FROM lineitem
UNION ALL SELECT 'small lots' AS name, 'l_quantity' AS "column", 'LE' AS op, 45.0::DOUBLE AS value, count(l_quantity) AS total,
  CAST(count_if(NOT (l_quantity <= 45)) AS BIGINT) AS failures, CAST(0 AS BIGINT) AS not_comparable, count(l_quantity) > 0 AND count_if(NOT (l_quantity <= 45)) = 0 AS passed FROM lineitem
UNION ALL SELECT 'taxed lines' AS name, 'l_tax' AS "column", 'LT' AS op, 0.07::DOUBLE AS value, count(l_tax) AS total,
  CAST(count_if(NOT (l_tax < 0.07::DOUBLE)) AS BIGINT) AS failures, CAST(0 AS BIGINT) AS not_comparable, count(l_tax) > 0 AND count_if(NOT (l_tax < 0.07::DOUBLE)) = 0 AS passed FROM lineitem
UNION ALL SELECT 'known flags' AS name, 'l_returnflag' AS "column", 'NE' AS op, CAST(NULL AS DOUBLE) AS value, count(l_returnflag) AS total,
  CAST(count_if(NOT (l_returnflag <> 'X')) AS BIGINT) AS failures, CAST(0 AS BIGINT) AS not_comparable, count(l_returnflag) > 0 AND count_if(NOT (l_returnflag <> 'X')) = 0 AS passed FROM lineitem""")
def value_constraints(spark, sf_dir):
    """Every value compared with a literal, all constraints in one pass."""
    li = table(spark, sf_dir, "lineitem")
    return C.value_report(li, C.parse_constraints(LINES_STRICT))


@register("summary_constraints", sql="""
WITH s AS (SELECT min(c_acctbal) AS acct_min, max(c_acctbal) AS acct_max,
  count_if(c_acctbal IS NULL)::DOUBLE AS acct_nulls, min(c_nationkey)::DOUBLE AS nk_min,
  max(c_nationkey)::DOUBLE AS nk_max FROM customer)
SELECT 'summary min GE 0.0' AS name, 'c_acctbal' AS "column", 'min' AS first_field, 'GE' AS op, acct_min AS actual, acct_min >= 0 AS passed FROM s
UNION ALL SELECT 'summary max LE 10000.0', 'c_acctbal', 'max', 'LE', acct_max, acct_max <= 10000 FROM s
UNION ALL SELECT 'summary null_count EQ 0.0', 'c_acctbal', 'null_count', 'EQ', acct_nulls, acct_nulls = 0 FROM s
UNION ALL SELECT 'summary max LE 24.0', 'c_nationkey', 'max', 'LE', nk_max, nk_max <= 24 FROM s
UNION ALL SELECT 'summary min GT 0.0', 'c_nationkey', 'min', 'GT', nk_min, nk_min > 0 FROM s""")
def summary_constraints(spark, sf_dir):
    """Summary field vs literal (customer c_acctbal min GE 0 fails)."""
    cu = table(spark, sf_dir, "customer")
    p = profile(cu, "customer", options=EXACT)
    r = C.summary_report(p, C.parse_constraints(CUSTOMER_SUMMARY))
    return r.select("name", "column", "first_field", "op", "actual", "passed")


@register("summary_field_pair", sql="""
WITH s AS (SELECT min(l_extendedprice) AS p_min, max(l_extendedprice) AS p_max,
  stddev_samp(l_discount) AS d_sd, avg(l_discount) AS d_mean, avg(l_quantity) AS q_mean,
  stddev_samp(l_quantity) AS q_sd, max(l_quantity) AS q_max, count(*)::DOUBLE AS q_count FROM lineitem)
SELECT 'summary min LT max' AS name, 'l_extendedprice' AS "column", 'min' AS first_field, 'max' AS second_field, p_min < p_max AS passed FROM s
UNION ALL SELECT 'summary stddev LT mean', 'l_discount', 'stddev', 'mean', d_sd < d_mean FROM s
UNION ALL SELECT 'summary mean GT stddev', 'l_quantity', 'mean', 'stddev', q_mean > q_sd FROM s
UNION ALL SELECT 'summary max GE count', 'l_quantity', 'max', 'count', q_max >= q_count FROM s""")
def summary_field_pair(spark, sf_dir):
    """Summary field compared with another field of the same summary."""
    li = table(spark, sf_dir, "lineitem")
    r = C.summary_report(_lineitem_profile(li), C.parse_constraints(FIELD_PAIRS))
    return r.select("name", "column", "first_field", "second_field", "passed")


@register("constraint_failures", sql="""
SELECT 'small lots' AS name, 'l_quantity' AS "column", CAST(l_quantity AS VARCHAR) AS value, l_orderkey, l_partkey, l_suppkey, l_linenumber
FROM lineitem WHERE NOT (l_quantity <= 45)
UNION ALL SELECT 'taxed lines' AS name, 'l_tax' AS "column", CAST(l_tax AS VARCHAR) AS value, l_orderkey, l_partkey, l_suppkey, l_linenumber
FROM lineitem WHERE NOT (l_tax < 0.07::DOUBLE)""")
def constraint_failures(spark, sf_dir):
    """C4: every failing value of the verbose constraints, with the row key."""
    li = table(spark, sf_dir, "lineitem")
    return C.failures(li, C.parse_constraints(LINES_STRICT),
                      key_columns=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@register("constraint_report", sql="""
SELECT 'value' AS kind, 'some units' AS name, 'l_quantity' AS "column", 'GE' AS op, bool_and(l_quantity >= 1) AS passed FROM lineitem
UNION ALL SELECT 'value' AS kind, 'small lots' AS name, 'l_quantity' AS "column", 'LE' AS op, bool_and(l_quantity <= 45) AS passed FROM lineitem
UNION ALL SELECT 'value' AS kind, 'taxed lines' AS name, 'l_tax' AS "column", 'LT' AS op, bool_and(l_tax < 0.07::DOUBLE) AS passed FROM lineitem
UNION ALL SELECT 'value' AS kind, 'known flags' AS name, 'l_returnflag' AS "column", 'NE' AS op, bool_and(l_returnflag <> 'X') AS passed FROM lineitem
UNION ALL SELECT 'summary', 'cheapest discount', 'l_discount', 'LE', max(l_discount) <= 0.1 FROM lineitem
UNION ALL SELECT 'summary', 'column that is not there', 'l_colour', 'GT', false""")
def constraint_report(spark, sf_dir):
    """Value and summary checks of one document in one table."""
    li = table(spark, sf_dir, "lineitem")
    cs = C.parse_constraints(LINES_STRICT)
    return C.report(li, _lineitem_profile(li), cs).select("kind", "name", "column", "op", "passed")


@register("constraint_verdict", sql="""
SELECT 'fail' AS doc, false AND bool_and(l_quantity >= 1) AND bool_and(l_quantity <= 45) AND bool_and(l_tax < 0.07::DOUBLE) AND bool_and(l_returnflag <> 'X') AS passed, true AS expect_failure, true AS action_ok FROM lineitem
UNION ALL
SELECT 'succeed', avg(l_quantity) > 20 AND count_if(l_quantity IS NULL) = 0, false,
  (avg(l_quantity) > 20 AND count_if(l_quantity IS NULL) = 0) <> false FROM lineitem""")
def constraint_verdict(spark, sf_dir):
    """Overall verdict, flipped by expect_failure (one must fail, one must succeed)."""
    li = table(spark, sf_dir, "lineitem")
    p = _lineitem_profile(li)
    fail = C.verdict(C.report(li, p, C.parse_constraints(LINES_STRICT)), expect_failure=True)
    ok = C.verdict(C.report(li, p, C.parse_constraints(LINES_LOOSE)), expect_failure=False)
    return (fail.select(F.lit("fail").alias("doc"), "*")
            .unionByName(ok.select(F.lit("succeed").alias("doc"), "*")))
