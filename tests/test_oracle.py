"""Each registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE

# A fast, representative subset; tools/check_oracle.py runs all of them.
FAST = ["profile_lineitem", "profile_types", "profile_grouped", "profile_merge",
        "profile_rollup_day", "frequent_strings_exact", "histogram", "pmf", "describe_numeric",
        "describe_text", "value_constraints", "summary_constraints", "constraint_verdict",
        "drift_intersection", "drift_mutual_info", "drift_ks", "pmf_overlay", "baseline_trailing",
        "sample_exact", "slice_rows", "row_positions", "kafka_decode", "feature_compose",
        "series_unique", "stream_drain", "run_log", "pmf_sketch", "quantile_sketch",
        "stream_profile_tags"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_twin(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _bag(sdf.columns, rows) == _bag(dcols, drows)
