"""SQL twins of the exact profile fields (DuckDB dialect).

The column kinds mirror the Spark type dispatch of the profile operator:
``int`` / ``float`` typed numbers, ``text`` classified per value, ``bool``
and ``other`` (timestamps and the rest: only counted).
"""

from __future__ import annotations

from tallyframe.functions import typeclass as tc


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text_num(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{tc.FRACTIONAL_RE_SQL}') THEN TRY_CAST({c} AS DOUBLE) END"


def column_select(name: str, kind: str, source: str, keys: list[tuple[str, str]] = (),
                  where: str | None = None, expr: str | None = None,
                  sd_digits: int = 4) -> str:
    """One SELECT giving the exact profile fields of one column."""
    c = expr or q(name)
    nonnull = f"count({c})"
    zero = "CAST(0 AS BIGINT)"
    ti = tf = tb = ts = tu = zero
    num = None
    if kind == "int":
        ti, num = nonnull, f"CAST({c} AS DOUBLE)"
    elif kind == "float":
        tf, num = nonnull, f"CAST({c} AS DOUBLE)"
    elif kind == "bool":
        tb = nonnull
    elif kind == "text":
        ti = f"count_if(regexp_matches({c}, '{tc.INTEGRAL_RE_SQL}'))"
        tf = (f"count_if(regexp_matches({c}, '{tc.FRACTIONAL_RE_SQL}') "
              f"AND NOT regexp_matches({c}, '{tc.INTEGRAL_RE_SQL}'))")
        tb = f"count_if(lower({c}) IN ('true', 'false'))"
        ts = f"({nonnull} - {ti} - {tf} - {tb})"
        num = _text_num(c)
    else:
        tu = nonnull
    key_sel = "".join(f"{e} AS {a}, " for e, a in keys)
    parts = [
        f"{key_sel}'{name}' AS \"column\"",
        "CAST(count(*) AS BIGINT) AS \"count\"",
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count",
        f"CAST({ti} AS BIGINT) AS type_integral",
        f"CAST({tf} AS BIGINT) AS type_fractional",
        f"CAST({tb} AS BIGINT) AS type_boolean",
        f"CAST({ts} AS BIGINT) AS type_string",
        f"CAST({tu} AS BIGINT) AS type_unknown",
    ]
    if num is not None:
        parts += [
            f"CAST(count({num}) AS BIGINT) AS n",
            f"CAST(min({num}) AS DOUBLE) AS \"min\"",
            f"CAST(max({num}) AS DOUBLE) AS \"max\"",
            f"round(sum({num}), 2) AS total",
            f"round(stddev_samp({num}), {sd_digits}) AS stddev",
        ]
    else:
        parts += ["CAST(0 AS BIGINT) AS n", "CAST(NULL AS DOUBLE) AS \"min\"",
                  "CAST(NULL AS DOUBLE) AS \"max\"", "CAST(NULL AS DOUBLE) AS total",
                  "CAST(NULL AS DOUBLE) AS stddev"]
    sql = f"SELECT {', '.join(parts)} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    if keys:
        sql += " GROUP BY " + ", ".join(e for e, _ in keys)
    return sql


def profile_sql(source: str, columns: list[tuple[str, str]], keys=(), where=None,
                exprs: dict[str, str] | None = None, **kw) -> str:
    """UNION ALL of :func:`column_select` over ``columns`` = [(name, kind)]."""
    exprs = exprs or {}
    return "\nUNION ALL\n".join(
        column_select(n, k, source, list(keys), where, exprs.get(n), **kw) for n, k in columns)


# Column kinds of the driver tables used by the profile queries.
KINDS = {
    "lineitem": [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"),
                 ("l_linenumber", "int"), ("l_quantity", "float"), ("l_extendedprice", "float"),
                 ("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "text"),
                 ("l_linestatus", "text"), ("l_shipdate", "other")],
    "orders": [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "text"),
               ("o_totalprice", "float"), ("o_orderdate", "other"), ("o_orderpriority", "text")],
    "customer": [("c_custkey", "int"), ("c_name", "text"), ("c_nationkey", "int"),
                 ("c_acctbal", "float"), ("c_mktsegment", "text")],
    "documents": [("doc_id", "int"), ("text", "text"), ("lang", "text"), ("source", "text"),
                  ("n_chars", "int")],
    "conversations": [("conv_id", "int"), ("turn", "int"), ("role", "text"), ("text", "text")],
    "pages": [("page_id", "int"), ("url", "text"), ("html", "text")],
    "embeddings": [("vec_id", "int"), ("embedding", "other"), ("label", "int")],
    "events": [("event_id", "int"), ("ts", "other"), ("user_id", "int"), ("event_type", "text"),
               ("value", "float"), ("props", "text")],
}


def kinds(table: str, exclude=()) -> list[tuple[str, str]]:
    return [(n, k) for n, k in KINDS[table] if n not in exclude]


def inferred_sql(ti="type_integral", tf="type_fractional", tb="type_boolean",
                 ts="type_string", tu="type_unknown") -> str:
    """Largest class, ties to the earlier of integral, fractional, boolean, string, unknown."""
    g = f"greatest({ti}, {tf}, {tb}, {ts}, {tu})"
    return (f"CASE WHEN {g} = 0 THEN 'null' WHEN {ti} = {g} THEN 'integral' "
            f"WHEN {tf} = {g} THEN 'fractional' WHEN {tb} = {g} THEN 'boolean' "
            f"WHEN {ts} = {g} THEN 'string' ELSE 'unknown' END")


def month_range(col: str, month: str) -> str:
    """``col`` inside the calendar month starting at ``month`` (YYYY-MM-01)."""
    return (f"{col} >= TIMESTAMP '{month} 00:00:00' AND "
            f"{col} < TIMESTAMP '{month} 00:00:00' + INTERVAL 1 MONTH")
