"""DuckDB oracle texts, one per registered query.

Each text starts with the fixture CTEs (same mapping expressions as
``basketry.sources.tables``) and then states the operator in plain SQL.
Rounded figures use ``RR(num, den, digits)``: an exact integer half-up (or
half-even) rounding of ``num / den``, spelled out below, so the oracle does
not depend on either engine's float rounding.
"""

from __future__ import annotations

from basketry.sources import tables as T


def _cte(name: str, body: str) -> str:
    return f"{name} AS (\n{body}\n)"


def _sel(exprs: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} AS {k}" for k, e in exprs.items())


_CUSTOMER_FROM = ("FROM customer JOIN nation ON c_nationkey = n_nationkey "
                  "JOIN region ON n_regionkey = r_regionkey")
_TXN_FROM = ("FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
             "JOIN part ON l_partkey = p_partkey")


def _raw_txn_keyed() -> str:
    e = T.raw_transaction_exprs()
    e["l_partkey"] = "l_partkey"
    return f"SELECT {_sel(e)}, 0 AS ingest_seq {_TXN_FROM}"


def fixture_ctes() -> str:
    cust = _cte("customers", f"SELECT {_sel(T.customer_exprs('duckdb'))} {_CUSTOMER_FROM}")
    txn = _cte("transactions",
               f"SELECT {_sel(T.TRANSACTION_EXPRS)} {_TXN_FROM}")
    g1c = _cte("gen1_customers", f"SELECT {', '.join(T.GEN1_CUSTOMER_COLUMNS)} FROM customers")
    g1t = _cte("gen1_transactions",
               "SELECT transaction_id, customer_id, transaction_date AS date, product_category AS "
               "category, amount, quantity, is_returned AS returned FROM transactions")
    raw_e = T.raw_customer_exprs("duckdb")
    raw_c = _cte("raw_customers",
                 f"SELECT {_sel(raw_e)}, 0 AS ingest_seq {_CUSTOMER_FROM}\nUNION ALL\n"
                 f"SELECT {_sel({**raw_e, 'age': '(' + raw_e['age'] + ') + 1'})}, 1 AS ingest_seq "
                 f"{_CUSTOMER_FROM} WHERE {T.RAW_CUSTOMER_DUP_RULE}")
    cols = list(T.TRANSACTION_EXPRS)
    dup_cols = ", ".join("quantity + 1 AS quantity" if c == "quantity" else c for c in cols)
    raw_tk = _cte("raw_txn_keyed", _raw_txn_keyed())
    raw_tk_all = _cte(
        "raw_txn_all",
        f"SELECT {', '.join(cols)}, l_partkey, ingest_seq FROM raw_txn_keyed\nUNION ALL\n"
        f"SELECT {dup_cols}, l_partkey, 1 AS ingest_seq FROM raw_txn_keyed "
        f"WHERE {T.RAW_TRANSACTION_DUP_RULE}")
    raw_t = _cte("raw_transactions", f"SELECT {', '.join(cols)}, ingest_seq FROM raw_txn_all")
    g1_over = {k: v for k, v in T.RAW_GEN1_OVERRIDES.items()}
    raw_g1t = _cte(
        "raw_gen1_transactions",
        f"SELECT transaction_id, customer_id, transaction_date AS date, product_category AS "
        f"category, {g1_over['amount']} AS amount, {g1_over['quantity']} AS quantity, "
        f"is_returned AS returned, ingest_seq FROM raw_txn_all")
    raw_g1c = _cte("raw_gen1_customers",
                   f"SELECT {', '.join(T.GEN1_CUSTOMER_COLUMNS)}, ingest_seq FROM raw_customers")
    return "WITH " + ",\n".join([cust, txn, g1c, g1t, raw_c, raw_tk, raw_tk_all, raw_t,
                                 raw_g1t, raw_g1c])


def RR(num: str, den: str, digits: int = 2, mode: str = "half_up") -> str:
    """Exact round(num/den, digits) on integers, as DOUBLE (NULL if den is NULL/0)."""
    scale = 10 ** digits
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    t = f"(abs({n}) * {scale})"
    if mode == "half_up":
        q = f"(({t} * 2 + {d}) // ({d} * 2))"
    else:
        q0 = f"({t} // {d})"
        r = f"({t} - {q0} * {d})"
        q = (f"({q0} + CASE WHEN {r} * 2 > {d} OR ({r} * 2 = {d} AND {q0} % 2 = 1) "
             f"THEN 1 ELSE 0 END)")
    return (f"(CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL ELSE "
            f"CAST(CASE WHEN {n} < 0 THEN -{q} ELSE {q} END AS DOUBLE) / {float(scale)} END)")


def CENTS(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def MEAN(total: str, n: str) -> str:
    return f"(CAST(({total}) AS DOUBLE) / CAST(({n}) AS DOUBLE))"


def with_fixtures(sql: str) -> str:
    """Append query-specific CTEs (``sql`` starting with ``, name AS (...)``) or a SELECT."""
    return fixture_ctes() + "\n" + sql
