"""Small helpers that spell DuckDB SQL fragments for the oracle queries."""

from __future__ import annotations

import itertools
import math


def cut_sql(col: str, edges, labels, include_lowest: bool = False) -> str:
    """pandas.cut as a CASE ladder (right-closed, out of range -> NULL)."""
    parts = []
    for i in range(len(edges) - 1):
        a, b = edges[i], edges[i + 1]
        conds = []
        if not math.isinf(a):
            conds.append(f"{col} {'>=' if (i == 0 and include_lowest) else '>'} {a}")
        if not math.isinf(b):
            conds.append(f"{col} <= {b}")
        cond = " AND ".join(conds) or "TRUE"
        parts.append(f"WHEN {cond} THEN '{labels[i]}'")
    return "CASE " + " ".join(parts) + " END"


def map_sql(col: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items())
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {whens}{tail} END"


def yes(col: str, value: str = "Yes") -> str:
    return f"CAST(coalesce({col} = '{value}', false) AS INTEGER)"


def flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def products_sql(cols, degree: int = 2, sep: str = "_x_", digits: int | None = None) -> list[str]:
    """Interaction-only products, one select item per subset (row-wise IEEE
    products are bit-identical across engines, so no rounding by default)."""
    out = []
    for d in range(2, degree + 1):
        for combo in itertools.combinations(cols, d):
            e = " * ".join(f"CAST({c} AS DOUBLE)" for c in combo)
            e = f"round({e}, {digits})" if digits is not None else e
            out.append(f'{e} AS "{sep.join(combo)}"')
    return out


def sig_sql(expr: str, digits: int = 6) -> str:
    """DuckDB twin of ``exprs.sig_round``."""
    e = f"pow(10.0, floor(log10(abs({expr}))))"
    return f"(CASE WHEN ({expr}) = 0 THEN 0.0 ELSE round(({expr}) / {e}, {digits - 1}) * {e} END)"


def round_all(sql: str, keep: list[str], digits: int = 6) -> str:
    """Round every numeric output column except ``keep`` (integers stay integers)."""
    k = ", ".join(f'"{c}"' for c in keep)
    return f"SELECT {k}, round(COLUMNS(* EXCLUDE ({k})), {digits}) FROM ({sql}) q"
