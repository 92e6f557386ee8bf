"""Small dense solves as column expressions.

A per-row (or per-group) ``n x n`` system ``A x = b`` is solved by unrolled
Gauss-Jordan elimination, one projection per pivot, so the solve stays inside
whole-stage codegen and needs no Python worker.  The same expression text is
produced for Spark (``try_divide``) and for ANSI engines (``/ NULLIF(p, 0)``),
which keeps the operation order, and hence the floating-point result, equal.
A zero pivot (singular system, e.g. a constant series) gives NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def cell(step: int, i: int, j: int) -> str:
    return f"gj{step}_{i}_{j}"


def _div(a: str, b: str, dialect: str) -> str:
    return f"try_divide({a}, {b})" if dialect == "spark" else f"({a} / NULLIF({b}, 0))"


def gauss_jordan_steps(n: int, dialect: str = "spark") -> list[dict[str, str]]:
    """Per pivot k: {new column -> expression over step k columns}.  Step 0 holds
    the augmented matrix ``[A | b]`` (``n`` x ``n+1``); the solution is
    ``cell(n, i, n)``."""
    steps = []
    for k in range(n):
        cur, nxt = k, k + 1
        exprs: dict[str, str] = {}
        piv = cell(cur, k, k)
        for j in range(k, n + 1):
            exprs[cell(nxt, k, j)] = _div(cell(cur, k, j), piv, dialect)
        for i in range(n):
            if i == k:
                continue
            for j in range(k, n + 1):
                exprs[cell(nxt, i, j)] = f"({cell(cur, i, j)} - {cell(cur, i, k)} * {_div(cell(cur, k, j), piv, dialect)})"
        # columns left of the pivot are identity columns and never read again
        steps.append(exprs)
    return steps


def solve_columns(df: DataFrame, a: list[list[str]], b: list[str], out: list[str], keep: list[str]) -> DataFrame:
    """Solve ``A x = b`` per row; ``a``/``b`` are expressions, ``out`` names the solution."""
    n = len(b)
    # one selectExpr per pivot: a single call and a single analysis per step
    first = [f"CAST({a[i][j]} AS DOUBLE) AS {cell(0, i, j)}" for i in range(n) for j in range(n)]
    first += [f"CAST({b[i]} AS DOUBLE) AS {cell(0, i, n)}" for i in range(n)]
    cur = df.selectExpr(*keep, *first)
    for step in gauss_jordan_steps(n, "spark"):
        cur = cur.selectExpr(*keep, *[f"{e} AS {c}" for c, e in step.items()])
    return cur.selectExpr(*keep, *[f"{cell(n, i, n)} AS {out[i]}" for i in range(n)])


def solve_sql(n: int, source: str, a: list[list[str]], b: list[str], out: list[str], keep: list[str],
              name: str = "gj") -> tuple[list[tuple[str, str]], str]:
    """The same solve as a chain of SQL CTEs; returns (ctes, final relation name)."""
    ctes = []
    keep_sql = ", ".join(keep)
    sel = [f"CAST({a[i][j]} AS DOUBLE) AS {cell(0, i, j)}" for i in range(n) for j in range(n)]
    sel += [f"CAST({b[i]} AS DOUBLE) AS {cell(0, i, n)}" for i in range(n)]
    ctes.append((f"{name}0", f"SELECT {keep_sql}, {', '.join(sel)} FROM {source}"))
    for k, step in enumerate(gauss_jordan_steps(n, "ansi")):
        body = [f"{e} AS {c}" for c, e in step.items()]
        ctes.append((f"{name}{k + 1}", f"SELECT {keep_sql}, {', '.join(body)} FROM {name}{k}"))
    final = [f"{cell(n, i, n)} AS {out[i]}" for i in range(n)]
    ctes.append((f"{name}_x", f"SELECT {keep_sql}, {', '.join(final)} FROM {name}{n}"))
    return ctes, f"{name}_x"
