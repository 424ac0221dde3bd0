"""DuckDB text for the oracle side of the registered queries.

Each helper returns the SQL twin of a Spark helper, so the two sides share
one definition of every rounding, hash and metric formula.
"""

from __future__ import annotations

from ..functions.numeric import round_sig_sql

R = round_sig_sql


def regression_metrics_sql(y: str = "y", p: str = "p", digits: int = 9) -> str:
    """Select-list of the regression metrics over columns ``y`` and ``p``."""
    mse = f"avg(({y} - {p}) * ({y} - {p}))"
    return ",\n".join([
        f"count({y} - {p}) AS n",
        f"{R(mse, digits)} AS mse",
        f"{R(f'sqrt({mse})', digits)} AS rmse",
        f"{R(f'avg(abs({y} - {p}))', digits)} AS mae",
        R(f"CASE WHEN min(least({y}, {p})) > -1 THEN sqrt(avg(CASE WHEN least({y}, {p}) > -1 "
          f"THEN (ln(1 + {y}) - ln(1 + {p})) * (ln(1 + {y}) - ln(1 + {p})) END)) END", digits)
        + " AS rmsle",
        R(f"CASE WHEN var_pop({y}) > 0 THEN 1 - {R(f'{mse} / var_pop({y})', 12)} END", digits)
        + " AS r2",
        f"{R(mse, digits)} AS mean_residual_deviance",
    ])


def closed_form_coef_sql(label: str, features: list[str]) -> str:
    """Select-list fitting the mean and one least-squares line per feature."""
    parts = [f"avg(CAST({label} AS DOUBLE)) AS m"]
    for i, f in enumerate(features):
        parts += [f"regr_slope(CAST({label} AS DOUBLE), CAST({f} AS DOUBLE)) AS b{i}",
                  f"regr_intercept(CAST({label} AS DOUBLE), CAST({f} AS DOUBLE)) AS a{i}"]
    return ", ".join(parts)


def closed_form_preds_sql(rel: str, label: str, features: list[str], key_cols: list[str],
                          prefix: str = "") -> str:
    """UNION ALL of one prediction per (row, model) over ``rel`` joined to ``coef``."""
    keys = "".join(f"{k}, " for k in key_cols)
    out = [f"SELECT {keys}'{prefix}mean' AS model_id, CAST({label} AS DOUBLE) AS y, m AS p "
           f"FROM {rel}, coef"]
    for i, f in enumerate(features):
        out.append(
            f"SELECT {keys}'{prefix}lsq_{f}' AS model_id, CAST({label} AS DOUBLE) AS y, "
            f"CASE WHEN b{i} IS NULL THEN m ELSE a{i} + b{i} * CAST({f} AS DOUBLE) END AS p "
            f"FROM {rel}, coef")
    return "\nUNION ALL\n".join(out)


def leaderboard_sql(metrics_rel: str, sort_metric: str = "rmse", ascending: bool = True) -> str:
    direction = "ASC" if ascending else "DESC"
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY {sort_metric} {direction} NULLS LAST, "
            f"model_id) AS INTEGER) AS rank FROM {metrics_rel}")
