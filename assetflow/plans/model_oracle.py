"""DuckDB SQL twins of the model analytics: ridge regression in closed form.

The normal equations of every group are solved in SQL. They are generated from the feature
list: one statement step per eliminated feature, then one per back-substituted coefficient.
Results are rounded as ``catalog`` rounds them.
"""

from __future__ import annotations

from .. import config
from .oracle import CH, _with

X = ["age"] + CH + ["oil_output"]
P = len(X)
OUT, LIFE = "output_6_hours_ahead", "remaining_life"
OUT_MODEL, LIFE_MODEL = "asset_output_prediction", "asset_life_prediction"
RIDGES = "(VALUES " + ", ".join(f"(CAST({r} AS DOUBLE))" for r in config.RIDGE_CANDIDATES) + ") p(ridge)"
ONE_RIDGE = f"(VALUES (CAST({config.RIDGE} AS DOUBLE))) p(ridge)"
#: Digits the results are rounded to, here and in ``catalog``.
DIGITS = 6


def _train(name: str = "train", as_of: str = "2024-02-01") -> str:
    view = _with("train").replace("DATE '2024-02-01'", f"DATE '{as_of}'")
    return f"{name} AS MATERIALIZED ({view} SELECT * FROM train)"


def _fit(tag: str, rows: str, group: str, label: str, ridges: str = ONE_RIDGE) -> list[str]:
    """``tag``: per group and penalty the intercept, coefficients ``b0..``, means ``m0..`` and deviations ``sd0..``."""
    upper = [(i, j) for i in range(P) for j in range(i + 1, P)]
    known = " AND ".join(f"{c} IS NOT NULL" for c in X + [label])
    moments = [f"avg({label}) AS my", f"sqrt(var_pop({label})) AS sdy"]
    moments += [f"avg({c}) AS m{i}" for i, c in enumerate(X)]
    moments += [f"sqrt(var_pop({c})) AS sd{i}" for i, c in enumerate(X)]
    moments += [f"covar_pop({c}, {label}) AS cy{i}" for i, c in enumerate(X)]
    moments += [f"covar_pop({X[i]}, {X[j]}) AS c{i}_{j}" for i, j in upper]
    # a constant column has no deviation (z NULL): unit diagonal, no correlation, coefficient 0
    usable = [f"CASE WHEN sd{i} > 1e-12 * (1 + abs(m{i})) THEN sd{i} END AS z{i}" for i in range(P)]
    system = [f"CASE WHEN z{i} IS NULL THEN 1.0 ELSE 1.0 + ridge END AS a{i}_{i}" for i in range(P)]
    system += [f"coalesce(c{i}_{j} / (z{i} * z{j}), 0.0) AS a{i}_{j}" for i, j in upper]
    system += [f"coalesce(cy{i} / (z{i} * CASE WHEN sdy > 0 THEN sdy ELSE 1.0 END), 0.0) AS r{i}" for i in range(P)]
    steps = [f"{tag}_m AS (SELECT {group}, {', '.join(moments)} FROM {rows} WHERE NOT is_test AND {known} GROUP BY {group})",
             f"{tag}_z AS (SELECT *, {', '.join(usable)} FROM {tag}_m, {ridges})",
             f"{tag}_e0 AS MATERIALIZED (SELECT *, {', '.join(system)} FROM {tag}_z)"]
    for k in range(P - 1):
        less = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i in range(k + 1, P) for j in range(i, P)]
        less += [f"r{i} - a{k}_{i} * r{k} / a{k}_{k} AS r{i}" for i in range(k + 1, P)]
        steps.append(f"{tag}_e{k + 1} AS MATERIALIZED (SELECT * REPLACE ({', '.join(less)}) FROM {tag}_e{k})")
    last = f"{tag}_e{P - 1}"
    for k in reversed(range(P)):
        known_part = "".join(f" - a{k}_{j} * s{j}" for j in range(k + 1, P))
        steps.append(f"{tag}_s{k} AS MATERIALIZED (SELECT *, (r{k}{known_part}) / a{k}_{k} AS s{k} FROM {last})")
        last = f"{tag}_s{k}"
    coefs = ", ".join(f"coalesce(s{i} * sdy / z{i}, 0.0) AS b{i}" for i in range(P))
    kept = ", ".join(f"m{i}, sd{i}, b{i}" for i in range(P))
    steps.append(f"{tag}_b AS (SELECT *, {coefs} FROM {last})")
    mean_part = " + ".join(f"b{i} * m{i}" for i in range(P))
    steps.append(f"{tag} AS MATERIALIZED (SELECT {group}, ridge, my - ({mean_part}) AS intercept, {kept} FROM {tag}_b)")
    return steps


def _score(rows: str = "r", coefs: str = "c") -> str:
    return f"{coefs}.intercept" + "".join(f" + {coefs}.b{i} * coalesce({rows}.{c}, {coefs}.m{i})" for i, c in enumerate(X))


def _scored(tag: str, rows: str, coefs: str, group: str, out: str) -> str:
    return (f"{tag} AS MATERIALIZED (SELECT r.*, {_score()} AS {out} FROM {rows} r "
            f"LEFT JOIN {coefs} c ON r.{group} = c.{group})")


def _rmse(label: str, pred: str) -> str:
    return (f"sqrt(avg(({label} - {pred}) ** 2) FILTER (NOT is_test)) AS train_rmse, "
            f"sqrt(avg(({label} - {pred}) ** 2) FILTER (is_test)) AS test_rmse")


def _best(tag: str, rows: str, model: str, label: str, round_no: int) -> list[str]:
    """``tag``: the run of every asset with the least held-out error; ``tag_fit``: all its candidates' coefficients."""
    run_id = f"concat_ws('-', '{model}', r.asset_id, format('{{:.4f}}', c.ridge), '{round_no}')"
    return _fit(f"{tag}_fit", rows, "asset_id", label, RIDGES) + [
        f"{tag}_rows AS (SELECT r.asset_id, c.ridge, {run_id} AS run_id, is_test, {label}, {_score()} AS pred "
        f"FROM {rows} r JOIN {tag}_fit c ON r.asset_id = c.asset_id)",
        f"{tag}_runs AS (SELECT '{model}' AS model, asset_id, run_id, ridge, 'FINISHED' AS status, {_rmse(label, 'pred')}, "
        f"CAST({round_no} AS BIGINT) AS created_version FROM {tag}_rows GROUP BY asset_id, run_id, ridge)",
        f"{tag} AS MATERIALIZED (SELECT * FROM {tag}_runs WHERE test_rmse > 0 "
        f"QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY test_rmse, run_id) = 1)"]


def _r(cols: list[str], digits: int) -> list[str]:
    return [f"round(round({c}, 10), {digits}) AS {c}" for c in cols]


def _select(source: str, digits: dict[str, int], plain: list[str] = ()) -> str:
    """``SELECT`` from ``source`` with columns rounded: the ``plain`` ones to 6 digits, others as named."""
    rounded = _r(list(plain), 6) + [r for c, d in digits.items() for r in _r([c], d)]
    return f"SELECT * REPLACE ({', '.join(rounded)}) FROM {source}"


def _sql(steps: list[str], final: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n" + final


_OUT_P, _LIFE_P = OUT + "_predicted", LIFE + "_predicted"
_INPUTS = [c for c in X if c != "age"]
_OUTPUT = [_train()] + _fit("oc", "train", "asset_id", OUT) + [_scored("outp", "train", "oc", "asset_id", _OUT_P)]
_LIFE = _OUTPUT + _fit("lc", "train", "asset_id", LIFE) + [_scored("lifep", "outp", "lc", "asset_id", _LIFE_P)]
_RMSE = {"train_rmse": DIGITS, "test_rmse": DIGITS}
_MONEY = {"revenue": DIGITS, "cost": DIGITS, "profit": DIGITS}
_PRED = {"expected_output": DIGITS, "expected_life": DIGITS}
_BEST = [_train()] + _best("ob", "train", OUT_MODEL, OUT, 0) + _best("lb", "train", LIFE_MODEL, LIFE, 0)
_NEWEST = "(SELECT * FROM train QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY window_start DESC) = 1) newest"
_FIXED_GRID = f"""grid AS (
      SELECT newest.* REPLACE (round(CAST({config.SWEEP_START} AS DOUBLE) + place * CAST({config.SWEEP_STEP} AS DOUBLE),
                                     {config.SWEEP_DECIMALS}) AS sensor1), CAST(place AS INTEGER) AS setting
      FROM {_NEWEST}, range(0, {config.SWEEP_POINTS}) s(place))"""
_OWN_GRID = f"""grid AS (
      SELECT newest.* REPLACE (round(r.low + place * ((r.high - r.low) / {config.SWEEP_POINTS - 1}), {config.SWEEP_DECIMALS}) AS sensor1),
             CAST(place AS INTEGER) AS setting
      FROM {_NEWEST} JOIN (SELECT asset_id, min(sensor1) AS low, max(sensor1) AS high FROM train GROUP BY asset_id) r USING (asset_id),
           range(0, {config.SWEEP_POINTS}) s(place))"""


def _swept(grid: str) -> list[str]:
    return _BEST + [
        "oprom AS (SELECT * FROM ob_fit SEMI JOIN ob USING (asset_id, ridge))",
        "lprom AS (SELECT * FROM lb_fit SEMI JOIN lb USING (asset_id, ridge))",
        grid,
        _scored("grid_o", "grid", "oprom", "asset_id", "expected_output"),
        _scored("swept", "grid_o", "lprom", "asset_id", "expected_life")]


_SWEEP = _swept(_FIXED_GRID)
# money follows from the predictions as reported
_MONEY_STEPS = [f"reported AS MATERIALIZED ({_select('swept', _PRED)})", f"""curve AS MATERIALIZED (
      SELECT *, revenue - cost AS profit FROM (
        SELECT *, expected_output * {float(config.HOURS_PER_YEAR)} * {float(config.PRICE)} AS revenue,
               CASE WHEN expected_life > 0 THEN revenue / expected_life END AS cost FROM reported))"""]
_BEST_SETTING = """optimum AS MATERIALIZED (
      SELECT asset_id, sensor1 AS best_setting, expected_output, expected_life, revenue, cost, profit
      FROM curve WHERE profit IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY profit DESC, sensor1) = 1)"""
_PROFIT = _SWEEP + _MONEY_STEPS
_OPTIMUM = _PROFIT + [_BEST_SETTING]
_ASSET = "asset AS (" + _with("asset") + " SELECT * FROM asset)"


def _registry() -> str:
    steps, regs = [], []
    for n, as_of in enumerate(config.RETRAIN_AS_OF):
        steps.append(_train(f"train{n}", str(as_of)))
        for short, model, label in (("o", OUT_MODEL, OUT), ("l", LIFE_MODEL, LIFE)):
            steps += _best(f"{short}b{n}", f"train{n}", model, label, n)
            regs.append(f"SELECT model AS model_name, asset_id, run_id, created_version AS registered_round FROM {short}b{n}")
    steps.append("registered AS (" + " UNION ALL ".join(regs) + ")")
    return _sql(steps, """
      SELECT *, row_number() OVER w AS version,
             CASE WHEN lead(run_id) OVER w IS NULL THEN 'Production' ELSE 'Archived' END AS stage
      FROM registered WINDOW w AS (PARTITION BY model_name, asset_id ORDER BY registered_round, run_id)""")


SQL: dict[str, str] = {
    "output_predictions": _sql(_OUTPUT, _select("outp", {_OUT_P: DIGITS}, _INPUTS + [OUT])),
    "life_predictions": _sql(_LIFE, _select(f"(SELECT * EXCLUDE ({OUT}) FROM lifep)", {_OUT_P: DIGITS, _LIFE_P: DIGITS}, _INPUTS)),
    "actual_vs_predicted": _sql(_OUTPUT, _select(f"""(
      SELECT reading_date, avg({OUT}) AS actual, avg({_OUT_P}) AS predicted FROM outp
      WHERE {OUT} > (SELECT quantile_disc({OUT}, 0.5) FROM outp) GROUP BY reading_date)""", {"actual": 6, "predicted": DIGITS})),
    "life_actual_vs_predicted": _sql(_LIFE, _select(f"""(
      SELECT reading_date, avg({LIFE}) AS actual_life, avg({_LIFE_P}) AS predicted_life FROM lifep GROUP BY reading_date)""",
                                                    {"actual_life": 6, "predicted_life": DIGITS})),
    "model_rmse": _sql(_LIFE, _select(f"""(
      SELECT asset_id, '{OUT_MODEL}' AS model, {_rmse(OUT, _OUT_P)} FROM outp GROUP BY asset_id UNION ALL
      SELECT asset_id, '{LIFE_MODEL}' AS model, {_rmse(LIFE, _LIFE_P)} FROM lifep GROUP BY asset_id)""", _RMSE)),
    "best_model": _sql(_BEST, _select("(SELECT * FROM ob UNION ALL SELECT * FROM lb)", _RMSE, ["ridge"])),
    "promoted_models": _registry(),
    "group_model": _sql([_train(), _ASSET, "placed AS MATERIALIZED (SELECT train.*, asset.region AS grp FROM train JOIN asset USING (asset_id))"]
                        + _fit("gc", "placed", "grp", OUT) + [_scored("gp", "placed", "gc", "grp", "pred")],
                        _select(f"""(SELECT 'region' AS "grouping", grp AS "group", {_rmse(OUT, 'pred')} FROM gp GROUP BY grp)""", _RMSE)),
    "feature_importance": _sql([_train()] + _fit("oc", "train", "asset_id", OUT), _select(
        f"""(SELECT asset_id, feature, '{OUT_MODEL}' AS model,
             coalesce(w / nullif(sum(w) OVER (PARTITION BY asset_id), 0), 0) AS importance
      FROM (""" + " UNION ALL ".join(f"SELECT asset_id, '{c}' AS feature, abs(b{i}) * sd{i} AS w FROM oc" for i, c in enumerate(X))
        + "))", {"importance": DIGITS})),
    "sweep_predictions": _sql(_SWEEP, _select("swept", _PRED, _INPUTS + [OUT])),
    "profit_curve": _sql(_PROFIT, _select("curve", {**_PRED, **_MONEY}, _INPUTS + [OUT])),
    "optimal_setting": _sql(_OPTIMUM, _select("optimum", {**_PRED, **_MONEY}, ["best_setting"])),
    "optimal_setting_own_range": _sql(_swept(_OWN_GRID) + _MONEY_STEPS + [_BEST_SETTING], _select("optimum", {**_PRED, **_MONEY}, ["best_setting"])),
    "fleet_kpis": _sql(_OPTIMUM + [_ASSET], _select("""(
      SELECT region, count(*) AS assets, sum(profit) AS total_profit, avg(profit) AS mean_profit, avg(expected_life) AS mean_life
      FROM optimum JOIN asset USING (asset_id) GROUP BY region)""", {"total_profit": DIGITS, "mean_profit": DIGITS, "mean_life": DIGITS})),
}
