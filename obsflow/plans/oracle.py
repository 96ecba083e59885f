"""The catalog's queries as plain SQL, for checking against another engine."""

from __future__ import annotations

from typing import NamedTuple

from obsflow.plans.fixture import OBS_SQL

# Constants are written out here, not taken from the operators under test.


class FieldSpec(NamedTuple):
    column: str
    output: str
    missing: str
    scale: float = 1.0
    value_part: int = 0
    flag_part: int = 1
    good_flags: tuple[str, ...] = ("1", "5")


TEMPERATURE = FieldSpec("TMP", "temperature", "+9999", 10.0)
DEW_POINT = FieldSpec("DEW", "dew_clean", "+9999", 10.0)
PRESSURE = FieldSpec("SLP", "slp_clean", "99999", 10.0)
WIND = FieldSpec("WND", "wind_speed", "9999", 10.0, 3, 4)
CEILING = FieldSpec("CIG", "cloud_ceiling", "99999")
VISIBILITY = FieldSpec("VIS", "visibility", "999999")
ALL_FIELDS = (TEMPERATURE, DEW_POINT, PRESSURE, WIND, CEILING, VISIBILITY)
LABEL = "temperature"
POSITION_COLUMNS = ("LATITUDE", "LONGITUDE", "ELEVATION")
PACKED_COLUMNS = ("WND", "CIG", "VIS", "TMP", "DEW", "SLP")
EMPTY_COLUMNS = (
    "SOURCE", "NAME", "REPORT_TYPE", "CALL_SIGN", "QUALITY_CONTROL", "AA1", "AA2", "AA3", "AJ1", "AY1", "AY2", "GA1", "GA2",
    "GA3", "GE1", "GF1", "IA1", "KA1", "KA2", "MA1", "MD1", "MW1", "OC1", "OD1", "SA1", "UA1", "REM", "EQD",
)


class FeaturePlan(NamedTuple):
    fields: tuple[FieldSpec, ...]
    features: tuple[str, ...]
    day_name: str
    day_period: int
    pi: float = 3.141592653589793
    sphere: bool = True
    label_bounds: tuple[float, float] | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return (LABEL, *self.features)


PRODUCTION = FeaturePlan(
    (DEW_POINT, PRESSURE, WIND, CEILING, VISIBILITY),
    (
        "geo_x", "geo_y", "geo_z", "elevation", "dew_clean", "slp_clean", "wind_speed",
        "cloud_ceiling", "visibility", "hour_sin", "hour_cos", "day_of_year_sin", "day_of_year_cos",
    ),
    "day_of_year", 365, 3.14159265359, True, (-100.0, 60.0),
)
BASELINE = FeaturePlan(
    (
        DEW_POINT, PRESSURE, WIND._replace(output="wind_speed_clean"),
        CEILING._replace(output="ceiling_height_clean"), VISIBILITY._replace(output="visibility_dist_clean"),
    ),
    (
        "elevation", "geo_x", "geo_y", "geo_z", "dew_clean", "slp_clean", "wind_speed_clean",
        "ceiling_height_clean", "visibility_dist_clean", "hour_sin", "hour_cos", "day_sin", "day_cos",
    ),
    "day", 366,
)
COMPACT = FeaturePlan(
    (DEW_POINT, PRESSURE),
    ("latitude", "longitude", "elevation", "dew_clean", "slp_clean", "hour_sin", "hour_cos", "day_sin", "day_cos"),
    "day", 366, sphere=False,
)

_OBS = f"obs AS ({OBS_SQL})"
_KEYS = 'k, "STATION", "DATE"'
_IN_TRAIN = (
    "CAST('0x' || substr(md5(CAST(k AS VARCHAR) || '|' || \"STATION\" || '|' || \"DATE\"), 1, 8) AS BIGINT)"
    " < 3006477107"
)


def _r6(value: str, name: str) -> str:
    return f'round({value}, 6) + 0.0 AS "{name}"'


def _part(column: str, index: int) -> str:
    return f"string_split(\"{column}\", ',')[{index + 1}]"


def _value(spec: FieldSpec) -> str:
    return _part(spec.column, spec.value_part)


def _flag(spec: FieldSpec) -> str:
    return _part(spec.column, spec.flag_part)


def _reported(spec: FieldSpec) -> str:
    return f"{_value(spec)} <> '{spec.missing}'"


def _trusted(spec: FieldSpec) -> str:
    return f"{_flag(spec)} IN ({', '.join(repr(f) for f in spec.good_flags)})"


def _packed(spec: FieldSpec) -> str:
    return f"contains(\"{spec.column}\", ',')"


def _keep(spec: FieldSpec) -> str:
    return f"{_packed(spec)} AND {_reported(spec)} AND {_trusted(spec)}"


def _number(spec: FieldSpec) -> str:
    return f"try_cast({_value(spec)} AS DOUBLE) / {spec.scale}"


def _with_obs(select: str) -> str:
    return f"WITH {_OBS} {select}"


def _cyclic(value: str, period: int, name: str, pi: float) -> dict[str, str]:
    return {f"{name}_{f}": f"{f}({value} * 2 * {pi!r} / {period})" for f in ("sin", "cos")}


_HOUR = 'hour(CAST("DATE" AS TIMESTAMP))'
_DAY = 'dayofyear(CAST("DATE" AS TIMESTAMP))'
_SPHERE = {
    "geo_x": 'cos(radians("LATITUDE")) * cos(radians("LONGITUDE"))',
    "geo_y": 'cos(radians("LATITUDE")) * sin(radians("LONGITUDE"))',
    "geo_z": 'sin(radians("LATITUDE"))',
}


def _filters(plan: FeaturePlan) -> list[tuple[str, str]]:
    """Row tests in order; the recipe's own or, for its model table, also the elevation."""
    tests = [(spec.column, _keep(spec)) for spec in (TEMPERATURE, *plan.fields)]
    if plan.label_bounds:
        low, high = plan.label_bounds
        tests.append((LABEL, f"{_number(TEMPERATURE)} BETWEEN {low} AND {high}"))
    tests.append(("elevation", '"ELEVATION" <> -999.9'))
    return tests


def _features(plan: FeaturePlan) -> str:
    """CTE ``f``: row keys, label, features."""
    columns = {
        LABEL: _number(TEMPERATURE),
        "elevation": '"ELEVATION"',
        **_cyclic(_HOUR, 24, "hour", plan.pi),
        **_cyclic(_DAY, plan.day_period, plan.day_name, plan.pi),
        **(_SPHERE if plan.sphere else {"latitude": '"LATITUDE"', "longitude": '"LONGITUDE"'}),
        **{spec.output: _number(spec) for spec in plan.fields},
    }
    listed = ", ".join(f"{columns[c]} AS {c}" for c in plan.columns)
    tests = " AND ".join(f"({test})" for _, test in _filters(plan))
    return f"{_OBS}, f AS (SELECT {_KEYS}, {listed} FROM obs WHERE {tests})"


def _union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


def _field_filter(test) -> str:
    tests = " AND ".join(f"({test(spec)})" for spec in ALL_FIELDS)
    names = ", ".join(f'"{c}"' for c in PACKED_COLUMNS)
    return _with_obs(f"SELECT k, {names} FROM obs WHERE {tests}")


def _clean(spec: FieldSpec) -> str:
    return _with_obs(f'SELECT k, "{spec.column}", {_number(spec)} AS {spec.output} FROM obs WHERE {_keep(spec)}')


def _feature_table(plan: FeaturePlan) -> str:
    return f"WITH {_features(plan)} SELECT {_KEYS}, {', '.join(_r6(c, c) for c in plan.columns)} FROM f"


def _prepared(keys: str = _KEYS, more: str = "") -> str:
    plan = PRODUCTION
    computed = {
        **_cyclic(_HOUR, 24, "hour", plan.pi),
        **_cyclic(_DAY, plan.day_period, plan.day_name, plan.pi),
        **_SPHERE,
        **{spec.output: _number(spec) for spec in (TEMPERATURE, *plan.fields)},
        "elevation": '"ELEVATION"',
    }
    tests = " AND ".join(f"({test})" for _, test in _filters(plan))
    return _with_obs(
        f'SELECT {keys}, "TMP", {", ".join(_r6(v, n) for n, v in computed.items())}, {more}'
        "array_to_string(string_split(\"TMP\", ','), '|') AS tmp_parts, "
        f"{_value(TEMPERATURE)} AS tmp_value, {_flag(TEMPERATURE)} AS tmp_flag, "
        "strftime(CAST(\"DATE\" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS timestamp "
        f"FROM obs WHERE {tests}"
    )


_NUMBERS = (
    f"{_OBS}, numbers AS (SELECT {_KEYS}, {', '.join(repr_ for repr_ in (chr(34) + c + chr(34) for c in POSITION_COLUMNS))}, "
    f"{', '.join(f'{_number(s)} AS {s.output}' for s in ALL_FIELDS)} FROM obs)"
)
_NUMBER_COLUMNS = (*POSITION_COLUMNS, *[s.output for s in ALL_FIELDS])


def _rows_kept() -> str:
    tests = [("read", "true"), *_filters(PRODUCTION)]
    return _with_obs(
        _union(
            [
                f"SELECT '{name}' AS step, {i} AS position, "
                f"count(*) FILTER (WHERE {' AND '.join(f'({t})' for _, t in tests[: i + 1])}) AS rows FROM obs"
                for i, (name, _) in enumerate(tests)
            ]
        )
    )


def _summary(source: str, table: str, columns, extra: str = "") -> str:
    return f"WITH {source} " + _union(
        [
            f"SELECT '{c}' AS \"column\", count(\"{c}\") AS count, {_r6(f'avg({chr(34)}{c}{chr(34)})', 'mean')}, "
            f"{_r6(f'stddev_samp({chr(34)}{c}{chr(34)})', 'stddev')}, {_r6(f'min({chr(34)}{c}{chr(34)})', 'min')}, "
            f"{_r6(f'max({chr(34)}{c}{chr(34)})', 'max')}{extra.replace('?', c)} FROM {table}"
            for c in columns
        ]
    )


def _summary_text() -> str:
    return _with_obs(
        _union(
            [
                f"SELECT '{c}' AS \"column\", count(\"{c}\") AS count, "
                f"{_r6(f'avg(try_cast({chr(34)}{c}{chr(34)} AS DOUBLE))', 'mean')}, "
                f"{_r6(f'stddev_samp(try_cast({chr(34)}{c}{chr(34)} AS DOUBLE))', 'stddev')}, "
                f'min("{c}") AS min, max("{c}") AS max FROM obs'
                for c in ("STATION", "DATE", *PACKED_COLUMNS)
            ]
        )
    )


def _quantiles() -> str:
    columns = ("temperature", "elevation", "dew_clean", "slp_clean", "wind_speed", "cloud_ceiling", "visibility")
    return f"WITH {_features(PRODUCTION)} " + _union(
        [
            f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS probability, "
            f"{_r6(f'quantile_cont({c}, {p})', 'quantile')} FROM f"
            for c in columns
            for p in (0.05, 0.25, 0.5, 0.75, 0.95)
        ]
    )


def _column_info() -> str:
    types = {"k": "bigint", **{c: "double" for c in POSITION_COLUMNS}}
    names = ("k", "STATION", "DATE", *POSITION_COLUMNS, *PACKED_COLUMNS)
    return _with_obs(
        _union(
            [
                f"SELECT {i} AS position, '{c}' AS \"column\", '{types.get(c, 'string')}' AS type, "
                f'count("{c}") AS non_null FROM obs'
                for i, c in enumerate(names)
            ]
        )
    )


def _correlation(source: str, table: str, columns) -> str:
    return f"WITH {source} " + _union(
        [
            f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {_r6(f'corr({chr(34)}{a}{chr(34)}, {chr(34)}{b}{chr(34)})', 'corr')} FROM {table}"
            for a in columns
            for b in columns
        ]
    )


def _standardised(fit_on: str, apply_to: str) -> str:
    names = PRODUCTION.features
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in names)
    scaled = ", ".join(_r6(f"({c} - m_{c}) / s_{c}", c) for c in names)
    return (
        f"WITH {_features(PRODUCTION)}, m AS (SELECT {moments} FROM f WHERE {fit_on}) "
        f"SELECT {_KEYS}, {scaled} FROM f, m WHERE {apply_to}"
    )


def _linear_one() -> str:
    return (
        f"WITH {_features(PRODUCTION)}, line AS (SELECT regr_slope({LABEL}, dew_clean) AS slope, "
        f"regr_intercept({LABEL}, dew_clean) AS base FROM f WHERE {_IN_TRAIN}) "
        f"SELECT {_KEYS}, {LABEL}, round(base + slope * dew_clean, 3) + 0.0 AS prediction "
        f"FROM f, line WHERE NOT ({_IN_TRAIN})"
    )


def _linear_all() -> str:
    """Least squares by orthogonalising one feature after the other.

    Step j takes feature j out of the features after it and out of the label,
    with slopes from the training rows; what is left of the label at the end
    is the residual.
    """
    names = [*PRODUCTION.features, "rest"]
    moments = ", ".join(f"avg({c}) AS m_{c}" for c in (*PRODUCTION.features, LABEL))
    centred = ", ".join([f"{c} - m_{c} AS {c}" for c in PRODUCTION.features] + [f"{LABEL} - m_{LABEL} AS rest"])
    steps = [
        f"{_features(PRODUCTION)}, split AS (SELECT *, {_IN_TRAIN} AS fit FROM f)",
        f"m AS (SELECT {moments} FROM split WHERE fit)",
        f"g0 AS (SELECT {_KEYS}, fit, {LABEL} AS y, {centred} FROM split, m)",
    ]
    for j, done in enumerate(PRODUCTION.features):
        later = names[j + 1 :]
        slopes = ", ".join(f"sum({done} * {c}) / sum({done} * {done}) AS s_{c}" for c in later)
        steps.append(f"b{j} AS (SELECT {slopes} FROM g{j} WHERE fit)")
        left = ", ".join(f"{c} - s_{c} * {done} AS {c}" for c in later)
        steps.append(f"g{j + 1} AS MATERIALIZED (SELECT {_KEYS}, fit, y, {left} FROM g{j}, b{j})")
    last = f"g{len(PRODUCTION.features)}"
    return (
        f"WITH {', '.join(steps)} SELECT {_KEYS}, y AS {LABEL}, round(y - rest, 3) + 0.0 AS prediction "
        f"FROM {last} WHERE NOT fit"
    )


def _leafwise(rounds: int, leaves: int, bins: int, rate: float = 0.1, l2: float = 1.0, least: int = 20) -> str:
    """Boosted trees grown leaf by leaf: each step sums gradients by leaf, feature and bin, and splits where the gain is largest."""
    names, one = COMPACT.features, 1048576
    shares = ", ".join(str(i / bins) for i in range(1, bins))
    cells = ", ".join(f"b{j}" for j in range(len(names)))
    steps = [
        f"{_features(COMPACT)}, s AS (SELECT {_KEYS}, {_IN_TRAIN} AS side, {_IN_TRAIN} AND {LABEL} IS NOT NULL AS fit, {_r6(LABEL, LABEL)}, {', '.join(_r6(c, c) for c in names)} FROM f)",
        "e AS (SELECT "
        + ", ".join(f"list_distinct(list_transform(quantile_cont({c}, [{shares}]), lambda x: round(x, 6) + 0.0)) AS e{j}" for j, c in enumerate(names))
        + " FROM s WHERE fit)",
        f"g AS MATERIALIZED (SELECT {_KEYS}, side, fit, {LABEL}, CAST(floor({LABEL} * {one} + 0.5) AS BIGINT) AS y, "
        + ", ".join(f"CAST(len(list_filter(e{j}, lambda x: {c} > x)) AS INT) AS b{j}" for j, c in enumerate(names))
        + " FROM s, e)",
        f"t0 AS MATERIALIZED (SELECT {_KEYS}, side, fit, {LABEL}, y, [{cells}] AS b, (SELECT CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) FROM g WHERE fit) AS p FROM g)",
    ]
    for r in range(rounds):
        steps.append(f"r{r}n0 AS MATERIALIZED (SELECT *, 1 AS node FROM t{r})")
        for k in range(1, leaves):
            last, now = f"r{r}n{k - 1}", f"r{r}n{k}"
            steps += [
                f"{now}u AS (SELECT node, unnest(range({len(names)})) AS j, unnest(b) AS b, y - p AS g FROM {last} WHERE fit)",
                f"{now}h AS (SELECT node, j, b, sum(g) AS g, count(*) AS n FROM {now}u GROUP BY node, j, b)",
                f"{now}c AS (SELECT node, j, b, CAST(sum(g) OVER w AS DOUBLE) AS gl, CAST(sum(n) OVER w AS DOUBLE) AS nl, "
                f"CAST(sum(g) OVER a AS DOUBLE) AS gt, CAST(sum(n) OVER a AS DOUBLE) AS nt FROM {now}h "
                "WINDOW w AS (PARTITION BY node, j ORDER BY b), a AS (PARTITION BY node, j))",
                f"{now}s AS (SELECT node, j, b, gl * gl / (nl + {l2}) + (gt - gl) * (gt - gl) / (nt - nl + {l2}) - gt * gt / (nt + {l2}) AS gain "
                f"FROM {now}c WHERE nl >= {least} AND nt - nl >= {least})",
                f"{now}b AS (SELECT * FROM {now}s WHERE gain > 0 ORDER BY gain DESC, node, j, b LIMIT 1)",
                f"{now} AS MATERIALIZED (SELECT l.* EXCLUDE (node), CASE WHEN l.node = x.node THEN CASE WHEN l.b[x.j + 1] <= x.b THEN {2 * k} ELSE {2 * k + 1} END "
                f"ELSE l.node END AS node FROM {last} l LEFT JOIN {now}b x ON true)",
            ]
        end = f"r{r}n{leaves - 1}"
        steps += [
            f"r{r}v AS (SELECT node, CAST(floor({rate} * CAST(sum(y - p) AS DOUBLE) / (count(*) + {l2}) + 0.5) AS BIGINT) AS v FROM {end} WHERE fit GROUP BY node)",
            f"t{r + 1} AS MATERIALIZED (SELECT l.* EXCLUDE (node, p), l.p + x.v AS p FROM {end} l JOIN r{r}v x ON l.node = x.node)",
        ]
    return f"WITH {', '.join(steps)} SELECT {_KEYS}, {LABEL}, round(CAST(p AS DOUBLE) / {one}.0, 6) + 0.0 AS prediction FROM t{rounds} WHERE NOT side"


_FORMULAS = {"shifted": "dew_clean + 7.5", "scaled": "dew_clean * 0.9"}


def _scores() -> str:
    """CTE ``s``: position, model, rmse, r2, mae of the two fixed formulas."""
    rows = _union(
        [
            f"SELECT {i} AS position, '{name}' AS model, "
            f"{_r6(f'sqrt(avg(pow({LABEL} - ({p}), 2)))', 'rmse')}, "
            f"{_r6(f'1 - sum(pow({LABEL} - ({p}), 2)) / (var_pop({LABEL}) * count({LABEL}))', 'r2')}, "
            f"{_r6(f'avg(abs({LABEL} - ({p})))', 'mae')} FROM f"
            for i, (name, p) in enumerate(_FORMULAS.items())
        ]
    )
    return f"WITH {_features(PRODUCTION)}, s AS ({rows})"


def _predicted(plan: FeaturePlan) -> str:
    """Every test row; what the predictions must satisfy."""
    return f"WITH {_features(plan)} SELECT {_KEYS}, {LABEL}, true AS in_range, true AS learned FROM f WHERE NOT ({_IN_TRAIN})"


def _search(grid: tuple[str, ...]) -> str:
    return _union([f"SELECT '{params}' AS params, true AS ordered, true AS advanced_right" for params in grid])


def _hash_of_keys(salt: str = "") -> str:
    before = f"'{salt}|' || " if salt else ""
    return f"CAST('0x' || substr(md5({before}CAST(k AS VARCHAR) || '|' || \"STATION\" || '|' || \"DATE\"), 1, 8) AS BIGINT)"


def _search_record(columns: tuple[str, ...], fractions: tuple[float, ...], ratio: float, top_n: int) -> str:
    """One-feature lines with and without intercept, fitted on hash samples and scored on their held-out part."""
    rows = _union(
        [
            f"SELECT {phase} AS phase, '{c}_vector' AS feature, {c} AS x, {LABEL} AS y, validation < {round(ratio * 2**32)} AS fitted "
            f"FROM t WHERE sample < {round(fraction * 2**32)}"
            for phase, fraction in enumerate(fractions, 1)
            for c in columns
        ]
    )
    metrics = _union(
        [
            f"SELECT phase, 'featuresCol=' || feature || ', fitIntercept={spelled}' AS params, sqrt(avg(pow(y - ({line}), 2))) AS metric "
            "FROM r JOIN lines USING (phase, feature) WHERE NOT fitted GROUP BY phase, feature"
            for spelled, line in (("True", "slope * x + base"), ("False", "ratio * x"))
        ]
    )
    return (
        f"WITH {_features(PRODUCTION)}, t AS (SELECT *, {_hash_of_keys('sample 42')} AS sample, {_hash_of_keys('validation 42')} AS validation "
        f"FROM f WHERE {_IN_TRAIN}), r AS ({rows}), "
        "lines AS (SELECT phase, feature, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, sum(x * y) / sum(x * x) AS ratio "
        f"FROM r WHERE fitted GROUP BY phase, feature), m AS ({metrics}), "
        "first AS (SELECT *, row_number() OVER (ORDER BY metric, params) AS place FROM m WHERE phase = 1), "
        f"later AS (SELECT m.* FROM m JOIN first ON m.params = first.params AND first.place <= {top_n} WHERE m.phase = 2), "
        "every AS (SELECT phase, params, metric FROM first UNION ALL SELECT phase, params, metric FROM later) "
        "SELECT phase, params, round(metric, 4) + 0.0 AS metric, "
        "CAST(row_number() OVER (PARTITION BY phase ORDER BY metric, params) AS INT) AS rank FROM every"
    )


def _files() -> str:
    names = ", ".join(f'"{c}"' for c in ("STATION", "DATE", *POSITION_COLUMNS, *PACKED_COLUMNS))
    return _with_obs(f"SELECT {names} FROM obs")


ORACLE: dict[str, str] = {
    "obs_raw": _with_obs(
        f"SELECT {_KEYS}, {', '.join(chr(34) + c + chr(34) for c in (*POSITION_COLUMNS, *PACKED_COLUMNS))} FROM obs"
    ),
    "csv_roundtrip": _files(),
    "csv_by_header": _files(),
    "csv_inferred": _files().replace(
        'SELECT "STATION", "DATE"',
        "SELECT \"STATION\", strftime(CAST(\"DATE\" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS \"DATE\"",
    ),
    "filter_packed": _field_filter(_packed),
    "filter_reported": _field_filter(_reported),
    "filter_trusted": _field_filter(_trusted),
    "split_parts": _with_obs("SELECT k, " + ", ".join(f"{_part('WND', i)} AS part_{i}" for i in range(5)) + " FROM obs"),
    "signed_text": _with_obs(
        f"SELECT k, CASE WHEN starts_with({_value(DEW_POINT)}, '+') THEN substr({_value(DEW_POINT)}, 2) "
        f"ELSE {_value(DEW_POINT)} END AS signed_value FROM obs"
    ),
    "scaled_numbers": _with_obs(
        "SELECT k, " + ", ".join(f"{_number(s)} AS {s.output}" for s in ALL_FIELDS) + " FROM obs"
    ),
    "clean_column": _with_obs(
        f"SELECT k, {_number(PRESSURE)} AS slp_clean, {_number(DEW_POINT)} AS dew_clean FROM obs "
        f"WHERE {_packed(PRESSURE)} AND {_reported(PRESSURE)} AND {_flag(PRESSURE)} = '1' AND {_keep(DEW_POINT)}"
    ),
    **{
        name: _clean(spec)
        for name, spec in zip(
            ("clean_tmp", "clean_dew_signed", "clean_slp", "clean_wind", "clean_ceiling", "clean_visibility"),
            ALL_FIELDS,
        )
    },
    "label_present": _with_obs(
        f"SELECT k, {_number(TEMPERATURE)} AS {LABEL} FROM obs "
        f"WHERE {_keep(TEMPERATURE)} AND {_number(TEMPERATURE)} IS NOT NULL"
    ),
    "label_bounds": _with_obs(
        f"SELECT k, {_number(TEMPERATURE)} AS {LABEL} FROM obs "
        f"WHERE {_keep(TEMPERATURE)} AND {_number(TEMPERATURE)} BETWEEN -100 AND 60"
    ),
    "elevation_filter": _with_obs('SELECT k, "ELEVATION" FROM obs WHERE "ELEVATION" <> -999.9'),
    "time_parts": _with_obs(
        "SELECT k, strftime(CAST(\"DATE\" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS timestamp, "
        f"CAST({_HOUR} AS INT) AS hour, CAST({_DAY} AS INT) AS day_of_year FROM obs"
    ),
    "cyclic_hour": _with_obs(
        "SELECT k, " + ", ".join(_r6(v, n) for n, v in _cyclic(_HOUR, 24, "hour", PRODUCTION.pi).items()) + " FROM obs"
    ),
    **{
        name: _with_obs(
            "SELECT k, "
            + ", ".join(_r6(v, n) for n, v in _cyclic(_DAY, p.day_period, p.day_name, p.pi).items())
            + " FROM obs"
        )
        for name, p in (("cyclic_day_365", PRODUCTION), ("cyclic_day_366", BASELINE))
    },
    "coordinates": _with_obs(
        "SELECT k, "
        + ", ".join(
            [
                _r6('"LATITUDE"', "latitude"),
                _r6('"LONGITUDE"', "longitude"),
                _r6('radians("LATITUDE")', "lat_rad"),
                _r6('radians("LONGITUDE")', "lon_rad"),
            ]
        )
        + " FROM obs"
    ),
    "geo_embed": _with_obs("SELECT k, " + ", ".join(_r6(v, n) for n, v in _SPHERE.items()) + " FROM obs"),
    "feature_table": _feature_table(PRODUCTION),
    "feature_table_baseline": _feature_table(BASELINE),
    "feature_table_compact": _feature_table(COMPACT),
    "prepared_table": _prepared(),
    "loaded_files": _prepared(
        '"STATION", "DATE"', ", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in EMPTY_COLUMNS) + ", "
    ),
    "features_label": (
        f"WITH {_features(BASELINE)} SELECT {_r6(LABEL, 'label')}, "
        + ", ".join(_r6(c, c) for c in BASELINE.features)
        + " FROM f"
    ),
    "select_subset": _with_obs('SELECT "TMP", "DEW", "WND", "SLP" FROM obs'),
    "rows_kept": _rows_kept(),
    "summary_stats": _summary(_features(PRODUCTION), "f", PRODUCTION.columns),
    "summary_text": _summary_text(),
    "summary_quartiles": _summary(
        _OBS,
        "obs",
        POSITION_COLUMNS,
        "".join(f', {_r6(f"quantile_cont({chr(34)}?{chr(34)}, {p})", n)}' for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))),
    ),
    "quantiles_features": _quantiles(),
    "null_nan_counts": f"WITH {_NUMBERS} "
    + _union(
        [
            f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS missing FROM numbers"
            for c in ("k", "STATION", "DATE", *_NUMBER_COLUMNS)
        ]
    ),
    "column_info": _column_info(),
    "correlation_long": _correlation(_features(PRODUCTION), "f", PRODUCTION.columns),
    "correlation_pairwise": _correlation(_NUMBERS, "numbers", _NUMBER_COLUMNS),
    "hash_split": _with_obs(f"SELECT {_KEYS}, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS part FROM obs"),
    "random_split": f"WITH {_features(PRODUCTION)} SELECT {_KEYS}, {_r6(LABEL, LABEL)}, 1 AS sides, true AS fair FROM f",
    "bernoulli_sample": _with_obs("SELECT count(*) AS rows, 0 AS outside, 0 AS unnested, true AS fair FROM obs"),
    "exact_sample": _with_obs(f"SELECT {_KEYS} FROM obs ORDER BY {_hash_of_keys()}, {_KEYS} LIMIT 500"),
    "first_n": _with_obs("SELECT least(10, count(*)) AS rows, 0 AS outside FROM obs"),
    **{name: _predicted(PRODUCTION) for name in ("boosted_default", "forest_default", "boosted_base", "forest_base")},
    "boosted_on_sample": _predicted(COMPACT),
    "boosted_leafwise": _leafwise(2, 4, 8),
    **{
        name: f"WITH {_features(PRODUCTION)} SELECT {_KEYS}, {LABEL}, true AS agrees FROM f WHERE NOT ({_IN_TRAIN})"
        for name in ("forest_by_nodes", "boosted_by_nodes")
    },
    "tune_boosted": _search(("maxDepth=2, stepSize=0.05", "maxDepth=2, stepSize=0.1", "maxDepth=3, stepSize=0.05", "maxDepth=3, stepSize=0.1")),
    "tune_boosted_full": _search(
        tuple(
            f"maxBins={bins}, maxDepth={depth}, maxIter={rounds}, stepSize={step}"
            for bins in (32, 64)
            for depth in (3, 5, 8)
            for rounds in (20, 50)
            for step in (0.05, 0.1)
        )
    ),
    "tune_forest": _search(
        tuple(
            f"featureSubsetStrategy={subset}, maxBins={bins}, maxDepth={depth}, numTrees={trees}, subsamplingRate={rate}"
            for subset in ("auto", "sqrt")
            for bins in (32, 64)
            for depth in (6, 10, 14)
            for trees in (50, 100)
            for rate in (0.8, 1.0)
        )
    ),
    "search_record": _search_record(("dew_clean", "slp_clean", "elevation", "hour_cos"), (0.2, 0.5), 0.8, 3),
    "train_job": f"WITH {_features(PRODUCTION)} "
    + _union(
        [
            f"SELECT '{m}' AS model, true AS best_right, true AS scored, count(*) AS rows FROM f WHERE {LABEL} IS NOT NULL"
            for m in ("Gradient Boosting Trees", "Random Forest")
        ]
    ),
    "assembled_valid_rows": f"WITH {_NUMBERS} SELECT {_KEYS}, "
    + ", ".join(_r6(f'"{c}"', c) for c in _NUMBER_COLUMNS)
    + " FROM numbers WHERE "
    + " AND ".join(f'"{c}" IS NOT NULL' for c in _NUMBER_COLUMNS),
    "standardised": _standardised("true", "true"),
    "pipeline_applied": _standardised(_IN_TRAIN, f"NOT ({_IN_TRAIN})"),
    "linear_one_feature": _linear_one(),
    "linear_all": _linear_all(),
    "score_metrics": f"{_scores()} SELECT * FROM s",
    "best_model": f"{_scores()} SELECT * FROM s ORDER BY rmse, position LIMIT 1",
    "metrics_json": (
        f"{_scores()} SELECT '2024-01-02T03:04:05' AS timestamp, "
        "(SELECT model FROM s ORDER BY rmse, position LIMIT 1) AS best_model, model, rmse, r2, mae FROM s"
    ),
    "save_reload_model": _linear_one(),
}
