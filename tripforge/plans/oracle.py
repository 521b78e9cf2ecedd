"""The same queries as plain SQL, for an engine that knows nothing of this package.

Statements are put together from named common table expressions; :func:`_sql`
adds those that a statement mentions. The dialect is DuckDB's.
"""

from __future__ import annotations

import re

from tripforge.operators import models
from tripforge.schema import (
    CATEGORY_LEVELS,
    CORRELATION_COLUMNS,
    FEATURE_COLUMNS,
    GPS_COLUMNS,
    NUMBER_COLUMNS,
    NUMERIC_INPUTS,
    TARGET,
    TRIP_COLUMNS,
    WEATHER_MEASURES,
    WEEKDAY_NAMES,
)

Q25, Q50, Q75 = ("0.25::DOUBLE", "0.5::DOUBLE", "0.75::DOUBLE")


def r(expression: str, places: int = 6) -> str:
    return f"(round_even(CAST({expression} AS DOUBLE), {places}) + 0.0::DOUBLE)"


def _haversine(prefix: str = "") -> str:
    a, b = f"radians({prefix}pickup_latitude)", f"radians({prefix}dropoff_latitude)"
    lon = f"sin((radians({prefix}dropoff_longitude) - radians({prefix}pickup_longitude)) / 2)"
    h = f"least(greatest(pow(sin(({b} - {a}) / 2), 2) + cos({a}) * cos({b}) * pow({lon}, 2), 0), 1)"
    return f"2 * 6371.0::DOUBLE * atan2(sqrt({h}), sqrt(1 - {h}))"


def _parts(ts: str = "pickup_datetime") -> str:
    return f"""
        CAST(hour({ts}) AS INTEGER) AS pickup_hour, CAST(day({ts}) AS INTEGER) AS pickup_day,
        CAST(month({ts}) AS INTEGER) AS pickup_month, CAST(isodow({ts}) - 1 AS INTEGER) AS pickup_weekday,
        CAST(coalesce(isodow({ts}) >= 6, false) AS INTEGER) AS is_weekend,
        CAST(coalesce(hour({ts}) BETWEEN 7 AND 10 OR hour({ts}) BETWEEN 16 AND 20, false) AS INTEGER) AS rush_hour"""


_MISSING_GPS = " OR ".join(f"{c} IS NULL" for c in GPS_COLUMNS)
_BAD_TIME = "pickup_datetime IS NULL OR dropoff_datetime IS NULL OR coalesce(dropoff_datetime < pickup_datetime, false)"
_BAD_PLACE = " OR ".join(
    f"NOT coalesce({end}_{axis} BETWEEN -{limit} AND {limit}, false)"
    for axis, limit in (("latitude", 90), ("longitude", 180))
    for end in ("pickup", "dropoff")
)
_BAD_VALUE = (
    "passenger_count IS NULL OR passenger_count < 1 OR trip_duration IS NULL OR trip_duration < 0 "
    "OR NOT coalesce(vendor_id IN (1, 2), false)"
)
_RULES = {
    "missing_gps_rows": _MISSING_GPS,
    "invalid_timestamp_rows": _BAD_TIME,
    "invalid_coordinate_rows": _BAD_PLACE,
    "invalid_value_rows": _BAD_VALUE,
}
_ANY_RULE = " OR ".join(f"({rule})" for rule in _RULES.values())

_NUM = NUMERIC_INPUTS


def _fence(source: str, column: str) -> str:
    q1, q3 = (f"quantile_cont({column}::DOUBLE, {q})" for q in (Q25, Q75))
    return f"SELECT {q1} - 1.5::DOUBLE * ({q3} - {q1}) AS lo, {q3} + 1.5::DOUBLE * ({q3} - {q1}) AS hi FROM {source}"


def _inside(source: str, column: str, fence: str) -> str:
    return (
        f"SELECT * FROM {source} WHERE {column} >= (SELECT lo FROM {fence}) "
        f"AND {column} <= (SELECT hi FROM {fence})"
    )


def _fitted(fit_rows: str, rounded: bool = True) -> dict[str, str]:
    fills = ", ".join(f"coalesce(median({c}::DOUBLE), 0) AS {c}" for c in _NUM)
    imputed = ", ".join(f"coalesce(x.{c}::DOUBLE, (SELECT {c} FROM fills)) AS {c}" for c in _NUM)
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUM)
    shown = r if rounded else str
    scaled = ", ".join(
        shown(f"(i.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END") + f" AS num__{c}" for c in _NUM
    )
    levels = ", ".join(
        f"CAST(CASE WHEN CAST(i.{c} AS VARCHAR) = '{level}' THEN 1 ELSE 0 END AS DOUBLE) AS cat__{c}_{level}"
        for c, all_levels in CATEGORY_LEVELS.items()
        for level in all_levels
    )
    keep = "x.id, x.vendor_id, x.store_and_fwd_flag, CAST(x.trip_duration AS DOUBLE) AS trip_duration"
    return {
        "fills": f"SELECT {fills} FROM {fit_rows}",
        "seen": f"SELECT {imputed} FROM {fit_rows} x",
        "imputed": f"SELECT {keep}, {imputed} FROM trimmed x",
        "moments": f"SELECT {moments} FROM seen",
        "feature_rows": f"SELECT i.id, {scaled}, {levels}, i.trip_duration FROM imputed i, moments",
    }


_TRIPS = """
    SELECT CAST(event_id AS VARCHAR) AS id,
        CAST(CASE WHEN event_id % 211 = 0 THEN 3 ELSE user_id % 2 + 1 END AS INTEGER) AS vendor_id,
        ts AS pickup_datetime,
        CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 MINUTE ELSE ts + to_seconds(secs) END AS dropoff_datetime,
        CAST(CASE WHEN event_id % 89 = 0 THEN 0 ELSE user_id % 6 + 1 END AS INTEGER) AS passenger_count,
        CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN -191.0::DOUBLE
            ELSE -74.02::DOUBLE + (event_id % 97) * 0.001::DOUBLE END AS pickup_longitude,
        40.70::DOUBLE + (event_id % 83) * 0.001::DOUBLE AS pickup_latitude,
        -74.02::DOUBLE + ((event_id * 7) % 97) * 0.001::DOUBLE AS dropoff_longitude,
        40.70::DOUBLE + ((event_id * 11) % 83) * 0.001::DOUBLE AS dropoff_latitude,
        CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        secs AS trip_duration
    FROM (SELECT *, CAST(floor(value * 30) AS BIGINT) + 60 AS secs FROM events
          UNION ALL
          SELECT *, CAST(floor(value * 30) AS BIGINT) + 60 AS secs FROM events WHERE event_id % 199 = 0)"""

_CTES = {
    "trips": _TRIPS,
    "read_text": """
        SELECT id, vendor_id::DOUBLE AS vendor_id,
            CASE WHEN id::BIGINT % 71 = 0 THEN NULL ELSE date_trunc('second', pickup_datetime) END AS pickup_datetime,
            date_trunc('second', dropoff_datetime) AS dropoff_datetime,
            CASE WHEN id::BIGINT % 61 = 0 THEN NULL ELSE passenger_count::DOUBLE END AS passenger_count,
            pickup_longitude,
            CASE WHEN id::BIGINT % 67 = 0 THEN NULL ELSE pickup_latitude END AS pickup_latitude,
            dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration::DOUBLE AS trip_duration
        FROM trips""",
    "valid": f"SELECT DISTINCT * FROM trips WHERE NOT ({_ANY_RULE})",
    "weather": """
        SELECT ts AS weather_datetime, value / 10 AS temperature_c,
            CASE WHEN event_id % 5 <> 0 THEN value / 100 END AS precipitation_mm,
            value / 4 AS wind_speed_kmh, 10.0::DOUBLE AS visibility_km
        FROM events WHERE event_type = 'view' AND hour(ts) <> 3""",
    "hourly": "SELECT date_trunc('hour', weather_datetime) AS h, "
    + ", ".join(f"avg({c}) AS {c}" for c in WEATHER_MEASURES)
    + " FROM weather GROUP BY 1",
    "joined": f"""
        SELECT v.*, {', '.join(f'w.{c}' for c in WEATHER_MEASURES)},
            CAST(coalesce({', '.join(f'w.{c}' for c in WEATHER_MEASURES)}) IS NOT NULL AS INTEGER)
                AS weather_data_available
        FROM valid v LEFT JOIN hourly w ON date_trunc('hour', v.pickup_datetime) = w.h""",
    "enriched": f"SELECT * FROM (SELECT *, {_parts()}, {_haversine()} AS distance_km FROM joined) WHERE distance_km > 0",
    "enriched_plain": f"""
        SELECT * FROM (SELECT v.*, {', '.join(f'NULL::DOUBLE AS {c}' for c in WEATHER_MEASURES)},
            0 AS weather_data_available, {_parts()}, {_haversine()} AS distance_km FROM valid v)
        WHERE distance_km > 0""",
    "measured": f"SELECT *, {_haversine()} AS distance_km FROM valid",
    "fence1": _fence("base", "distance_km"),
    "kept1": _inside("base", "distance_km", "fence1"),
    "fence2": _fence("kept1", "passenger_count"),
    "kept2": _inside("kept1", "passenger_count", "fence2"),
    "fence3": _fence("kept2", "trip_duration"),
    "trimmed": _inside("kept2", "trip_duration", "fence3"),
    "typed": f"SELECT *, {_parts()} FROM trips",
    "moved": f"""
        SELECT * FROM (SELECT {_haversine()} AS distance_km, trip_duration / 60.0::DOUBLE AS duration_minutes
            FROM trips WHERE NOT ({_MISSING_GPS}))
        WHERE distance_km > 0""",
    "usual": """
        SELECT * FROM moved
        WHERE distance_km <= (SELECT quantile_cont(distance_km, 0.99::DOUBLE) FROM moved)
          AND duration_minutes <= (SELECT quantile_cont(duration_minutes, 0.99::DOUBLE) FROM moved)""",
    "city": f"""
        SELECT {_haversine()} AS distance_km FROM trips
        WHERE pickup_latitude BETWEEN 40 AND 42 AND dropoff_latitude BETWEEN 40 AND 42
          AND pickup_longitude BETWEEN -75 AND -72 AND dropoff_longitude BETWEEN -75 AND -72""",
    "predicted": """
        SELECT id, distance_km, CAST(trip_duration AS DOUBLE) AS actual,
            300 + 120 * distance_km AS predicted, 'near' AS "Model" FROM measured
        UNION ALL
        SELECT id, distance_km, CAST(trip_duration AS DOUBLE), 4000.0::DOUBLE, 'flat' FROM measured
        UNION ALL
        SELECT id, distance_km, CAST(trip_duration AS DOUBLE), 900 * distance_km - 500, 'steep' FROM measured""",
    "near": """SELECT *, actual - predicted AS error, abs(actual - predicted) AS absolute_error
        FROM predicted WHERE "Model" = 'near'""",
    "requests": """
        SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(user_id % 9 AS DOUBLE) AS passenger_count,
            value / 2 AS distance_km, hour(ts) AS pickup_hour, isodow(ts) - 1 AS pickup_weekday,
            CASE WHEN event_id % 3 <> 0 THEN value / 10 - 5 END AS temperature_c,
            CASE WHEN event_id % 3 <> 0 THEN
                CASE WHEN event_id % 53 = 0 THEN -1.0::DOUBLE ELSE value / 100 END END AS precipitation_mm,
            CASE WHEN event_id % 4 = 0 THEN value / 4 END AS wind_speed_kmh,
            user_id % 3 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS vendor_id,
            CASE WHEN event_id % 59 = 0 THEN 'X' WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag
        FROM events""",
    "request_errors": """
        SELECT *, concat_ws(',',
            CASE WHEN distance_km > 0 AND distance_km <= 200 THEN NULL ELSE 'distance_km' END,
            CASE WHEN passenger_count BETWEEN 1 AND 8 THEN NULL ELSE 'passenger_count' END,
            CASE WHEN precipitation_mm IS NULL OR precipitation_mm >= 0 THEN NULL ELSE 'precipitation_mm' END,
            CASE WHEN store_and_fwd_flag IN ('N', 'Y') THEN NULL ELSE 'store_and_fwd_flag' END,
            CASE WHEN vendor_id IN (1, 2) THEN NULL ELSE 'vendor_id' END) AS errors
        FROM requests""",
    "good": "SELECT * FROM request_errors WHERE errors = ''",
}


def _sql(body: str, **extra: str) -> str:
    """``body`` with the expressions it needs, in order of use."""
    known = {**_CTES, **extra}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN|,)\s*{name}\b", text):
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in ordered) + "\n" + body


def _count_int(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _report(source: str, raw: str) -> str:
    counts = ", ".join(f"{_count_int(rule)} AS {name}" for name, rule in _RULES.items())
    return f"""
        SELECT CAST(count(*) AS BIGINT) AS input_rows,
            CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw})) AS BIGINT) AS duplicate_rows,
            {counts}, {_count_int(_ANY_RULE)} AS removed_rows,
            (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM {source} WHERE NOT ({_ANY_RULE})))
                AS output_rows,
            'passed' AS status
        FROM {source}"""


def _trip_row(source: str) -> str:
    columns = []
    for c in TRIP_COLUMNS:
        if c.endswith("datetime"):
            columns.append(f"CAST(floor(epoch({c})) AS BIGINT) AS {c}")
        elif c.endswith("tude") or (source != "valid" and c in NUMBER_COLUMNS):
            columns.append(f"{r(c)} AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)} FROM {source}"


def _describe(source: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        q = [f"quantile_cont({c}::DOUBLE, {p})" for p in (Q25, Q50, Q75)]
        return f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", {r(f'avg({c}::DOUBLE)')} AS mean,
            {r(f'stddev_samp({c}::DOUBLE)')} AS std, {r(f'min({c})')} AS min, {r(q[0])} AS q25, {r(q[1])} AS q50,
            {r(q[2])} AS q75, {r(f'max({c})')} AS max FROM {source}"""

    return " UNION ALL ".join(one(c) for c in columns)


def _missing(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_count_int(f'{c} IS NULL')} AS missing_count,
        (round_even({_count_int(f'{c} IS NULL')}::DOUBLE / count(*) * 100, 2) + 0.0::DOUBLE) AS missing_percentage
        FROM {source}"""
        for c in TRIP_COLUMNS
    )


def _top_values(source: str, columns: dict[str, str], top: int) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {text} AS value, CAST(count(*) AS BIGINT) AS n FROM {source} GROUP BY 2"""
        for c, text in columns.items()
    )
    rank = """CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) AS INTEGER)"""
    return f"""SELECT * FROM (SELECT *, {rank} AS rank FROM ({parts})) WHERE rank <= {top}"""


def _correlations() -> str:
    # A constant column has no correlation.
    def entry(a: str, b: str) -> str:
        value = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
        if a != b:
            both = f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            flat = f"stddev_pop({a}) FILTER ({both}) = 0 OR stddev_pop({b}) FILTER ({both}) = 0"
            value = f"CASE WHEN {flat} THEN NULL ELSE corr({a}, {b}) END"
        return f"{r(value)} AS {b}"

    return " UNION ALL ".join(
        f"""SELECT '{a}' AS "column", {', '.join(entry(a, b) for b in CORRELATION_COLUMNS)} FROM typed"""
        for a in CORRELATION_COLUMNS
    )


def _histogram(source: str, column: str) -> str:
    return f"""
        WITH shown AS (SELECT {column} AS v FROM {source}
            WHERE {column} <= (SELECT quantile_cont({column}, 0.99::DOUBLE) FROM {source})),
        ends AS (SELECT min(v) AS lo, max(v) AS hi FROM shown),
        counted AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bin, count(*) AS n
            FROM shown, ends GROUP BY 1)
        SELECT CAST(b AS INTEGER) AS bin, {r('lo + b * ((hi - lo) / 50)')} AS bin_start,
            {r('lo + (b + 1) * ((hi - lo) / 50)')} AS bin_end, CAST(coalesce(n, 0) AS BIGINT) AS trips
        FROM range(50) g(b) CROSS JOIN ends LEFT JOIN counted ON counted.bin = b"""


def _metrics(where: str = "", group: str = "") -> str:
    return f"""SELECT {group + ',' if group else ''} {r('avg(abs(actual - predicted))')} AS "MAE",
        {r('sqrt(avg(pow(actual - predicted, 2)))')} AS "RMSE",
        {r('1 - sum(pow(actual - predicted, 2)) / sum(pow(actual - mean, 2))')} AS "R2"
        FROM predicted, (SELECT avg(actual) AS mean FROM predicted) {where} {'GROUP BY ' + group if group else ''}"""


def _drift(features: list[str], reference: str, current: str) -> str:
    def tall(source: str, side: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{f}' AS feature, '{side}' AS side, {f}::DOUBLE AS v FROM ({source}) WHERE {f} IS NOT NULL"
            for f in features
        )

    probs = ", ".join(f"{i / 10}::DOUBLE" for i in range(11))
    names = " UNION ALL ".join(f"SELECT '{f}' AS feature" for f in features)
    return f"""
        WITH names AS ({names}),
        tall AS ({tall(reference, 'r')} UNION ALL {tall(current, 'c')}),
        edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{probs}]))) AS e
            FROM tall WHERE side = 'r' GROUP BY 1),
        placed AS (SELECT t.feature, side, len(list_filter(e[2:len(e) - 1], lambda x: v >= x)) AS bin
            FROM tall t JOIN edges USING (feature) WHERE len(e) >= 2),
        grid AS (SELECT feature, unnest(range(len(e) - 1)) AS bin FROM edges WHERE len(e) >= 2),
        sizes AS (SELECT feature, count(*) FILTER (WHERE side = 'r') AS rs, count(*) FILTER (WHERE side = 'c') AS cs
            FROM tall GROUP BY 1),
        counted AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE p.side = 'r') AS r,
            count(*) FILTER (WHERE p.side = 'c') AS c
            FROM grid g LEFT JOIN placed p ON p.feature = g.feature AND p.bin = g.bin GROUP BY 1, 2),
        shares AS (SELECT feature, greatest(r / rs::DOUBLE, 1e-6::DOUBLE) AS ex, greatest(c / cs::DOUBLE, 1e-6::DOUBLE) AS ac
            FROM counted JOIN sizes USING (feature) WHERE rs > 0 AND cs > 0),
        scores AS (SELECT feature, sum((ac - ex) * ln(ac / ex)) AS psi FROM shares GROUP BY 1),
        means AS (SELECT feature, avg(v) FILTER (WHERE side = 'r') AS rm, avg(v) FILTER (WHERE side = 'c') AS cm
            FROM tall GROUP BY 1),
        scored AS (SELECT n.feature, rm, cm, coalesce(psi, 0) AS psi
            FROM names n LEFT JOIN means USING (feature) LEFT JOIN scores USING (feature))"""


_DRIFT_ROWS = f"""SELECT feature, {r('rm')} AS reference_mean, {r('cm')} AS current_mean,
    {r('abs(cm - rm) / greatest(abs(rm), 1e-6::DOUBLE)')} AS relative_mean_shift, {r('psi')} AS psi,
    CAST(psi >= 0.2::DOUBLE AS INTEGER) AS drift_detected FROM scored"""


_WATCHED = ["distance_km", "pickup_hour", "pickup_weekday", *WEATHER_MEASURES]
_HASH = "substr(md5(id || '|42'), 1, 8) < '33333333'"
_FEATURES = f"SELECT id, {', '.join(FEATURE_COLUMNS)}, trip_duration FROM feature_rows"
_WEATHER_ROUNDED = ", ".join(f"{r(c)} AS {c}" for c in WEATHER_MEASURES)
_BASE = {"base": "SELECT * FROM enriched"}
_BASE_PLAIN = {"base": "SELECT * FROM enriched_plain"}
_TRAIN = {"train_rows": f"SELECT * FROM trimmed WHERE NOT ({_HASH})"}


def _counts(column: str, source: str = "typed", where: str = "", value: str | None = None) -> str:
    return f"""SELECT {value or column} AS {column}, CAST(count(*) AS BIGINT) AS trips FROM {source}
        WHERE {column} IS NOT NULL {where} GROUP BY 1"""


def statements() -> dict[str, str]:
    drift_pair = _drift(
        _WATCHED, "SELECT * FROM enriched WHERE pickup_hour < 12", "SELECT * FROM enriched WHERE pickup_hour >= 12"
    )
    shifted = _drift(
        ["distance_km"], "SELECT * FROM enriched", "SELECT distance_km + 0.35::DOUBLE AS distance_km FROM enriched"
    )
    by_weekday = " UNION ALL ".join(
        "SELECT CAST({0} AS INTEGER) AS pickup_weekday, * FROM ({1} {2}) "
        "WHERE EXISTS (SELECT 1 FROM enriched WHERE pickup_hour >= 12 AND pickup_weekday = {0})".format(
            day,
            _drift(
                ["distance_km", "temperature_c"],
                "SELECT * FROM enriched WHERE pickup_hour < 12",
                f"SELECT * FROM enriched WHERE pickup_hour >= 12 AND pickup_weekday = {day}",
            ),
            _DRIFT_ROWS,
        )
        for day in range(7)
    )
    searched = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS setting, CAST({drawn['maxIter']} AS INTEGER) AS trees"
        for i, drawn in enumerate(models.drawn_settings())
    )
    lineitem = [
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    ]
    weekday = f"CASE pickup_weekday {' '.join(f'''WHEN {i} THEN '{n}' ''' for i, n in enumerate(WEEKDAY_NAMES))} END"
    price_quantiles = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", """
        + ", ".join(
            f"{r(f'quantile_cont({c}, {p}::DOUBLE)')} AS {n}"
            for n, p in (("q01", 0.01), ("q25", 0.25), ("q50", 0.5), ("q99", 0.99))
        )
        + " FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
    )
    quantiles_by_part = " UNION ALL ".join(
        f"""SELECT l_partkey, '{c}' AS "column", {r(f'quantile_cont({c}, 0.25::DOUBLE)')} AS q25,
        {r(f'quantile_cont({c}, 0.5::DOUBLE)')} AS q50 FROM lineitem GROUP BY l_partkey"""
        for c in ("l_extendedprice", "l_quantity")
    )
    frequent = " UNION ALL ".join(
        f"""(SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n,
        CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INTEGER) AS rank
        FROM lineitem GROUP BY {c} ORDER BY rank LIMIT 5000)"""
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    )
    form_rush = "(pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19) AND pickup_weekday < 5"
    fence_rows = " UNION ALL ".join(
        f"""SELECT {i} AS step, '{c}' AS "column", CAST((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}) AS BIGINT)
        AS removed_rows, {r('lo')} AS lower_bound, {r('hi')} AS upper_bound FROM fence{i}"""
        for i, c, a, b in (
            (1, "distance_km", "base", "kept1"),
            (2, "passenger_count", "kept1", "kept2"),
            (3, "trip_duration", "kept2", "trimmed"),
        )
    )
    split = "SELECT id, CAST({} AS INTEGER) AS is_test FROM valid"
    text_columns = {"id": "id", "store_and_fwd_flag": "store_and_fwd_flag"}
    return {
        "hourly_trip_profile": _sql(
            f"""SELECT pickup_hour, CAST(count(*) AS BIGINT) AS trips, {r('avg(distance_km)')} AS mean_km,
            {r('avg(weather_data_available)')} AS weather_share, {r('median(trip_duration) / 60')} AS median_minutes
            FROM timed GROUP BY 1""",
            timed=f"SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, {_haversine()} AS distance_km FROM joined",
        ),
        "valid_trip_rows": _sql(_trip_row("valid")),
        "validation_report": _sql(_report("trips", "trips")),
        "text_validation_report": _sql(_report("read_text", "raw_text"), raw_text=_RAW_TEXT),
        "report_of_loads": _sql(_report("read_text", "raw_text"), raw_text=_RAW_TEXT),
        "report_of_arrivals": _sql(_report("read_text", "raw_text"), raw_text=_RAW_TEXT),
        "rows_of_loads": _sql(
            _trip_row("valid_text"), valid_text=f"SELECT DISTINCT * FROM read_text WHERE NOT ({_ANY_RULE})"
        ),
        "rule_flags": _sql(
            "SELECT id, " + ", ".join(f"CAST({rule} AS INTEGER) AS {n}" for n, rule in _RULES.items()) + " FROM trips"
        ),
        "coerced_text": _sql(_trip_row("read_text")),
        "csv_trips_checked": _sql(
            _trip_row("valid_text"), valid_text=f"SELECT DISTINCT * FROM read_text WHERE NOT ({_ANY_RULE})"
        ),
        "duplicate_rows": _sql(
            """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_text)) AS BIGINT)
            AS duplicate_rows FROM raw_text""",
            raw_text=_RAW_TEXT,
        ),
        "duplicate_orders_by_status": """
            SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
            FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)""",
        "weather_by_hour": _sql(f"SELECT CAST(epoch(h) AS BIGINT) AS weather_datetime, {_WEATHER_ROUNDED} FROM hourly"),
        "exported_weather_by_hour": _sql(
            f"""SELECT CAST(epoch(h) AS BIGINT) AS weather_datetime, {r('temperature_c')} AS temperature_c,
            {r('precipitation_mm')} AS precipitation_mm, {r('wind_speed_kmh')} AS wind_speed_kmh,
            NULL::DOUBLE AS visibility_km FROM hourly"""
        ),
        "trips_with_weather": _sql(f"SELECT id, {_WEATHER_ROUNDED}, weather_data_available FROM joined"),
        "trips_with_weather_shuffled": _sql(f"SELECT id, {_WEATHER_ROUNDED}, weather_data_available FROM joined"),
        "trips_without_weather": _sql(
            """SELECT CAST(count(*) AS BIGINT) AS trips, CAST(0 AS BIGINT) AS with_temperature,
            CAST(0 AS BIGINT) AS available FROM valid"""
        ),
        "pickup_parts": _sql(
            f"""SELECT id, pickup_hour, pickup_day, pickup_month, pickup_weekday, {weekday} AS weekday_name,
            is_weekend, rush_hour FROM (SELECT id, {_parts()} FROM valid)"""
        ),
        "form_pickup_parts": _sql(
            f"""SELECT id, pickup_hour, pickup_day, pickup_month, pickup_weekday, is_weekend,
            CAST({form_rush} AS INTEGER) AS rush_hour FROM (SELECT id, {_parts()} FROM valid)"""
        ),
        "trip_distances": _sql(f"SELECT id, {r('distance_km')} AS distance_km FROM enriched"),
        "iqr_kept_trips": _sql(
            f"SELECT id, {r('distance_km')} AS distance_km, trip_duration FROM kept",
            fence=_fence("measured", "trip_duration"),
            kept=_inside("measured", "trip_duration", "fence"),
        ),
        "iqr_chain_report": _sql(fence_rows, **_BASE),
        "trimmed_trip_rows": _sql(
            f"SELECT id, {r('distance_km')} AS distance_km, passenger_count, trip_duration FROM trimmed", **_BASE
        ),
        "below_upper_percentiles": _sql(
            f"SELECT {r('distance_km')} AS distance_km, {r('duration_minutes')} AS duration_minutes FROM usual"
        ),
        "table_shape": _sql("SELECT CAST(count(*) AS BIGINT) AS row_count, 11 AS column_count FROM trips"),
        "missing_values": _sql(_missing("trips")),
        "columns_with_missing_values": _sql(f"SELECT * FROM ({_missing('read_text')}) WHERE missing_percentage > 0"),
        "numeric_summary": _sql(_describe("trips", NUMBER_COLUMNS)),
        "lineitem_numeric_summary": _describe("lineitem", lineitem),
        "text_value_counts": _sql(_top_values("trips", text_columns, 20)),
        "order_value_counts": _top_values(
            "orders", {"o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority"}, 3
        ),
        "invalid_pickup_times": _sql(
            f"SELECT {_count_int('pickup_datetime IS NULL')} AS invalid_timestamps FROM read_text"
        ),
        "trips_by_hour": _sql(_counts("pickup_hour")),
        "trips_by_weekday": _sql(f"SELECT *, {weekday} AS weekday_name FROM ({_counts('pickup_weekday')})"),
        "trips_by_month": _sql(_counts("pickup_month")),
        "trips_by_passengers": _sql(_counts("passenger_count", "read_text", value=r("passenger_count"))),
        "gps_summary": _sql(_describe("read_text", GPS_COLUMNS)),
        "city_distance_summary": _sql(_describe("city", ["distance_km"])),
        "duration_summary": _sql(_describe("trips", [TARGET])),
        "correlation_matrix": _sql(_correlations()),
        "distance_duration_correlation": _sql(
            f"SELECT CAST(count(*) AS BIGINT) AS trips, {r('corr(distance_km, duration_minutes)')} AS correlation FROM usual"
        ),
        "median_minutes_by_hour": _sql(
            f"SELECT pickup_hour, {r('median(trip_duration) / 60')} AS median_minutes FROM typed GROUP BY 1"
        ),
        "rush_hour_summary": _sql(
            f"""SELECT rush_hour, CAST(count(trip_duration) AS BIGINT) AS trips,
            {r('avg(trip_duration) / 60')} AS mean_minutes, {r('median(trip_duration) / 60')} AS median_minutes
            FROM typed GROUP BY 1"""
        ),
        "distance_histogram": _merged(_histogram("city", "distance_km")),
        "duration_histogram": _merged(
            _histogram("lengths", "duration_minutes"),
            lengths="SELECT trip_duration / 60.0::DOUBLE AS duration_minutes FROM trips",
        ),
        "price_quantiles": price_quantiles,
        "price_quantiles_by_rank": price_quantiles,
        "price_quantiles_by_part": quantiles_by_part,
        "frequent_line_keys": frequent,
        "feature_rows": _sql(_FEATURES, **_BASE, **_fitted("trimmed")),
        "feature_rows_fitted_on_train": _sql(_FEATURES, **_BASE, **_TRAIN, **_fitted("train_rows")),
        "feature_rows_without_weather": _sql(_FEATURES, **_BASE_PLAIN, **_fitted("trimmed")),
        "processed_summary": _sql(
            _describe("feature_rows", [*FEATURE_COLUMNS, TARGET]), **_BASE, **_fitted("trimmed", rounded=False)
        ),
        "stored_feature_scan": _sql(
            "SELECT id, num__distance_km, trip_duration FROM feature_rows", **_BASE, **_fitted("trimmed")
        ),
        "feature_ids": _sql(
            "SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS distinct_ids FROM enriched"
        ),
        "feature_numbers": _sql(
            f"""SELECT CAST(row_number() OVER (ORDER BY id, distance_km) AS BIGINT) AS feature_id, id,
            {r('distance_km')} AS distance_km FROM enriched WHERE isfinite(distance_km)"""
        ),
        "merged_sample": _sql("SELECT id FROM valid ORDER BY md5(id || '|42') LIMIT 1500"),
        "preview": _sql(f"SELECT * FROM ({_trip_row('valid')}) ORDER BY id LIMIT 10"),
        "random_search_coverage": _sql(
            f"""SELECT setting, fold, trees,
                CAST(count(*) FILTER (WHERE own <> fold) AS BIGINT) AS trained_rows,
                CAST(count(*) FILTER (WHERE own = fold) AS BIGINT) AS validated_rows, 1 AS scored, 1 AS best_is_least
            FROM ({searched}) CROSS JOIN (SELECT CAST(unnest(range({models.SEARCH_FOLDS})) AS INTEGER) AS fold)
            CROSS JOIN (SELECT CAST(('0x' || substr(md5(id || '|42'), 17, 8))::BIGINT % {models.SEARCH_FOLDS} AS INTEGER) AS own
                FROM train_rows ORDER BY md5(id || '|42') LIMIT {models.SEARCH_ROWS})
            GROUP BY setting, fold, trees""",
            **_BASE,
            **_TRAIN,
        ),
        "fixed_size_sample": _sql("SELECT id FROM valid ORDER BY md5(id || '|42') LIMIT 2000"),
        "hashed_split": _sql(split.format(_HASH)),
        "exact_split": _sql(
            split.format("row_number() OVER (ORDER BY md5(id || '|42')) <= ceil(0.2 * (SELECT count(*) FROM valid))")
        ),
        "tuning_sample": _sql(f"SELECT id FROM valid WHERE NOT ({_HASH}) ORDER BY md5(id || '|42') LIMIT 1000"),
        "regression_metrics": _sql(_metrics("""WHERE "Model" = 'near'""")),
        "model_comparison": _sql(_metrics(group='"Model"')),
        "best_of_comparison": _sql(f"""SELECT * FROM ({_metrics(group='"Model"')}) ORDER BY "RMSE", "Model" LIMIT 1"""),
        "largest_errors": _sql(
            f"""SELECT id, {', '.join(f'{r(c)} AS {c}' for c in
                ('distance_km', 'actual', 'predicted', 'error', 'absolute_error'))}
            FROM (SELECT * FROM near WHERE {_HASH} ORDER BY absolute_error DESC, id LIMIT 1000)"""
        ),
        "error_summary": _sql(_describe("near", ["error"])),
        "drift_metrics": _merged(drift_pair + _DRIFT_ROWS),
        "drift_of_longer_trips": _merged(shifted + _DRIFT_ROWS),
        "drift_by_weekday": _sql(by_weekday),
        "drift_report": _merged(
            drift_pair
            + """SELECT CAST(count(*) AS BIGINT) AS watched_features,
            coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE psi >= 0.2::DOUBLE), '') AS drifted_features,
            CAST(bool_or(psi >= 0.2::DOUBLE) AS INTEGER) AS retraining_triggered, 0.2::DOUBLE AS psi_threshold
            FROM scored"""
        ),
        "request_checks": _sql("SELECT request_id, errors FROM request_errors"),
        "request_inputs": _sql(
            """SELECT request_id, CAST(pickup_weekday >= 5 AS INTEGER) AS is_weekend,
            CAST(pickup_hour BETWEEN 7 AND 10 OR pickup_hour BETWEEN 16 AND 20 AS INTEGER) AS rush_hour,
            CAST(coalesce(temperature_c, precipitation_mm, wind_speed_kmh) IS NOT NULL AS INTEGER)
                AS weather_data_available,
            CAST(vendor_id = 1 AS INTEGER) AS cat__vendor_id_1, CAST(vendor_id = 2 AS INTEGER) AS cat__vendor_id_2,
            CAST(store_and_fwd_flag = 'N' AS INTEGER) AS "cat__store_and_fwd_flag_N",
            CAST(store_and_fwd_flag = 'Y' AS INTEGER) AS "cat__store_and_fwd_flag_Y" FROM good"""
        ),
        "formula_durations": _sql(
            f"""SELECT request_id, {r('s')} AS trip_duration_seconds,
            (round_even(s / 60.0::DOUBLE, 2) + 0.0::DOUBLE) AS trip_duration_minutes
            FROM (SELECT request_id, CASE WHEN distance_km * 90 - 600 < 0 THEN 0 ELSE distance_km * 90 - 600 END AS s
                FROM good)"""
        ),
        "distance_regression": _sql(
            f"""SELECT {r('avg(abs(y - b - a * x))', 4)} AS "MAE", {r('sqrt(avg(pow(y - b - a * x, 2)))', 4)} AS "RMSE",
            {r('1 - avg(pow(y - b - a * x, 2)) / var_pop(y)', 4)} AS "R2", {r('any_value(a)', 4)} AS slope,
            {r('any_value(b)', 4)} AS intercept FROM (SELECT distance_km AS x, trip_duration::DOUBLE AS y FROM measured),
            (SELECT regr_slope(trip_duration, distance_km) AS a, regr_intercept(trip_duration, distance_km) AS b
                FROM measured)"""
        ),
    }


# The text as it is written: bad values differ from each other only by their row.
_RAW_TEXT = """
    SELECT id, vendor_id, CASE WHEN id::BIGINT % 71 = 0 THEN 'not-a-timestamp'
            ELSE CAST(date_trunc('second', pickup_datetime) AS VARCHAR) END AS pickup_datetime,
        date_trunc('second', dropoff_datetime) AS dropoff_datetime, passenger_count, pickup_longitude,
        pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration
    FROM trips"""


def _merged(statement: str, **extra: str) -> str:
    """A statement with its own WITH list, preceded by the shared expressions it needs."""
    own = statement.strip().removeprefix("WITH ")
    shared = _sql(own, **extra)
    if shared == own:
        return "WITH " + own
    return shared.removesuffix(own).rstrip() + ",\n" + own
