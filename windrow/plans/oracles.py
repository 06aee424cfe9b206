"""The same results in DuckDB SQL over the given tables, written apart from the operators."""

from __future__ import annotations

FLIGHTS = """
flights AS (
  SELECT
    md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
        CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS flight_id,
    CAST(year(l_shipdate) + 23 AS INTEGER) AS "Year",
    CAST(month(l_shipdate) AS INTEGER) AS "Month",
    CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth",
    CAST(isodow(l_shipdate) AS INTEGER) AS "DayOfWeek",
    concat(' ', lower(p_brand), ' ') AS "IATA_Code_Marketing_Airline",
    concat(lower(sn.n_name), ' ') AS "Origin",
    concat(' ', lower(r_name)) AS "Dest",
    CAST(((l_orderkey * 7 + l_linenumber * 5) % 24) * 100 + l_partkey % 60 AS BIGINT)
      AS "CRSDepTime",
    CAST(((l_orderkey * 7 + l_linenumber * 6) % 24) * 100 + l_suppkey % 60 AS BIGINT)
      AS "CRSArrTime",
    CASE WHEN l_partkey % 40 = 0 THEN NULL
         ELSE l_quantity - 15 + CASE WHEN l_orderkey % 50 = 0 THEN 500
              WHEN l_orderkey % 50 = 1 THEN -150 WHEN l_orderkey % 5 = 2 THEN 60 ELSE 0 END
         END AS "DepDelay",
    CASE WHEN l_partkey % 40 = 0 OR l_partkey % 97 = 1 THEN NULL
         ELSE l_quantity - 15 + CASE WHEN l_orderkey % 50 = 0 THEN 500
              WHEN l_orderkey % 50 = 1 THEN -150 WHEN l_orderkey % 5 = 2 THEN 60 ELSE 0 END
              + (l_linenumber - 5) * 3
         END AS "ArrDelay",
    CAST(CASE WHEN l_partkey % 40 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS "Cancelled",
    CAST(CASE WHEN l_partkey % 97 = 1 THEN 1 ELSE 0 END AS DOUBLE) AS "Diverted",
    CAST(30 + (l_suppkey * 37 + l_partkey * 13) % 5100 AS DOUBLE) AS "Distance",
    CASE WHEN l_partkey % 40 = 0 OR l_partkey % 97 = 1 THEN NULL
         WHEN l_partkey % 89 = 3 THEN CAST(0 AS DOUBLE)
         ELSE CAST(floor(CAST((30 + (l_suppkey * 37 + l_partkey * 13) % 5100) * 60 AS DOUBLE)
                         / (85 + (l_orderkey % 100) * 10)) AS DOUBLE)
         END AS "AirTime",
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "FL_DATE"
  FROM lineitem
  JOIN orders    ON l_orderkey = o_orderkey
  JOIN part      ON l_partkey = p_partkey
  JOIN supplier  ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN customer  ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN region    ON cn.n_regionkey = r_regionkey
),
raw AS (SELECT * EXCLUDE ("FL_DATE") FROM flights),
bronze AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at, 'bronze' AS source_layer FROM raw
)"""

CLEAN = """
clean AS (
  SELECT * FROM bronze
  WHERE "Cancelled" = 0
    AND "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL
    AND "Distance" IS NOT NULL AND "AirTime" IS NOT NULL
    AND "ArrDelay" BETWEEN -120 AND 480 AND "DepDelay" BETWEEN -120 AND 480
    AND "Distance" BETWEEN 50 AND 5000
    AND "Distance" / nullif("AirTime", 0) * 60 BETWEEN 100 AND 1000
)"""

CATEGORY = """CASE WHEN "ArrDelay" <= 0 THEN 'On Time' WHEN "ArrDelay" <= 15 THEN 'Minor Delay'
            WHEN "ArrDelay" <= 60 THEN 'Moderate Delay' ELSE 'Severe Delay' END"""


def season(month: str, unknown: str = "Unknown") -> str:
    fall = f"WHEN {month} IN (9, 10, 11) THEN 'Fall' " if unknown != "Fall" else ""
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring' "
        f"WHEN {month} IN (6, 7, 8) THEN 'Summer' {fall}ELSE '{unknown}' END"
    )


SILVER = f"""
silver AS (
  SELECT flight_id, "Year", "Month", "DayofMonth", "DayOfWeek" AS "DAY_OF_WEEK",
    {season('"Month"')} AS "SEASON",
    upper(trim("IATA_Code_Marketing_Airline")) AS "AIRLINE",
    upper(trim("Origin")) AS "Origin", upper(trim("Dest")) AS "Dest",
    upper(trim("Origin")) || '-' || upper(trim("Dest")) AS "ROUTE",
    "CRSDepTime", CAST(floor("CRSDepTime" / 100) AS INTEGER) AS "DEP_HOUR", "CRSArrTime",
    "DepDelay", "ArrDelay", "Cancelled", "Diverted", "Distance", "AirTime",
    {CATEGORY} AS "DELAY_CATEGORY", ingested_at
  FROM clean
)"""

TARGETS = """"ArrDelay" AS target_arrival_delay,
    CAST(CASE WHEN "ArrDelay" > 15 THEN 1 ELSE 0 END AS INTEGER) AS target_is_delayed"""

FEATURES = f"""
features AS (
  SELECT flight_id, "Year", "Month", "DayofMonth", "DAY_OF_WEEK", "DEP_HOUR", "AIRLINE",
    "Origin", "Dest", "Distance", "AirTime", "DepDelay", "ArrDelay", {TARGETS}
  FROM silver
)"""

FEATURES_SIMPLE = f"""
features_simple AS (
  SELECT flight_id, "Month", "DayofMonth", "DayOfWeek",
    CAST(floor("CRSDepTime" / 100) AS INTEGER) AS "DEP_HOUR",
    {season('"Month"', 'Fall')} AS "SEASON", "IATA_Code_Marketing_Airline", "Origin", "Dest",
    "Origin" || '-' || "Dest" AS "ROUTE", "Distance", "DepDelay", "ArrDelay", {TARGETS}
  FROM raw
  WHERE "Year" = 2024 AND "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL AND "Distance" > 0
)"""

RAW_2024 = """
raw_2024 AS (SELECT *, CAST(floor("CRSDepTime" / 100) AS INTEGER) AS "DEP_HOUR"
             FROM raw WHERE "Year" = 2024)"""

N = "count(*) AS total_flights"
ARRIVAL = 'avg("ArrDelay") AS avg_arrival_delay'
DEPARTURE = 'avg("DepDelay") AS avg_departure_delay'
MEDIAN = 'median("ArrDelay") AS median_arrival_delay'
LATE = (
    'count(*) FILTER ("ArrDelay" > 15) AS delayed_flights, '
    'avg(CASE WHEN "ArrDelay" > 15 THEN CAST(1 AS DOUBLE) '
    'WHEN "ArrDelay" <= 15 THEN CAST(0 AS DOUBLE) END) AS delay_rate'
)
MILES = 'avg("Distance") AS avg_distance'
MINUTES = 'avg("AirTime") AS avg_air_time'


FRACTIONAL = {
    "total_flights": "count(*)", "avg_arrival_delay": 'avg("ArrDelay")', "avg_departure_delay": 'avg("DepDelay")',
    "median_arrival_delay": 'median("ArrDelay")', "delayed_flights": 'count(*) FILTER ("ArrDelay" > 15)',
    "delay_rate": 'avg(CAST("ArrDelay" > 15 AS DOUBLE))', "avg_distance": 'avg("Distance")',
    "avg_air_time": 'avg("AirTime")',
}


def nearest(column: str, q: float) -> str:
    known = f"{column} IS NOT NULL"
    return (
        f"list_sort(list({column}) FILTER ({known}))"
        f"[CAST(round((count({column}) - 1) * CAST({q} AS DOUBLE)) AS INTEGER) + 1]"
    )


def grouped(source: str, keys: list[str], measures: list[str], least: int = 0) -> str:
    names = ", ".join(f'"{k}"' for k in keys)
    having = f" HAVING count(*) >= {least}" if least else ""
    return f"SELECT {names}, {', '.join(measures)} FROM {source} GROUP BY {names}{having}"


AIRPORT_SIMPLE = grouped(
    "raw_2024", ["Origin", "Month"], [N, ARRIVAL, DEPARTURE, MEDIAN, LATE, MILES], 20
)
AIRLINE_SIMPLE = grouped(
    "raw_2024",
    ["IATA_Code_Marketing_Airline", "Month"],
    [N, ARRIVAL, DEPARTURE, LATE, MILES],
    20,
)
TEMPORAL_SIMPLE = grouped(
    "raw_2024", ["Month", "DayOfWeek", "DEP_HOUR"], [N, ARRIVAL, LATE], 5
)
TEMPORAL = grouped(
    "silver",
    ["Year", "Month", "DAY_OF_WEEK", "DEP_HOUR", "SEASON"],
    [N, ARRIVAL, DEPARTURE, LATE, MILES],
)

#: Bronze with the version each row belongs to: one ship year per version from 0 to 6.
VERSIONS = """
versions AS (
  SELECT *, CAST("Year" - 2018 AS INTEGER) AS _version,
    TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (("Year" - 2018) || ' days') AS _committed_at
  FROM bronze
)"""


def changes(source: str) -> str:
    return f"""
changed AS (
  SELECT * REPLACE (CAST(1 AS DOUBLE) AS "DepDelay") FROM {source}
  WHERE "Year" = 2024 AND "Month" = 1
  UNION ALL
  SELECT * REPLACE (flight_id || '-2' AS flight_id) FROM {source}
  WHERE "Year" = 2018 AND "Month" = 1
),
upserted AS (
  SELECT * FROM {source} WHERE flight_id NOT IN (SELECT flight_id FROM changed)
  UNION ALL SELECT * FROM changed
)"""


def _with(parts: list[str], select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


def on_raw(select: str, *more: str) -> str:
    return _with([FLIGHTS, *more], select)


def on_2024(select: str) -> str:
    return on_raw(select, RAW_2024)


def on_silver(select: str, *more: str) -> str:
    return _with([FLIGHTS, CLEAN, SILVER, *more], select)


def on_features(select: str, *more: str) -> str:
    return on_silver(select, FEATURES, *more)


SECONDS = """
seconds AS (
  SELECT * REPLACE (
    "ArrDelay" + CAST(CAST('0x' || substr(md5(flight_id), 1, 4) AS INTEGER) AS DOUBLE) / 65536 AS "ArrDelay",
    CASE WHEN substr(md5(flight_id), 5, 1) < '8' THEN 'HUB' ELSE "Origin" END AS "Origin")
  FROM silver
)"""


def on_seconds(keys: list[str], measures: dict[str, str]) -> str:
    """Measures over delays to the second, rounded; half of the rows belong to one airport."""
    rounded = ", ".join(f"round({name}, 6) AS {name}" for name in measures)
    names = ", ".join(f'"{k}"' for k in keys)
    table = grouped("seconds", keys, [f"{sql} AS {name}" for name, sql in measures.items()])
    return on_silver(f"SELECT {names}, {rounded} FROM ({table})", SECONDS)


RULES = [
    ("not_cancelled", '"Cancelled" = 0'),
    (
        "critical_present",
        '"ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL AND "Distance" IS NOT NULL '
        'AND "AirTime" IS NOT NULL',
    ),
    ("arrival_delay", '"ArrDelay" BETWEEN -120 AND 480'),
    ("departure_delay", '"DepDelay" BETWEEN -120 AND 480'),
    ("distance", '"Distance" BETWEEN 50 AND 5000'),
    ("speed", '"Distance" / nullif("AirTime", 0) * 60 BETWEEN 100 AND 1000'),
]


def _clean_steps() -> str:
    selects, kept = ["SELECT 0 AS step, 'all' AS rule, count(*) AS rows_left FROM raw"], []
    for step, (name, condition) in enumerate(RULES, 1):
        kept.append(f"({condition})")
        selects.append(
            f"SELECT {step}, '{name}', count(*) FROM raw WHERE {' AND '.join(kept)}"
        )
    return " UNION ALL ".join(selects)


def _clean_report() -> str:
    cases = " ".join(
        f"WHEN ({condition}) IS NOT TRUE THEN '{name}'" for name, condition in RULES
    )
    return (
        f"SELECT CASE {cases} ELSE 'kept' END AS outcome, count(*) AS row_count "
        "FROM raw GROUP BY 1"
    )


def _z_value() -> str:
    bits = " + ".join(
        f"(((r{place} >> {bit}) & 1) << {bit * 3 + place})" for place in range(3) for bit in range(8)
    )
    return f"""
SELECT flight_id, CAST({bits} AS BIGINT) AS z FROM (
  SELECT flight_id, dense_rank() OVER (ORDER BY "Year") - 1 AS r0,
    dense_rank() OVER (ORDER BY "Month") - 1 AS r1,
    dense_rank() OVER (ORDER BY "AIRLINE") - 1 AS r2
  FROM silver)"""


def _ends(table: str, entity: str, name: str) -> str:
    columns = f"'{name}' AS table_name, {entity} AS entity, \"Month\", avg_arrival_delay"
    return f"""
SELECT * FROM (SELECT 'worst' AS rank, {columns} FROM ({table})
  ORDER BY avg_arrival_delay DESC NULLS FIRST, entity DESC, "Month" DESC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'best' AS rank, {columns} FROM ({table})
  ORDER BY avg_arrival_delay ASC NULLS FIRST, entity ASC, "Month" ASC LIMIT 1)"""


def _checks(task: str, models: dict[str, list[str]], trivial: str) -> str:
    """The checks of each model beside the trivial model's score on the held-out rows."""
    rows = ", ".join(f"('{model}', '{check}')" for model, checks in models.items() for check in checks)
    return (
        f"SELECT '{task}' AS task, model, \"check\", trivial_score IS NOT NULL AS passed, trivial_score "
        f"FROM (VALUES {rows}) AS t(model, \"check\"), ({trivial})"
    )


def _model_checks(rows: str) -> tuple[str, str]:
    """Of regressors and classifiers trained on ``rows``, each with its own split."""
    regression = _checks(
        "regression",
        {"linear_regression": ["better than the mean"], "random_forest": ["better than the mean", "importances sum to 1"]},
        f"SELECT round(var_pop(target_arrival_delay), 6) AS trivial_score FROM {rows} "
        "WHERE right(md5(flight_id), 8) < '33333333'",
    )
    classification = _checks(
        "classification",
        {
            "logistic_regression": ["better than the larger class"],
            "random_forest": ["better than the larger class", "importances sum to 1"],
        },
        "SELECT round(greatest(avg(target_is_delayed), 1 - avg(target_is_delayed)), 6) AS trivial_score "
        f"FROM ({_stratified(rows)}) WHERE is_test",
    )
    return regression, classification


def _stratified(rows: str) -> str:
    return (
        "SELECT *, row_number() OVER (PARTITION BY target_is_delayed ORDER BY md5(flight_id), flight_id) "
        "<= round(count(*) OVER (PARTITION BY target_is_delayed) * CAST(0.2 AS DOUBLE)) "
        f"AS is_test FROM {rows}"
    )


NUMERIC = ["Distance", "AirTime", "DepDelay", "Month", "DayofMonth"]
CATEGORICAL = ["AIRLINE", "Origin", "Dest", "DAY_OF_WEEK", "DEP_HOUR"]
SIMPLE_MODEL = [
    "IATA_Code_Marketing_Airline", "Origin", "Dest", "SEASON", "Month", "DayofMonth", "DayOfWeek",
    "DEP_HOUR", "Distance", "DepDelay", "target_arrival_delay", "target_is_delayed",
]


def _moments(rows: str, target: str, moment: str) -> str:
    """What ``target`` adds up to over each column of the one-hot design: ``moment`` makes of
    ``total`` and ``row_count`` what is returned."""
    parts = [f"SELECT '(intercept)' AS feature, CAST(NULL AS VARCHAR) AS value, count(*) AS row_count, sum({target}) AS total FROM t"]
    parts += [
        f"SELECT '{c}', NULL, count(*), sum({target} * (\"{c}\" - m) / s) FROM t, "
        f"(SELECT avg(\"{c}\") AS m, stddev_pop(\"{c}\") AS s FROM t)"
        for c in NUMERIC
    ]
    parts += [
        f"SELECT '{c}', CAST(\"{c}\" AS VARCHAR), count(*), sum({target}) FROM t GROUP BY \"{c}\"" for c in CATEGORICAL
    ]
    return (
        f"SELECT feature, value, row_count, {moment} AS moment "
        f"FROM (WITH t AS ({rows}) {' UNION ALL '.join(parts)})"
    )


def _exact_mean(column: str) -> str:
    """A double in four limbs of 32 bits, each added up as a whole number."""
    rest, sums = f"x.{column} / 4294967296", []
    for _ in range(4):
        sums.append(f"CAST(sum(CAST(trunc({rest}) AS HUGEINT)) AS DOUBLE)")
        rest = f"(({rest}) - trunc({rest})) * 4294967296"
    total = f"(({sums[3]} / 4294967296 + {sums[2]}) / 4294967296 + {sums[1]}) + {sums[0]} * 4294967296"
    return f'({total}) / count(x.{column}) AS "{column}"'


def _importance(features: list[str]) -> str:
    score = (
        "{DepDelay} * CAST(0.9 AS DOUBLE) + {Distance} * CAST(0.002 AS DOUBLE) - {AirTime} * CAST(0.01 AS DOUBLE) "
        "+ CASE WHEN {AIRLINE} < 'BRAND#3' THEN CAST(2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    )
    used = {c: f'"{c}"' for c in ["DepDelay", "Distance", "AirTime", "AIRLINE"]}
    parts = []
    for c in features:
        order = f"ORDER BY md5('42|{c}|' || flight_id), flight_id"
        moved = (
            f'SELECT *, coalesce(lag("{c}") OVER ({order}), '
            f'last_value("{c}") OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS moved FROM features'
        )
        parts.append(
            f"SELECT '{c}' AS feature, avg(pow(target_arrival_delay - ({score.format(**used)}), 2)) AS score, "
            f"avg(pow(target_arrival_delay - ({score.format(**{**used, c: 'moved'})}), 2)) AS worse FROM ({moved})"
        )
    return (
        "SELECT feature, round(score, 6) AS score, round(worse, 6) AS shuffled_score, "
        f"round(worse - score, 6) AS importance FROM ({' UNION ALL '.join(parts)})"
    )


Z_COLUMNS = [
    "Year", "Month", "DayofMonth", "AIRLINE", "Origin", "Dest", "DEP_HOUR", "DepDelay", "Distance", "flight_id",
]


def _z_ranks() -> str:
    """Bits by need below the largest cap that fits 63, ranks by dense rank or its share, and the
    bits of all ranks from the highest of each down."""
    n = len(Z_COLUMNS)
    dense = ", ".join(f'dense_rank() OVER (ORDER BY "{c}") - 1 AS d{i}' for i, c in enumerate(Z_COLUMNS))
    sizes = " UNION ALL ".join(f'SELECT {i} AS i, count(DISTINCT "{c}") AS n FROM silver' for i, c in enumerate(Z_COLUMNS))
    rank = (
        "CASE WHEN n{i} <= (1::BIGINT << b{i}) THEN d{i} "
        "ELSE CAST(floor(d{i} * CAST(1::BIGINT << b{i} AS DOUBLE) / n{i}) AS BIGINT) END AS r{i}"
    )
    wide = ", ".join(f"max(n) FILTER (i = {i}) AS n{i}, max(b) FILTER (i = {i}) AS b{i}" for i in range(n))
    unpivoted = " UNION ALL ".join(f"SELECT flight_id, {i} AS i, r{i} AS r FROM ranked" for i in range(n))
    return f"""
SELECT flight_id, {", ".join(f"r{i}" for i in range(n))}, z FROM (
  WITH sizes AS MATERIALIZED ({sizes}),
  need AS (SELECT i, n, CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END AS need FROM sizes),
  cap AS (SELECT max(c) AS cap FROM range(0, 64) t(c) WHERE (SELECT sum(least(need, c)) FROM need) <= 63),
  bits AS MATERIALIZED (SELECT i, n, CAST(least(need, cap) AS INTEGER) AS b FROM need, cap),
  places AS (
    SELECT i, b - 1 - t AS bit, count(*) OVER () - row_number() OVER (ORDER BY t, i) AS place
    FROM (SELECT i, b, unnest(range(0, b)) AS t FROM bits)),
  ranked AS MATERIALIZED (
    SELECT flight_id, {", ".join(rank.format(i=i) for i in range(n))}
    FROM (SELECT flight_id, {dense} FROM silver), (SELECT {wide} FROM bits)),
  z AS (
    SELECT flight_id, CAST(sum(((r >> bit) & 1) << place) AS BIGINT) AS z
    FROM ({unpivoted}) JOIN places USING (i) GROUP BY flight_id)
  SELECT * FROM ranked JOIN z USING (flight_id))"""


SCALED = ["Distance", "AirTime", "DepDelay", "Month", "DayofMonth"]
LATE_CARRIERS = "\"Year\" = 2023 AND \"AIRLINE\" IN ('BRAND#1', 'BRAND#2', 'BRAND#3')"


def all_oracles() -> dict[str, str]:
    prepared = (
        'SELECT flight_id, "AIRLINE", "Origin", "Dest", "DAY_OF_WEEK", "DEP_HOUR", "Distance", '
        '"AirTime", "DepDelay", "Month", "DayofMonth", target_arrival_delay, target_is_delayed '
        "FROM features"
    )
    train = "FROM features WHERE NOT right(md5(flight_id), 8) < '33333333'"
    regression, classification = _model_checks("features")
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in SIMPLE_MODEL)
    carrier_means = (
        f"(SELECT \"AIRLINE\", avg(target_arrival_delay) AS p {train} GROUP BY \"AIRLINE\") JOIN "
        "(SELECT * FROM features WHERE right(md5(flight_id), 8) < '33333333') USING (\"AIRLINE\")"
    )
    return {
        "flights": on_raw("SELECT * FROM flights"),
        "csv_scan": on_raw("SELECT * FROM raw"),
        "bronze_rows": on_raw("SELECT * FROM bronze"),
        "bronze_year_counts": on_raw(
            'SELECT "Year", count(*) AS row_count, \'written\' AS status FROM raw GROUP BY "Year" '
            "UNION ALL SELECT 2030, 0, 'empty'"
        ),
        "silver_roundtrip": on_silver("SELECT * FROM silver"),
        "silver_upsert": on_silver("SELECT * FROM upserted", changes("silver")),
        "snapshot_latest": on_raw("SELECT * FROM upserted", changes("bronze")),
        "as_of_version": on_raw("SELECT * FROM versions WHERE _version <= 3", VERSIONS),
        "as_of_timestamp": on_raw(
            "SELECT * FROM versions WHERE _committed_at <= TIMESTAMP '2024-01-02 12:00:00'",
            VERSIONS,
        ),
        "filter_year": on_raw('SELECT * FROM raw WHERE "Year" = 2023'),
        "clean_steps": on_raw(_clean_steps()),
        "silver_clean": on_raw(
            "SELECT * EXCLUDE (ingested_at, source_layer) FROM clean", CLEAN
        ),
        "clean_report": on_raw(_clean_report()),
        "fill_nulls_by_type": on_raw(
            'SELECT * REPLACE (coalesce("DepDelay", 0) AS "DepDelay", '
            'coalesce("ArrDelay", 0) AS "ArrDelay", coalesce("AirTime", 0) AS "AirTime") FROM raw'
        ),
        "normalize_categories": on_raw(
            'SELECT flight_id, "IATA_Code_Marketing_Airline", '
            'upper(trim("IATA_Code_Marketing_Airline")) AS "AIRLINE", '
            'upper(trim("Origin")) AS "Origin", upper(trim("Dest")) AS "Dest" FROM raw'
        ),
        "derive_features": on_raw(
            'SELECT flight_id, CAST(floor("CRSDepTime" / 100) AS INTEGER) AS "DEP_HOUR", '
            f'"DayOfWeek" AS "DAY_OF_WEEK", {season(chr(34) + "Month" + chr(34))} AS "SEASON", '
            f'"Origin" || \'-\' || "Dest" AS "ROUTE", {CATEGORY} AS "DELAY_CATEGORY" FROM raw'
        ),
        "date_parts": on_raw(
            'SELECT flight_id, "FL_DATE", '
            'CAST(isodow(CAST("FL_DATE" AS DATE)) AS INTEGER) AS "DAY_OF_WEEK", '
            'CAST(month(CAST("FL_DATE" AS DATE)) AS INTEGER) AS "MONTH_NUM", '
            f"{season('month(CAST(\"FL_DATE\" AS DATE))')} AS \"SEASON\" FROM flights"
        ),
        "silver_select": on_raw(
            'SELECT * EXCLUDE ("DayOfWeek", "IATA_Code_Marketing_Airline") FROM raw'
        ),
        "silver_flights": on_silver("SELECT * FROM silver"),
        "delay_category_counts": on_silver(
            'SELECT "DELAY_CATEGORY", count(*) AS count FROM silver GROUP BY 1'
        ),
        "airport_kpis": on_silver(
            grouped(
                "silver",
                ["Origin", "Year", "Month"],
                [
                    N, ARRIVAL, DEPARTURE, MEDIAN,
                    f"{nearest('\"ArrDelay\"', 0.95)} AS p95_arrival_delay",
                    LATE, MILES, MINUTES,
                ],
            )
        ),
        "airline_kpis": on_silver(
            grouped(
                "silver",
                ["AIRLINE", "Year", "Month"],
                [
                    N, ARRIVAL, DEPARTURE, MEDIAN, LATE, MILES, MINUTES,
                    'CAST(count(DISTINCT "ROUTE") + max(CASE WHEN "ROUTE" IS NULL THEN 1 '
                    "ELSE 0 END) AS BIGINT) AS unique_routes",
                ],
            )
        ),
        "airport_kpis_fractional": on_seconds(["Origin", "Year", "Month"], {
            **FRACTIONAL, "p95_arrival_delay": nearest('"ArrDelay"', 0.95),
        }),
        "airline_kpis_fractional": on_seconds(["AIRLINE", "Year", "Month"], {
            **FRACTIONAL, "unique_routes": 'count(DISTINCT "ROUTE")',
        }),
        "temporal_kpis": on_silver(TEMPORAL),
        "route_kpis": on_silver(
            grouped(
                "silver",
                ["ROUTE", "Year", "Month"],
                [
                    N, ARRIVAL, DEPARTURE, LATE,
                    'arg_min("Distance", md5(flight_id)) AS distance', MINUTES,
                ],
                10,
            )
        ),
        "airport_kpis_simple": on_2024(AIRPORT_SIMPLE),
        "airline_kpis_simple": on_2024(AIRLINE_SIMPLE),
        "temporal_kpis_simple": on_2024(TEMPORAL_SIMPLE),
        "features_full": on_features("SELECT * FROM features"),
        "features_simple": on_raw("SELECT * FROM features_simple", FEATURES_SIMPLE),
        "feature_summary": on_raw(
            "SELECT avg(target_arrival_delay) AS avg_delay, "
            "CAST(avg(target_is_delayed) AS DOUBLE) AS delay_rate FROM features_simple",
            FEATURES_SIMPLE,
        ),
        "carrier_month_topk": on_silver(
            'SELECT "AIRLINE", "Month", count(*) AS flight_count, avg("ArrDelay") AS avg_delay, '
            'median("ArrDelay") AS median_delay FROM silver '
            f'WHERE {LATE_CARRIERS} AND "ArrDelay" > 0 GROUP BY ALL '
            'ORDER BY avg_delay DESC, "AIRLINE", "Month" LIMIT 10'
        ),
        "carrier_month_rank": on_silver(
            'SELECT "AIRLINE", "Month", count(*) AS flight_count, avg("ArrDelay") AS avg_delay '
            f"FROM silver WHERE {LATE_CARRIERS} GROUP BY ALL"
        ),
        "hourly_profile": on_silver(
            'SELECT "DEP_HOUR", round(avg(avg_arrival_delay), 6) AS avg_arrival_delay '
            f"FROM ({TEMPORAL}) GROUP BY 1"
        ),
        "season_profile": on_silver(
            'SELECT "SEASON", round(avg(delay_rate), 6) AS delay_rate '
            f"FROM ({TEMPORAL}) GROUP BY 1"
        ),
        "season_counts": on_silver('SELECT "SEASON", count(*) AS count FROM silver GROUP BY 1'),
        "target_counts": on_features(
            "SELECT target_is_delayed, count(*) AS count FROM features GROUP BY 1"
        ),
        "target_describe": on_features(
            "SELECT count(t) AS count, CAST(count(*) - count(t) AS BIGINT) AS null_count, "
            "round(avg(t), 6) AS mean, round(stddev_samp(t), 6) AS std, min(t) AS min, "
            f"{nearest('t', 0.25)} AS q25, {nearest('t', 0.5)} AS q50, {nearest('t', 0.75)} AS q75, "
            "max(t) AS max FROM (SELECT target_arrival_delay AS t FROM features)"
        ),
        "worst_best": on_2024(
            _ends(AIRPORT_SIMPLE, '"Origin"', "airport_analytics")
            + " UNION ALL "
            + _ends(AIRLINE_SIMPLE, '"IATA_Code_Marketing_Airline"', "airline_analytics")
        ),
        "worst_hours": on_2024(
            'SELECT "Month", "DayOfWeek", "DEP_HOUR", avg_arrival_delay, delay_rate '
            f"FROM ({TEMPORAL_SIMPLE}) ORDER BY avg_arrival_delay DESC NULLS FIRST, "
            '"Month", "DayOfWeek", "DEP_HOUR" LIMIT 5'
        ),
        "worst_airports": on_2024(
            f"SELECT * FROM ({AIRPORT_SIMPLE}) ORDER BY avg_arrival_delay DESC NULLS FIRST, "
            '"Origin", "Month" LIMIT 10'
        ),
        "sample_n": on_silver("SELECT * FROM silver ORDER BY md5(flight_id), flight_id LIMIT 1000"),
        "result_sizes": on_raw(
            f"SELECT 'airport_analytics' AS table_name, count(*) AS row_count, 9 AS column_count "
            f"FROM ({AIRPORT_SIMPLE}) UNION ALL "
            f"SELECT 'airline_analytics', count(*), 8 FROM ({AIRLINE_SIMPLE}) UNION ALL "
            f"SELECT 'temporal_analytics', count(*), 7 FROM ({TEMPORAL_SIMPLE}) UNION ALL "
            "SELECT 'features', count(*), 15 FROM features_simple",
            RAW_2024,
            FEATURES_SIMPLE,
        ),
        "lake_tables": on_silver(
            "SELECT 'bronze' AS table_name, count(*) AS row_count FROM raw UNION ALL "
            "SELECT 'silver', count(*) FROM silver UNION ALL "
            'SELECT \'airport_analytics\', count(*) FROM (SELECT DISTINCT "Origin", "Year", "Month" FROM silver) UNION ALL '
            'SELECT \'airline_analytics\', count(*) FROM (SELECT DISTINCT "AIRLINE", "Year", "Month" FROM silver) UNION ALL '
            f"SELECT 'temporal_analytics', count(*) FROM ({TEMPORAL}) UNION ALL "
            "SELECT 'route_analytics', count(*) FROM "
            '(SELECT 1 FROM silver GROUP BY "ROUTE", "Year", "Month" HAVING count(*) >= 10) UNION ALL '
            "SELECT 'features', count(*) FROM features",
            FEATURES,
        ),
        "lake_features": on_features(prepared),
        "table_else_csv": on_raw(
            'SELECT flight_id, "Year", "Month", \'csv\' AS origin FROM raw WHERE "Year" = 2023 UNION ALL '
            'SELECT flight_id, "Year", "Month", \'table\' FROM raw WHERE "Month" <= 6'
        ),
        "compact_rows": on_silver("SELECT * FROM silver"),
        "z_value": on_silver(_z_value()),
        "vacuum_candidates": on_raw(
            "SELECT _version, 'append' AS _operation, _committed_at, count(*) AS row_count "
            "FROM versions GROUP BY ALL",
            VERSIONS,
        ),
        "table_history": on_raw(
            "SELECT _version, 'append' AS _operation, _committed_at, count(*) AS row_count "
            "FROM versions GROUP BY ALL UNION ALL "
            "SELECT 7, 'compact', TIMESTAMP '2024-01-08 00:00:00', count(*) FROM bronze UNION ALL "
            "SELECT 8, 'replace', TIMESTAMP '2024-01-09 00:00:00', count(*) FROM upserted "
            'WHERE "Year" IN (SELECT "Year" FROM changed)',
            VERSIONS,
            changes("bronze"),
        ),
        "version_compare": on_raw(
            "SELECT 7 AS version, (SELECT count(*) FROM bronze) AS row_count, "
            "CAST(0 AS BIGINT) AS added_keys, CAST(0 AS BIGINT) AS removed_keys UNION ALL "
            "SELECT 8, (SELECT count(*) FROM upserted), (SELECT count(*) FROM upserted "
            "WHERE flight_id NOT IN (SELECT flight_id FROM bronze)), (SELECT count(*) FROM bronze "
            "WHERE flight_id NOT IN (SELECT flight_id FROM upserted))",
            changes("bronze"),
        ),
        "schema_evolution": on_raw(
            'SELECT flight_id, "Year", CASE WHEN "Year" >= 2021 THEN "FL_DATE" END AS "FL_DATE" '
            "FROM flights"
        ),
        "ml_prepared": on_features(prepared),
        "ml_scaled": on_features(
            "SELECT flight_id, "
            + ", ".join(
                f'round(("{c}" - avg("{c}") OVER ()) / stddev_pop("{c}") OVER (), 6) AS "{c}"'
                for c in SCALED
            )
            + " FROM features"
        ),
        "ml_onehot_width": on_features(
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST(count(DISTINCT \"{c}\") AS INTEGER) AS width {train}"
                for c in ["AIRLINE", "Origin", "Dest", "DAY_OF_WEEK", "DEP_HOUR"]
            )
        ),
        "ml_split": on_features(
            "SELECT flight_id, right(md5(flight_id), 8) < '33333333' AS is_test FROM features"
        ),
        "ml_split_stratified": on_features(
            "SELECT flight_id, target_is_delayed, "
            "row_number() OVER (PARTITION BY target_is_delayed ORDER BY md5(flight_id), flight_id) "
            "<= round(count(*) OVER (PARTITION BY target_is_delayed) * CAST(0.2 AS DOUBLE)) "
            "AS is_test FROM features"
        ),
        "metric_regression": on_features(
            "SELECT round(m, 6) AS mse, round(sqrt(m), 6) AS rmse, round(1 - m / v, 6) AS r2 FROM ("
            'SELECT avg(pow(target_arrival_delay - "DepDelay", 2)) AS m, '
            "var_pop(target_arrival_delay) AS v FROM features)"
        ),
        "metric_accuracy": on_features(
            "SELECT avg(CASE WHEN target_is_delayed = CASE WHEN \"DepDelay\" > 15 THEN 1 ELSE 0 END "
            "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS accuracy FROM features"
        ),
        "metric_auc": on_features(
            "SELECT round((sum(mid) FILTER (target_is_delayed = 1) - p * (p + 1) / 2) "
            "/ (p * n), 6) AS roc_auc FROM (SELECT target_is_delayed, "
            'rank() OVER (ORDER BY "DepDelay") + (count(*) OVER (PARTITION BY "DepDelay") - 1) / 2 '
            "AS mid, CAST(sum(target_is_delayed) OVER () AS DOUBLE) AS p, "
            "CAST(sum(1 - target_is_delayed) OVER () AS DOUBLE) AS n FROM features) GROUP BY p, n"
        ),
        "evolved_compact": on_raw(
            'SELECT flight_id, "Year", CASE WHEN "Year" >= 2021 THEN md5(flight_id) END AS extra FROM flights'
        ),
        "evolved_upsert": on_raw(
            "SELECT flight_id, \"Year\", \"DepDelay\", extra FROM ("
            "SELECT * REPLACE (CASE WHEN \"Year\" = 2024 AND \"Month\" = 1 THEN CAST(1 AS DOUBLE) "
            "ELSE \"DepDelay\" END AS \"DepDelay\"), "
            "CASE WHEN \"Year\" = 2024 AND \"Month\" = 1 THEN NULL WHEN \"Year\" >= 2021 "
            "THEN md5(flight_id) END AS extra FROM flights)"
        ),
        "string_partition_roundtrip": on_raw(
            "SELECT flight_id, lpad(CAST(\"Month\" * 7 AS VARCHAR), 3, '0') AS code FROM flights"
        ),
        "z_value_wide": on_silver(
            "SELECT flight_id, CAST(floor((dense_rank() OVER (ORDER BY \"Distance\") - 1) "
            "* least(256, d) / d) AS BIGINT) AS z FROM silver, "
            "(SELECT CAST(count(DISTINCT \"Distance\") AS DOUBLE) AS d FROM silver)"
        ),
        "split_plain_key": on_features(
            "SELECT n AS key, right(md5(CAST(n AS VARCHAR)), 8) < '33333333' AS is_test "
            "FROM (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS n FROM lineitem)"
        ),
        "csv_mixed_headers": on_raw(
            "SELECT flight_id, \"Year\", \"Month\", \"Distance\" FROM flights"
        ),
        "csv_bad_values": on_raw(
            "SELECT 'Month' AS column_name, CAST(count(*) FILTER (\"Month\" = 2) AS BIGINT) AS bad_count "
            "FROM flights UNION ALL SELECT 'Year', CAST(0 AS BIGINT)"
        ),
        "csv_inferred": on_raw(
            'SELECT flight_id, "Year", "Month", CASE WHEN "Year" % 3 < 2 THEN "Origin" END AS "Origin", '
            'CAST("CRSDepTime" AS INTEGER) AS "CRSDepTime", "ArrDelay", "Distance" FROM flights'
        ),
        "reingest_unchanged": on_raw(
            'SELECT "Year", CASE WHEN "Year" = 2021 THEN count(*) ELSE 0 END AS row_count, '
            "CASE WHEN \"Year\" = 2021 THEN 'written' ELSE 'unchanged' END AS status FROM flights GROUP BY \"Year\""
        ),
        "hourly_means_exact": on_silver(
            f'SELECT "DEP_HOUR", {", ".join(map(_exact_mean, ["ArrDelay", "DepDelay", "Distance"]))} FROM ('
            'SELECT "DEP_HOUR", "ArrDelay" / 3 AS "ArrDelay", "DepDelay" / 3 AS "DepDelay", "Distance" / 3 AS "Distance" '
            'FROM silver) x GROUP BY "DEP_HOUR"'
        ),
        "reingest_counts": on_raw(
            "SELECT \"Year\", CASE WHEN \"Year\" = 2020 THEN CAST(0 AS BIGINT) ELSE count(*) END AS row_count, "
            "CASE WHEN \"Year\" = 2020 THEN 'kept' ELSE 'written' END AS status FROM flights GROUP BY \"Year\""
        ),
        "ml_class_counts": on_features(
            "SELECT target_is_delayed, count(*) AS row_count, "
            "CAST(round(count(*) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS test_count "
            "FROM features GROUP BY target_is_delayed"
        ),
        "ml_one_feature": on_features(
            "SELECT round(regr_slope(target_arrival_delay, \"DepDelay\"), 6) AS slope, "
            "round(regr_intercept(target_arrival_delay, \"DepDelay\"), 6) AS intercept FROM features"
        ),
        "table_stats": on_raw(
            "SELECT 'bronze' AS table_name, CAST(8 AS INTEGER) AS version, count(*) AS row_count, "
            "false AS missing FROM upserted UNION ALL SELECT 'missing', NULL, NULL, true",
            changes("bronze"),
        ),
        "ml_regression": on_features(regression),
        "ml_classification": on_features(classification),
        "ml_metrics": on_raw(" UNION ALL ".join(_model_checks(f"(SELECT * FROM features_simple WHERE {known})")), FEATURES_SIMPLE),
        "compact_packed": on_silver("SELECT * FROM silver"),
        "clustered_rows": on_silver("SELECT * FROM silver"),
        "z_ranks_ten": on_silver(_z_ranks()),
        "ml_permutation_importance": on_features(_importance(["DepDelay", "Distance", "AirTime", "AIRLINE"])),
        "ml_category_index": on_features(
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS value, "
                f"dense_rank() OVER (ORDER BY CAST(\"{c}\" AS VARCHAR)) - 1 AS value_index "
                f"FROM (SELECT DISTINCT \"{c}\" FROM features)"
                for c in [*CATEGORICAL, "flight_id"]
            )
        ),
        "ml_normal_equations": on_features(
            _moments(f"SELECT * {train}", "target_arrival_delay", "round(total / row_count, 6)")
        ),
        "ml_logistic_equations": on_features(
            _moments(
                f"SELECT * FROM ({_stratified('features')}) WHERE NOT is_test", "target_is_delayed", "round(CAST(total AS DOUBLE), 5)"
            )
        ),
        "ml_predictions": on_features(f"SELECT flight_id, \"AIRLINE\", round(p, 6) AS prediction FROM {carrier_means}"),
        "ml_run_log": on_features(
            "SELECT 'regression_carrier_means' AS run_name, 3 AS feature_version, "
            "unnest(['mse', 'rmse', 'r2']) AS metric, unnest([round(m, 6), round(sqrt(m), 6), round(1 - m / v, 6)]) AS value "
            f"FROM (SELECT avg(pow(target_arrival_delay - p, 2)) AS m, var_pop(target_arrival_delay) AS v FROM {carrier_means})"
        ),
    }
