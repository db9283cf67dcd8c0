"""Independent SQL twins of the named queries, for DuckDB.

The twins are written from the definitions of the quantities, not from the
Spark operators: the kept row of a trip is an ordered aggregate, calendar
attributes are computed from the trips' own dates, every rate counts fact rows
and distinct days directly, ranks and deciles are counted, and regressions are
closed forms (differences of slopes or cell means, alternating demeaning for
two fixed effects).  Counts are BIGINT and ratios one DOUBLE division of exact
integers or decimals, so both engines produce identical values.
"""

from __future__ import annotations

from cordon.config import DAYPARTS, EXPECTED_RAW_COLUMNS, OVERNIGHT, TPCH_TRIPS, PipelineConfig
from cordon.operators.permutation import DRAWS, SEED
from cordon.operators.profiling import SKETCHED
from cordon.schemas import SERVING_DIMS, SERVING_FACT

CFG = TPCH_TRIPS
Z975 = 1.959963984540054


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(map(_text, values))


def _day(d) -> str:
    return f"DATE '{d.isoformat()}'"


def _hours() -> str:
    """The daypart of each hour, as a list literal."""
    names = [next((n for n, lo, hi in DAYPARTS if lo <= h <= hi), OVERNIGHT) for h in range(24)]
    return f"[{_texts(names)}]"


def _doubles(*cols: str) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in cols)


def base(cfg: PipelineConfig = CFG) -> str:
    pairs = ", ".join(f"({_text(b)}, {_text(z)})" for b in cfg.treated_boroughs for z in cfg.treated_zones)
    return f"""
WITH lines AS (
    SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, l_quantity AS qty,
           l_extendedprice::DECIMAL(12,2) * (CASE WHEN l_orderkey % 97 = 0 THEN -1 ELSE 1 END)::DECIMAL(1,0) AS fare,
           l_extendedprice::DECIMAL(12,2) * l_discount::DECIMAL(4,2) AS tip,
           s_nationkey AS pu, c_nationkey AS dz,
           o_orderdate + to_minutes(((l_orderkey * 37 + l_linenumber * 211 + l_partkey * 13) % 1440)::BIGINT) AS start
    FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN customer ON c_custkey = o_custkey
), raw AS (
    SELECT CASE ln % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 7 END::BIGINT AS VendorID,
           start AS tpep_pickup_datetime,
           start + to_minutes((CASE WHEN ok % 89 = 0 THEN -5 ELSE qty::INTEGER END + late)::BIGINT)
             AS tpep_dropoff_datetime,
           (ln % 5 + 1)::DOUBLE AS passenger_count, (qty - 1)::DECIMAL(10,2) AS trip_distance,
           CASE WHEN pk % 50 <> 0 THEN (pk % 6 + 1)::DOUBLE END AS RatecodeID, 'N' AS store_and_fwd_flag,
           pu::BIGINT AS PULocationID, dz::BIGINT AS DOLocationID, (sk % 6 + 1)::BIGINT AS payment_type,
           fare::DECIMAL(12,2) AS fare_amount, 0::DECIMAL(12,2) AS extra, 0::DECIMAL(12,2) AS mta_tax,
           tip AS tip_amount, 0::DECIMAL(12,2) AS tolls_amount, 0::DECIMAL(12,2) AS improvement_surcharge,
           fare::DECIMAL(12,2) + tip AS total_amount, 0::DECIMAL(12,2) AS congestion_surcharge,
           0::DECIMAL(12,2) AS airport_fee, strftime(start, '%Y-%m') AS trip_month
    FROM (SELECT *, unnest(CASE WHEN ok % 101 = 0 THEN [0, 5] ELSE [0] END) AS late FROM lines)
), place AS (
    SELECT n_nationkey::INTEGER AS zone_key, r_name AS borough, n_name AS zone,
           concat('Region ', n_regionkey) AS service_zone, ((r_name, n_name) IN ({pairs}))::INTEGER AS is_cbd
    FROM nation JOIN region ON r_regionkey = n_regionkey
), judged AS (
    SELECT *, coalesce(RatecodeID, {cfg.unknown_ratecode}) AS ratecode_id,
           trip_distance > 0 AS far, fare_amount >= 0 AS paid, tpep_dropoff_datetime >= tpep_pickup_datetime AS forward,
           tpep_pickup_datetime >= {_day(cfg.window_start)} AND tpep_pickup_datetime < {_day(cfg.window_end)} AS inside
    FROM raw
), kept AS (
    SELECT VendorID, tpep_pickup_datetime AS pickup_ts, PULocationID, total_amount,
           first({{'dropoff_ts': tpep_dropoff_datetime, 'passenger_count': passenger_count,
                  'trip_distance': trip_distance, 'ratecode_id': ratecode_id, 'DOLocationID': DOLocationID,
                  'payment_type': payment_type, 'fare_amount': fare_amount, 'tip_amount': tip_amount,
                  'tolls_amount': tolls_amount}}
                 ORDER BY tpep_dropoff_datetime NULLS LAST, trip_distance NULLS LAST, DOLocationID NULLS LAST,
                          payment_type NULLS LAST, fare_amount NULLS LAST, tip_amount NULLS LAST,
                          ratecode_id NULLS LAST, passenger_count NULLS LAST, tolls_amount NULLS LAST) AS r
    FROM judged WHERE far AND paid AND forward AND inside
    GROUP BY ALL
), trips AS (
    SELECT upper(md5(concat_ws('|', VendorID, strftime(pickup_ts, '%Y-%m-%d %H:%M:%S.%f'), PULocationID, total_amount)))
             AS whole_key,
           CASE WHEN VendorID IS NOT NULL AND PULocationID IS NOT NULL AND total_amount IS NOT NULL THEN whole_key END
             AS trip_key,
           pickup_ts::DATE AS day, (year(day) * 10000 + month(day) * 100 + day(day))::INTEGER AS date_key,
           date_part('hour', pickup_ts)::INTEGER AS time_key, PULocationID::INTEGER AS pu_zone_key,
           r.DOLocationID::INTEGER AS do_zone_key, VendorID::INTEGER AS vendor_key,
           r.payment_type::INTEGER AS payment_key, r.ratecode_id::INTEGER AS ratecode_key,
           r.trip_distance AS trip_distance, r.fare_amount AS fare_amount, r.tip_amount AS tip_amount,
           r.tolls_amount AS tolls_amount, total_amount, r.passenger_count::INTEGER AS passenger_count,
           ((epoch_us(r.dropoff_ts) - epoch_us(pickup_ts)) // 60000000)::INTEGER AS trip_duration_min,
           round(r.tip_amount / nullif(r.fare_amount, 0), 4)::DECIMAL(16,4) AS tip_pct,
           strftime(pickup_ts, '%Y-%m') AS year_month
    FROM kept
), fact AS (
    SELECT trips.*, place.is_cbd AS pu_is_cbd, day >= {_day(cfg.cutoff)} AS post,
           ({_hours()})[time_key + 1] AS daypart
    FROM trips LEFT JOIN place ON zone_key = pu_zone_key
), groups AS (
    SELECT pu_is_cbd, count(DISTINCT pu_zone_key) AS zones FROM fact WHERE pu_is_cbd IS NOT NULL GROUP BY pu_is_cbd
)"""


KEYS = ("trip_key, date_key, time_key, pu_zone_key, do_zone_key, vendor_key, payment_key, ratecode_key, "
        + _doubles("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")
        + ", passenger_count, trip_duration_min, " + _doubles("tip_pct"))

#: The measures of the marts over fact rows.
MEASURES = """count(*) AS trips, sum(total_amount)::DOUBLE AS revenue,
       sum(total_amount)::DOUBLE / count(total_amount)::DOUBLE AS avg_fare,
       sum(tip_pct)::DOUBLE / count(tip_pct)::DOUBLE AS avg_tip_pct,
       sum(total_amount)::DOUBLE / nullif(sum(trip_duration_min), 0)::DOUBLE AS revenue_per_min"""


def _arms(value: str) -> str:
    """The four corners of a 2x2 from rows (g, post, value)."""
    return ", ".join(
        f"any_value({value}) FILTER (WHERE g = {g} AND {'' if p == 'post' else 'NOT '}post) AS {n}_{p}"
        for g, n in ((1, "treated"), (0, "control")) for p in ("pre", "post"))


DID = "(treated_post - treated_pre) - (control_post - control_pre)"


def _volume(cutoff, before=None) -> str:
    """Corners of trips per zone and day."""
    where = f"WHERE day < {_day(before)}" if before else ""
    return f"""
arms AS (
    SELECT {_arms('rate')} FROM (
        SELECT pu_is_cbd AS g, day >= {_day(cutoff)} AS post,
               count(*)::DOUBLE / (count(DISTINCT day) * any_value(zones))::DOUBLE AS rate
        FROM fact JOIN groups USING (pu_is_cbd) {where} GROUP BY 1, 2)
)"""


def _causal(q: dict, pre: str, cfg: PipelineConfig) -> None:
    q["active_zone_counts"] = pre + "SELECT pu_is_cbd, zones::BIGINT AS n_zones FROM groups"
    q["did_volume"] = pre + "," + _volume(cfg.cutoff) + f"""
SELECT 'volume_trips_per_zone_day' AS outcome, arms.*, treated_post - treated_pre AS treated_change,
       control_post - control_pre AS control_change, {DID} AS did_estimate,
       100.0::DOUBLE * ({DID}) / treated_pre AS did_pct_of_treated_pre
FROM arms"""
    q["placebo_did"] = pre + "," + _volume(cfg.placebo_cutoff, cfg.placebo_end) + f"""
SELECT 'placebo_volume' AS test, {DID} AS placebo_did_estimate_should_be_near_zero FROM arms"""
    outcomes = " UNION ALL ".join(f"""
SELECT 'avg_{m}' AS outcome, {DID} AS did_estimate FROM (SELECT {_arms('v')} FROM (
    SELECT pu_is_cbd AS g, post, sum({m})::DOUBLE / count({m})::DOUBLE AS v
    FROM fact WHERE payment_key = {cfg.card_payment} AND pu_is_cbd IS NOT NULL GROUP BY 1, 2))"""
                                  for m in ("trip_distance", "tip_pct"))
    q["did_means"] = pre + outcomes
    rate = "count(*)::DOUBLE / (count(DISTINCT day) * any_value(zones))::DOUBLE"
    by_month = f"""
SELECT year_month, pu_is_cbd, {rate} AS rate FROM fact JOIN groups USING (pu_is_cbd) GROUP BY 1, 2"""
    label = "['control_nonCBD', 'treated_CBD'][pu_is_cbd + 1]"
    q["parallel_trends"] = pre + f"""
SELECT year_month, {label} AS grp, rate AS avg_trips_per_zone_day FROM ({by_month}) ORDER BY 1, 2"""
    q["parallel_trends_wide"] = pre + f"""
SELECT year_month, any_value(rate) FILTER (WHERE pu_is_cbd = 0) AS control_nonCBD,
       any_value(rate) FILTER (WHERE pu_is_cbd = 1) AS treated_CBD
FROM ({by_month}) GROUP BY 1 ORDER BY 1"""
    moves = [("baseline", [])] + [(f"move {z}", [z]) for z in cfg.borderline_zones]
    if len(cfg.borderline_zones) > 1:
        moves.append(("move all", list(cfg.borderline_zones)))
    listed = ", ".join(f"({_text(n)}, {_text(', '.join(m))}, [{_texts(m)}]::VARCHAR[])" for n, m in moves)
    q["did_boundary_sensitivity"] = pre + f""",
plan AS (
    SELECT scenario, moved_zones, zone_key, abs(is_cbd - list_contains(names, zone)::INTEGER) AS g
    FROM place, (VALUES {listed}) AS s(scenario, moved_zones, names)
), placed AS (
    SELECT plan.*, day, post, count(*) AS n FROM fact JOIN plan ON zone_key = pu_zone_key GROUP BY ALL
), size AS (SELECT scenario, g, count(DISTINCT zone_key) AS zones FROM placed GROUP BY 1, 2
), rates AS (
    SELECT scenario, moved_zones, g, post, sum(n)::DOUBLE / (count(DISTINCT day) * any_value(zones))::DOUBLE AS rate
    FROM placed JOIN size USING (scenario, g) GROUP BY 1, 2, 3, 4
), arms AS (SELECT scenario, moved_zones, {_arms('rate')} FROM rates GROUP BY 1, 2)
SELECT arms.*, {DID} AS did_estimate FROM arms"""


def _panel(cfg: PipelineConfig) -> str:
    """The group x day panel."""
    return """
days AS (
    SELECT day, pu_is_cbd AS g, post, count(*) AS n, any_value(groups.zones) AS zones, count(*)::DOUBLE / any_value(groups.zones)::DOUBLE AS y
    FROM fact JOIN groups USING (pu_is_cbd) GROUP BY 1, 2, 3
)"""


def _row(term: str, coef: str, var: str, n: str, k: str, cov: str, known: str, lacking: str) -> str:
    """One estimate in the shape of the regression queries; nothing but its
    size and a warning where it is not ``known``.  ``lacking``: the rank then."""
    def shown(x):
        return f"CASE WHEN {known} THEN round({x}, 8) END"
    return (f"SELECT {_text(term)} AS term, {shown(coef)} AS coef, {shown(f'sqrt({var})')} AS se, "
            f"{shown(f'{coef} / sqrt({var})')} AS z, {shown(f'{coef} - {Z975} * sqrt({var})')} AS ci_lo, "
            f"{shown(f'{coef} + {Z975} * sqrt({var})')} AS ci_hi, ({n})::BIGINT AS n, ({k})::BIGINT AS k, "
            f"{_text(cov)} AS cov_type, "
            f"CASE WHEN NOT ({known}) THEN format('rank deficient ({{}} < {{}}); not identified', {lacking}, {k}) END AS warning")


def _demeaned(rounds: int = 30) -> str:
    """Columns of the panel without month and weekday means, taken out in turn
    until nothing is left of them."""
    names = ("y", "a", "p", "ap")
    ctes = ["d0 AS (SELECT day, strftime(day, '%Y-%m') AS m, isodow(day) AS w, y, g::DOUBLE AS a, "
            "post::INTEGER::DOUBLE AS p, (g * post::INTEGER)::DOUBLE AS ap FROM days)"]
    for i in range(rounds):
        for j, by in enumerate("mw"):
            cols = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY {by}) AS {c}" for c in names)
            ctes.append(f"d{2 * i + j + 1} AS (SELECT day, m, w, {cols} FROM d{2 * i + j})")
    return ",\n".join(ctes) + f",\ndm AS (SELECT * FROM d{2 * rounds})"


def _regressions(q: dict, pre: str, cfg: PipelineConfig) -> None:
    q["did_panel"] = pre + "," + _panel(cfg) + """
SELECT day AS date, g AS pu_is_cbd, n AS trips, zones::BIGINT AS n_zones, g AS treated, post::INTEGER AS post,
       y AS trips_per_zone, strftime(day, '%Y-%m') AS month, (isodow(day) - 1)::INTEGER AS dow
FROM days"""
    # the rank of 1, treated, x, treated x: what groups and values of x there are
    q["pretrend_regression"] = pre + "," + _panel(cfg) + f""",
early AS (
    SELECT g, y, (day - (SELECT min(day) FROM days))::DOUBLE AS t FROM days WHERE day < {_day(cfg.cutoff)}
), line AS (
    SELECT g, avg(t) AS tm, avg(y) AS ym, regr_slope(y, t) AS b, regr_sxx(y, t) AS sxx FROM early GROUP BY g
), fit AS (
    SELECT sum(power((y - ym - b * (t - tm)) * (t - tm), 2) / power(sxx, 2)) * count(*) / nullif(count(*) - 4, 0) AS var,
           count(*) AS n, (SELECT sum(CASE WHEN g = 1 THEN b ELSE -b END) FROM line) AS coef,
           (SELECT coalesce(sum(1 + (sxx > 0)::INTEGER), 0) FROM line)::BIGINT AS rank
    FROM early JOIN line USING (g)
)
{_row('treated:t', 'coef', 'var', 'n', '4', 'HC1', 'rank = 4', 'rank')},
       CASE WHEN rank < 4 THEN 'not assessable'
            WHEN abs(coef / sqrt(var)) > {Z975} THEN 'significant pre-trend' ELSE 'no significant pre-trend' END AS verdict
FROM fit"""
    grid = f"""
cal AS (
    SELECT d::DATE AS day FROM range({_day(cfg.window_start)}::TIMESTAMP, {_day(cfg.window_end)}::TIMESTAMP, INTERVAL 1 DAY) r(d)
), used AS (SELECT DISTINCT pu_zone_key AS zone, pu_is_cbd AS g FROM fact WHERE pu_is_cbd IS NOT NULL
), per AS (SELECT pu_zone_key AS zone, day, count(*) AS n FROM fact GROUP BY 1, 2
), grid AS (
    SELECT zone, g, day, day >= {_day(cfg.cutoff)} AS post, coalesce(n, 0)::DOUBLE AS y
    FROM (SELECT * FROM used, cal) LEFT JOIN per USING (zone, day)
)"""
    q["did_regression"] = pre + "," + _panel(cfg) + f""",
corner AS (SELECT g, post, avg(y) AS ym, count(*) AS nc FROM days GROUP BY 1, 2
), plain AS (
    SELECT sum(power((y - ym) / nc, 2)) * count(*) / nullif(count(*) - 4, 0) AS var, count(*) AS n,
           (SELECT sum(CASE WHEN (g = 1) = post THEN ym ELSE -ym END) FROM corner) AS coef,
           (SELECT count(*) FROM corner) AS rank
    FROM days JOIN corner USING (g, post)
),{grid}, gcorner AS (SELECT g, post, avg(y) AS ym, count(*) AS nc FROM grid GROUP BY 1, 2
), pull AS (
    SELECT zone, sum(CASE WHEN (g = 1) = post THEN 1 ELSE -1 END * (y - ym) / nc) AS s, count(*) AS rows
    FROM grid JOIN gcorner USING (g, post) GROUP BY zone
), clustered AS (
    SELECT sum(s * s) * count(*) / (count(*) - 1) * (sum(rows) - 1) / (sum(rows) - 4) AS var, sum(rows) AS n,
           (SELECT sum(CASE WHEN (g = 1) = post THEN ym ELSE -ym END) FROM gcorner) AS coef,
           (SELECT count(*) FROM gcorner) AS rank
    FROM pull
)
{_row('treated:post', 'coef', 'var', 'n', '4', 'HC1', 'rank = 4', 'rank')} FROM plain
UNION ALL
{_row('treated:post', 'coef', 'var', 'n', '4', 'cluster', 'rank = 4', 'rank')} FROM clustered"""
    # orthogonal basis a, b, c of the three demeaned regressors; c is the
    # interaction with everything else taken out of it; what is left of a
    # column without variation is rounding only
    def left(col: str, of: str) -> str:
        return f"CASE WHEN sum({col} * {col}) > 1e-9 THEN sum({col} * {of}) / sum({col} * {col}) ELSE 0 END"
    q["did_regression_fe"] = pre + "," + _panel(cfg) + ",\n" + _demeaned() + f""",
o1 AS (SELECT *, p - a * (SELECT {left('a', 'p')} FROM dm) AS b FROM dm
), o2 AS (
    SELECT *, ap - a * (SELECT {left('a', 'ap')} FROM dm) - b * (SELECT {left('b', 'ap')} FROM o1) AS c
    FROM o1
), s AS (SELECT {left('a', 'y')} AS ya, {left('b', 'y')} AS yb, {left('c', 'y')} AS yc,
                sum(c * c) AS cc, count(*) AS n, count(DISTINCT m) + count(DISTINCT w) - 1 + 3 AS k,
                (count(DISTINCT m) + count(DISTINCT w) - 1 + (sum(a * a) > 1e-9)::INTEGER + (sum(b * b) > 1e-9)::INTEGER
                 + (sum(c * c) > 1e-9)::INTEGER)::BIGINT AS rank FROM o2
), fit AS (
    SELECT any_value(yc) AS coef, any_value(n) AS n, any_value(k) AS k, any_value(rank) AS rank,
           sum(power(c * (y - ya * a - yb * b - yc * c), 2)) / power(any_value(cc), 2)
             * any_value(n) / (any_value(n) - any_value(k)) AS var
    FROM o2, s
)
{_row('treated:post', 'coef', 'var', 'n', 'k', 'HC1', 'rank = k', 'rank')} FROM fit"""
    # zone and day means taken out in turn; on a full grid the first turn is exact
    turns = ["t0 AS (SELECT zone, day, y, (g * post::INTEGER)::DOUBLE AS x FROM grid)"]
    for i in range(4):
        by = ("zone", "day")[i % 2]
        turns.append(f"t{i + 1} AS (SELECT zone, day, y - avg(y) OVER (PARTITION BY {by}) AS y, "
                     f"x - avg(x) OVER (PARTITION BY {by}) AS x FROM t{i})")
    q["did_regression_two_way"] = pre + "," + grid + ",\n" + ",\n".join(turns) + f""",
size AS (
    SELECT count(*) AS n, count(DISTINCT zone) AS zones, count(DISTINCT zone) + count(DISTINCT day) - 1 + 1 AS k,
           sum(x * x) AS xx, CASE WHEN sum(x * x) > 1e-9 THEN sum(x * y) / sum(x * x) END AS coef FROM t4
), pull AS (SELECT zone, sum(x * (y - coef * x)) AS s FROM t4, size GROUP BY zone
), fit AS (
    SELECT any_value(coef) AS coef, any_value(n) AS n, any_value(k) AS k, (any_value(xx) > 1e-9) AS known,
           any_value(k - 1) AS rank,
           sum(s * s) / power(any_value(xx), 2) * any_value(zones) / (any_value(zones) - 1)
             * (any_value(n) - 1) / (any_value(n) - any_value(k)) AS var
    FROM pull, size
)
{_row('treated:post', 'coef', 'var', 'n', 'k', 'cluster', 'known', 'rank')} FROM fit"""
    q["did_permutation"] = pre.replace("WITH ", "WITH RECURSIVE ", 1) + "," + grid + f""",
delta AS (
    SELECT zone::VARCHAR AS unit, any_value(g) AS g, count_if(post) * count_if(NOT post) AS days,
           ((sum(y) FILTER (post)) * count_if(NOT post) - (sum(y) FILTER (NOT post)) * count_if(post))::HUGEINT AS v
    FROM grid GROUP BY 1
), m AS (
    SELECT count(*) AS n, count_if(g = 1)::BIGINT AS k, sum(v) AS total, sum(v) FILTER (g = 1) AS own, max(days) AS days FROM delta
), sets(size, last, total) AS (
    SELECT 1, unit, v FROM delta
    UNION ALL
    SELECT size + 1, unit, sets.total + v FROM sets, delta, m WHERE unit > last AND size < k
), many AS (SELECT count(*) AS all_sets FROM sets, m WHERE size = k
), drawn AS (
    SELECT draw, sum(v) AS total FROM (
        SELECT draw, v, k, row_number() OVER (PARTITION BY draw ORDER BY md5(concat_ws('|', '{SEED}', draw, unit))) AS pos
        FROM delta, m, many, (SELECT unnest(range(1, {DRAWS + 1})) AS draw) WHERE all_sets > {DRAWS}) WHERE pos <= k GROUP BY draw
), rated AS (
    SELECT count(*) AS sets, count_if(abs(t.total * n - m.total * k) >= abs(own * n - m.total * k)) AS hits
    FROM (SELECT sets.total FROM sets, m, many WHERE size = k AND all_sets <= {DRAWS} UNION ALL SELECT total FROM drawn) t, m
), r AS (
    SELECT *, k > 0 AND k < n AND days > 0 AS known, all_sets <= {DRAWS} AS exact, if(all_sets <= {DRAWS}, 0, 1) AS more
    FROM m, many, rated
)
SELECT n AS units, k AS treated_units,
       CASE WHEN known THEN (own * n - total * k)::DOUBLE / (k * (n - k)) / days END AS did_estimate,
       CASE WHEN known THEN if(exact, 'exact', 'drawn') END AS method,
       CASE WHEN known THEN sets + more END::BIGINT AS sets, CASE WHEN known THEN hits + more END::BIGINT AS at_least_as_large,
       CASE WHEN known THEN (hits + more)::DOUBLE / (sets + more) END AS p_value,
       CASE WHEN k = 0 THEN 'not identified: no treated unit' WHEN k = n THEN 'not identified: no untreated unit'
            WHEN days = 0 THEN 'not identified: a period has no days' END AS warning
FROM r"""


def _segments(q: dict, pre: str, cfg: PipelineConfig) -> None:
    def seg(keys: str) -> str:
        return f""",
seg AS (
    SELECT {keys}, count(*) AS trips, sum(total_amount) AS money,
           sum(total_amount)::DOUBLE / count(total_amount)::DOUBLE AS avg_fare,
           sum(total_amount)::DOUBLE / nullif(sum(trip_duration_min), 0)::DOUBLE AS eff
    FROM fact JOIN place ON zone_key = pu_zone_key GROUP BY {keys}
    HAVING count(*) >= {cfg.min_segment_trips}
), placed AS (
    SELECT *, row_number() OVER (ORDER BY eff DESC NULLS LAST, {keys}) - 1 AS pos,
           count(*) OVER () // {cfg.deciles} AS per, count(*) OVER () % {cfg.deciles} AS extra
    FROM seg
), tiled AS (  -- the first tiles hold one more
    SELECT *, CASE WHEN pos < extra * (per + 1) THEN pos // (per + 1) ELSE extra + (pos - extra * (per + 1)) // per END + 1
      AS tile FROM placed
)"""
    q["segment_top25"] = pre + seg("borough, zone, daypart") + f"""
SELECT 1 + (SELECT count(*) FROM seg o WHERE o.eff > t.eff OR (t.eff IS NULL AND o.eff IS NOT NULL)) AS efficiency_rank,
       borough, zone, daypart, trips, money::DOUBLE AS revenue, avg_fare, eff AS revenue_per_min,
       100.0::DOUBLE * money::DOUBLE / (SELECT sum(money) FROM seg)::DOUBLE AS pct_of_total_revenue,
       tile::INTEGER AS efficiency_decile
FROM tiled t ORDER BY efficiency_rank, borough, zone, daypart LIMIT {cfg.top_segments}"""
    q["segment_concentration"] = pre + seg("zone, daypart") + """
SELECT if(tile = 1, 'top_decile', 'rest') AS bucket, count(*) AS segments, sum(money)::DOUBLE AS revenue,
       100.0::DOUBLE * sum(money)::DOUBLE / (SELECT sum(money) FROM seg)::DOUBLE AS pct_of_revenue
FROM tiled GROUP BY 1"""


def _sources(q: dict, pre: str, cfg: PipelineConfig) -> None:
    money = _doubles("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                     "total_amount", "congestion_surcharge", "airport_fee")
    q["src_raw_trips"] = pre + f"""
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, {_doubles('trip_distance')}, RatecodeID,
       store_and_fwd_flag, PULocationID, DOLocationID, payment_type, {money}, trip_month FROM raw"""
    q["src_zone_lookup"] = pre + """
SELECT zone_key AS LocationID, borough AS Borough, zone AS Zone, service_zone FROM place"""
    months = pre + "SELECT trip_month, count(*) AS trips FROM raw GROUP BY ALL"
    q["ingest_pending_months"] = q["stream_ingest_months"] = months
    q["profile_rows_by_month"] = months + " ORDER BY trip_month"
    q["profile_invalid_rates"] = pre + """
SELECT count(*) AS total_rows, count(*) - count(tpep_pickup_datetime) AS null_pickup_ts,
       count(*) - count(PULocationID) AS null_pu_zone, count_if(NOT far)::BIGINT AS nonpos_distance,
       count_if(NOT paid)::BIGINT AS negative_fare, count_if(NOT forward)::BIGINT AS dropoff_before_pickup
FROM judged"""
    q["profile_value_ranges"] = pre + "SELECT " + ", ".join(
        f"{f}({c})::DOUBLE AS {f}_{n}" for c, n in (("trip_distance", "dist"), ("fare_amount", "fare"),
                                                    ("total_amount", "total")) for f in ("min", "max")) + " FROM raw"
    q["profile_cardinality_sketches"] = pre + "\nUNION ALL\n".join(
        f"SELECT {_text(n)} AS key, count(DISTINCT {c}) AS distinct_values, true AS within_bound FROM raw" for n, c in SKETCHED)
    q["profile_key_cardinality"] = pre + """
SELECT len(list_distinct(list(PULocationID)))::BIGINT AS distinct_pu_zones,
       len(list_distinct(list(payment_type)))::BIGINT AS distinct_payment_types,
       len(list_distinct(list(VendorID)))::BIGINT AS distinct_vendors,
       len(list_distinct(list(RatecodeID)))::BIGINT AS distinct_ratecodes
FROM raw"""
    q["zone_treated_ref"] = pre + "SELECT zone_key AS location_id, borough, zone, service_zone, is_cbd FROM place"
    q["zone_treated_list"] = pre + "SELECT zone_key AS location_id, zone FROM place WHERE is_cbd = 1 ORDER BY 2, 1"
    q["zone_treated_counts"] = pre + "SELECT is_cbd, count(*) AS zones FROM place GROUP BY ALL"
    q["zone_treated_unmatched"] = pre + f"""
SELECT unnest([{_texts(cfg.treated_zones)}]) AS zone
EXCEPT SELECT zone FROM place WHERE borough IN ({_texts(cfg.treated_boroughs)})"""
    q["dim_zone"] = pre + "SELECT zone_key, zone_key AS location_id, borough, zone, service_zone, is_cbd FROM place"


def _facts(q: dict, pre: str, cfg: PipelineConfig) -> None:
    cols = _doubles("fare_amount", "tip_amount", "tolls_amount", "total_amount")
    q["trips_cleaned"] = pre + f"""
SELECT VendorID, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts, passenger_count,
       {_doubles('trip_distance')}, ratecode_id::DOUBLE AS ratecode_id, PULocationID, DOLocationID, payment_type, {cols}
FROM judged WHERE far AND paid AND forward AND inside"""
    q["trips_deduped"] = pre + f"""
SELECT VendorID, pickup_ts, dropoff_ts, passenger_count, {_doubles('trip_distance')}, ratecode_id::DOUBLE AS ratecode_id,
       PULocationID, DOLocationID, payment_type, {cols}
FROM (SELECT * EXCLUDE (r), unnest(r) FROM kept)"""
    q["trips_keyed"] = pre + f"SELECT {KEYS}, year_month FROM trips"
    q["fact_trips"] = q["fact_incremental"] = q["fact_streamed"] = pre + f"SELECT {KEYS}, pu_is_cbd, year_month FROM fact"
    q["exclusion_counts"] = pre + """
SELECT count(*) AS raw_rows, count_if(good)::BIGINT AS kept_rows, count_if(NOT good)::BIGINT AS excluded_rows,
       count(*) - count(good) AS excluded_null_rows, count_if(NOT far)::BIGINT AS nonpos_distance,
       count_if(NOT paid)::BIGINT AS negative_fare, count_if(NOT forward)::BIGINT AS dropoff_before_pickup,
       count_if(NOT inside)::BIGINT AS outside_window
FROM (SELECT *, far AND paid AND forward AND inside AS good FROM judged)"""
    q["trip_with_zone_roles"] = pre + """
SELECT trip_key, pu_zone_key, names[pu_zone_key].borough AS pu_borough, names[pu_zone_key].zone AS pu_zone,
       do_zone_key, names[do_zone_key].borough AS do_borough, names[do_zone_key].zone AS do_zone
FROM fact, (SELECT map(list(zone_key), list({'borough': borough, 'zone': zone})) AS names FROM place)"""


def _quality(q: dict, pre: str, cfg: PipelineConfig) -> None:
    totals = """
totals AS (
    SELECT *, raw_rows - fact_rows - excluded_rows AS gap
    FROM (SELECT count(*) AS raw_rows, count_if(good)::BIGINT AS kept_rows, count_if(NOT good)::BIGINT AS excluded_rows,
                 count(*) - count(good) AS excluded_null_rows
          FROM (SELECT far AND paid AND forward AND inside AS good FROM judged)) r,
         (SELECT count(*) AS fact_rows FROM fact) f
)"""
    off = f"(abs(gap) > {cfg.reconciliation_tolerance} * raw_rows)::BIGINT"
    q["dq_row_reconciliation"] = pre + "," + totals + f"""
SELECT 'row_reconciliation' AS check_name, raw_rows, fact_rows, excluded_rows, excluded_null_rows,
       kept_rows - fact_rows AS duplicates_removed, gap AS unexplained_gap, {off} AS failures
FROM totals"""

    def outside(col: str, members: str) -> str:
        return f"coalesce({col} NOT IN ({members}), true)"

    def codes(pairs) -> str:
        return ", ".join(str(k) for k, _ in pairs)

    zones = "SELECT zone_key FROM place"
    orphans = [
        ("orphan_pickup_zone", outside("pu_zone_key", zones)), ("orphan_dropoff_zone", outside("do_zone_key", zones)),
        ("orphan_payment", outside("payment_key", codes(cfg.payment_codes))),
        ("orphan_ratecode", outside("ratecode_key", codes(cfg.ratecode_codes))),
        ("orphan_vendor", outside("vendor_key", codes(cfg.vendor_codes))),
        ("orphan_date", f"coalesce(NOT day BETWEEN {_day(cfg.window_start)} AND {_day(cfg.last_window_date)}, true)"),
        ("orphan_time", "coalesce(NOT time_key BETWEEN 0 AND 23, true)")]
    q["dq_referential_integrity"] = pre + "\nUNION ALL\n".join(
        f"SELECT {_text(n)} AS check_name, count_if({c})::BIGINT AS failures FROM fact" for n, c in orphans)
    b = cfg.bounds
    wrong = " + ".join(f"count_if(NOT ({c}))" for c in (
        f"trip_distance > 0 AND trip_distance <= {b.distance_max}", f"fare_amount BETWEEN 0 AND {b.fare_max}",
        f"total_amount BETWEEN 0 AND {b.total_max}", f"trip_duration_min BETWEEN 0 AND {b.minutes_max}",
        f"tip_pct BETWEEN 0 AND {b.tip_pct_max}"))
    ranges = f"SELECT 'range_assertions' AS check_name, ({wrong})::BIGINT AS failures FROM fact"
    q["dq_range_assertions"] = pre + ranges
    repeated = """SELECT 'duplicate_trip_keys' AS check_name, count(*) AS failures
FROM (SELECT row_number() OVER (PARTITION BY trip_key) AS nth FROM fact) WHERE nth = 2"""
    q["dq_duplicate_keys"] = pre + repeated
    drift = f"""SELECT 'schema_drift_missing_cols' AS check_name, count(*) AS failures FROM (
    SELECT unnest([{_texts(EXPECTED_RAW_COLUMNS)}]) AS col
    EXCEPT SELECT DISTINCT lower(unnest(json_keys(to_json(raw)))) FROM raw)"""
    q["dq_schema_drift"] = pre + drift
    missing = f"(count(DISTINCT year_month) <> {cfg.expected_months})::BIGINT"
    q["dq_month_completeness"] = pre + f"""
SELECT 'month_completeness' AS check_name, {missing} AS failures, count(DISTINCT year_month) AS months_present FROM fact"""
    checks = [f"SELECT {_text(n)} AS check_name, count_if({c})::BIGINT AS failures, '' AS detail FROM fact"
              for n, c in orphans]
    checks += [f"SELECT *, '' AS detail FROM ({s})" for s in (ranges, repeated, drift)]
    checks += [
        f"""SELECT 'row_reconciliation' AS check_name, {off} AS failures,
       format('raw_rows={{}}, fact_rows={{}}, excluded_rows={{}}, unexplained_gap={{}}', raw_rows, fact_rows,
              excluded_rows, gap) AS detail FROM totals""",
        f"""SELECT 'month_completeness', {missing},
       format('months_present={{}}, expected_months={cfg.expected_months}', count(DISTINCT year_month)) FROM fact""",
        "SELECT 'null_trip_key', count(*) - count(trip_key), '' FROM fact",
        "SELECT 'fact_not_empty', (count(*) = 0)::BIGINT, '' FROM fact"]
    q["dq_gate_report"] = q["dq_gate_observed"] = pre + "," + totals + "\n" + "\nUNION ALL\n".join(checks)


def _serving(q: dict, pre: str, cfg: PipelineConfig) -> None:
    q["serving_fact"] = pre + "SELECT " + ", ".join(
        f"try_cast({c} AS {t}) AS {c}" for c, t, _ in SERVING_FACT) + " FROM fact"
    q["serving_dim_zone"] = pre + "SELECT " + ", ".join(
        f"{'zone_key' if c == 'location_id' else c}::{t} AS {c}" for c, t, _ in SERVING_DIMS["zone"].columns
    ).replace("::string", "::VARCHAR") + " FROM place"
    q["serving_rounding"] = pre + "\nUNION ALL\n".join(
        f"SELECT 'rounded_{c}' AS check_name, count_if(try_cast({c} AS {t}) <> {c})::BIGINT AS failures FROM fact"
        for c, t, _ in SERVING_FACT if t.startswith("decimal"))
    weekend = ", ".join(map(str, cfg.weekend_iso_days))
    q["trips_by_calendar"] = pre + f"""
SELECT year(day)::INTEGER AS year, month(day)::INTEGER AS month, year_month,
       (isodow(day) IN ({weekend}))::INTEGER AS is_weekend, if(post, 'post', 'pre') AS period, count(*) AS trips,
       count(DISTINCT day) AS days, min(day) AS first_date, max(isodow(day))::INTEGER AS last_dow
FROM fact GROUP BY 1, 2, 3, 4, 5"""
    q["trips_per_period"] = pre + "SELECT if(post, 'post', 'pre') AS period, count(*) AS trips FROM fact GROUP BY 1"
    q["post_period_trips"] = pre + """
SELECT year_month, pu_is_cbd, count(*) AS trips, sum(total_amount)::DOUBLE AS revenue,
       sum(trip_distance)::DOUBLE / count(trip_distance)::DOUBLE AS avg_distance
FROM fact WHERE post GROUP BY 1, 2"""
    q["orphan_zone_recheck"] = pre + """
SELECT count(*) AS orphan_zone_rows FROM fact ANTI JOIN place ON zone_key = pu_zone_key"""


def _marts(q: dict, pre: str, cfg: PipelineConfig) -> None:
    q["mart_kpis"] = pre + f"SELECT trips, revenue, avg_fare FROM (SELECT {MEASURES} FROM fact)"
    q["mart_monthly_trend"] = pre + f"""
SELECT year_month, pu_is_cbd, {MEASURES} FROM fact GROUP BY 1, 2 ORDER BY 1, 2"""
    q["mart_zone_map"] = pre + f"""
SELECT zone_key AS location_id, borough, zone, is_cbd, coalesce(trips, 0) AS trips, revenue, avg_fare, avg_tip_pct,
       revenue_per_min
FROM place LEFT JOIN (SELECT pu_zone_key, {MEASURES} FROM fact GROUP BY 1) ON pu_zone_key = zone_key"""
    q["mart_hour_heatmap"] = pre + f"""
SELECT isodow(day)::INTEGER AS dow, time_key AS hour, daypart, {MEASURES} FROM fact GROUP BY 1, 2, 3"""
    keys = ("pu_zone_key", "daypart", "payment_key")
    slices = []
    for level in range(8):  # bit set: column rolled up
        up = [bool(level >> (2 - i) & 1) for i in range(3)]
        cols = ", ".join(f"{'NULL' if u else k} AS {k}" for k, u in zip(keys, up, strict=True))
        by = ", ".join(k for k, u in zip(keys, up, strict=True) if not u)
        slices.append(f"SELECT {cols}, {MEASURES}, {level} AS slice_level FROM fact" + (f" GROUP BY {by}" if by else ""))
    q["mart_metric_slices"] = pre + "\nUNION ALL\n".join(slices)


def oracle_sql(cfg: PipelineConfig = CFG) -> dict[str, str]:
    pre = base(cfg) + "\n"
    q: dict[str, str] = {}
    for part in (_sources, _facts, _causal, _regressions, _segments, _quality, _serving, _marts):
        part(q, pre, cfg)
    return q
