"""Reports and their chart layouts."""

from __future__ import annotations

from tapmart.operators import olap, shaping
from tapmart.queries.facts import star
from tapmart.queries.registry import part, query

_MEASURES = """count(*) AS trips, CAST(sum(paid) AS DECIMAL(20,2)) AS revenue,
    round(avg(duration_min), 1) AS avg_minutes"""
_AVG_PAID = "round(avg(paid), 0) AS avg_paid"

part(
    "p_q1",
    f"""SELECT date, day_name, is_weekend, {_MEASURES} FROM p_fact JOIN p_dim_date USING (date_key)
    WHERE is_success = 1 GROUP BY date, day_name, is_weekend""",
)
part(
    "p_q2",
    f"""SELECT corridor_type, card_bank, {_MEASURES} FROM p_fact JOIN p_unknown_route USING (route_key)
    WHERE is_success = 1 GROUP BY corridor_type, card_bank""",
)
part(
    "p_q3",
    f"""SELECT tap_in_hour, day_part, direction, count(*) AS trips, {_AVG_PAID}
    FROM p_fact JOIN p_dim_date USING (date_key)
    WHERE (is_success = 1 OR is_free = 1) AND is_weekend = 0
    GROUP BY tap_in_hour, day_part, direction""",
)
part(
    "p_q4",
    f"""SELECT age_band, rider_segment, d.card_bank, gender, count(*) AS trips,
    count(DISTINCT rider_id) AS riders, {_AVG_PAID} FROM p_fact JOIN p_dim_rider d
    USING (rider_key) WHERE is_success = 1 GROUP BY age_band, rider_segment, d.card_bank, gender""",
)


@query("q1_daily_trend", "SELECT * FROM p_q1")
def q1_daily_trend(spark, sf_dir):
    s = star(spark, sf_dir, "date")
    return olap.daily_trend(s["fact"], s["date"])


@query(
    "q1_rollup",
    f"""SELECT year, month, date, CAST(grouping_id(year, month, date) AS INTEGER) AS level,
    {_MEASURES} FROM p_fact JOIN p_dim_date USING (date_key) WHERE is_success = 1
    GROUP BY ROLLUP (year, month, date)""",
)
def q1_rollup(spark, sf_dir):
    s = star(spark, sf_dir, "date")
    return olap.daily_rollup(s["fact"], s["date"])


@query("q2_corridor_bank", "SELECT * FROM p_q2")
def q2_corridor_bank(spark, sf_dir):
    s = star(spark, sf_dir, "route", "rider")
    return olap.corridor_bank(s["fact"], s["route"])


@query("q3_hour_direction", "SELECT * FROM p_q3")
def q3_hour_direction(spark, sf_dir):
    s = star(spark, sf_dir, "date")
    return olap.hour_direction(s["fact"], s["date"])


@query("q4_rider_profile", "SELECT * FROM p_q4")
def q4_rider_profile(spark, sf_dir):
    s = star(spark, sf_dir, "rider")
    return olap.rider_profile(s["fact"], s["rider"])


@query(
    "q5_top_stops",
    f"""SELECT *, CAST(rank() OVER (ORDER BY trips DESC) AS INTEGER) AS ranking FROM
    (SELECT stop_id, stop_name, count(*) AS trips,
      CAST(count(*) FILTER (status = 'Incomplete') AS BIGINT) AS incomplete,
      CAST(count(*) FILTER (is_free = 1) AS BIGINT) AS free, {_AVG_PAID},
      round(count(*) FILTER (status = 'Incomplete') / count(*) * 100, 1) AS pct_incomplete
      FROM p_fact JOIN p_dim_stop ON board_stop_key = stop_key GROUP BY stop_id, stop_name)
    QUALIFY ranking <= 10""",
)
def q5_top_stops(spark, sf_dir):
    s = star(spark, sf_dir, "stop")
    return olap.top_stops(s["fact"], s["stop"])


_BANKS = "bni brizzi dki emoney flazz lainnya online Unknown".split()
_GENDERS = ["M", "F", "Tidak Disebutkan", "U"]


def _pivot_sql(source: str, rows: str, columns: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    sums = ", ".join(
        f"""CAST(coalesce(sum(trips) FILTER ({columns} = '{v}'), 0) AS BIGINT) AS "{v}\""""
        for v in values
    )
    other = f"{columns} IS NULL OR {columns} NOT IN ({listed})"
    sums += f", CAST(coalesce(sum(trips) FILTER ({other}), 0) AS BIGINT) AS other_labels"
    return f"SELECT {rows}, {sums} FROM {source} GROUP BY {rows}"


@query("pivot_corridor_bank", _pivot_sql("p_q2", "corridor_type", "card_bank", _BANKS))
def pivot_corridor_bank(spark, sf_dir):
    return shaping.pivot_corridor_bank(q2_corridor_bank(spark, sf_dir))


@query("pivot_age_gender", _pivot_sql("p_q4", "age_band", "gender", _GENDERS))
def pivot_age_gender(spark, sf_dir):
    return shaping.pivot_age_gender(q4_rider_profile(spark, sf_dir))


@query(
    "share_by_bank",
    """SELECT card_bank, CAST(sum(trips) AS BIGINT) AS trips,
    round(CAST(sum(trips) AS DOUBLE) * 100 / (SELECT sum(trips) FROM p_q4), 1) AS pct
    FROM p_q4 GROUP BY card_bank""",
)
def share_by_bank(spark, sf_dir):
    return shaping.share_by_bank(q4_rider_profile(spark, sf_dir))


@query(
    "hourly_grid",
    """SELECT CAST(g.direction AS INTEGER) AS direction, CAST(g.hour AS INTEGER) AS tap_in_hour,
    CAST(coalesce(sum(trips), 0) AS BIGINT) AS trips
    FROM (SELECT * FROM (VALUES (0), (1)) d(direction), range(24) h(hour)) g
    LEFT JOIN p_q3 q ON q.direction = g.direction AND q.tap_in_hour = g.hour
    GROUP BY g.direction, g.hour""",
)
def hourly_grid(spark, sf_dir):
    return shaping.hourly_grid(q3_hour_direction(spark, sf_dir))


@query(
    "daily_trend_series",
    """SELECT date, is_weekend, trips, CAST(revenue AS DOUBLE) / 1e6 AS revenue_millions
    FROM p_q1""",
)
def daily_trend_series(spark, sf_dir):
    return shaping.daily_series(q1_daily_trend(spark, sf_dir))
