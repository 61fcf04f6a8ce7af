"""Periods, and counts per period."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.periods import epoch_to_string, parse_timestamp, period_start
from ...operators.aggregates import label_calendar, label_counts, label_pivot, label_stats
from ...operators.periods import with_period
from .base import COMMENTS_SQL, comments, query, table

_DATED = {
    "d": ("events", "event_id", "ts", "day"),
    "w": ("events", "event_id", "ts", "week"),
    # the events span one month, the orders many
    "m": ("orders", "o_orderkey", "o_orderdate", "month"),
}


def _register(letter: str, source: str, key: str, ts: str, unit: str) -> None:
    start_sql = f"CAST(date_trunc('{unit}', {ts}) AS DATE)"

    @query(f"period_start_{letter}", f"SELECT {key}, {start_sql} AS period_date FROM {source}")
    def start(spark, sf):
        date = period_start(F.col(ts), letter.upper())
        return table(spark, sf, source).select(key, date.alias("period_date"))

    @query(
        f"period_rank_{letter}",
        f"""SELECT {key}, {start_sql} AS period_date,
        CAST(dense_rank() OVER (ORDER BY date_trunc('{unit}', {ts})) AS INTEGER) AS period_int
        FROM {source}""",
    )
    def rank(spark, sf):
        rows = with_period(table(spark, sf, source).select(key, ts), ts, letter.upper())
        return rows.select(key, "period_date", "period_int")


for _letter, _parts in _DATED.items():
    _register(_letter, *_parts)


@query(
    "epoch_format",
    "SELECT event_id, strftime(epoch_ms((1704067200 + event_id * 7919) * 1000), "
    "'%Y-%m-%d %H:%M:%S') AS created FROM events",
)
def epoch_format(spark, sf):
    seconds = F.lit(1704067200) + F.col("event_id") * 7919
    return table(spark, sf, "events").select("event_id", epoch_to_string(seconds).alias("created"))


@query(
    "parse_timestamp",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS created,
        CAST(CASE WHEN event_type <> 'error' THEN date_trunc('week', ts) END AS DATE) AS period_date FROM events""",
)
def parsed(spark, sf):
    # times arrive as text; those of errors do not parse
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), text)).otherwise(text)
    rows = table(spark, sf, "events").select("event_id", parse_timestamp(broken).alias("created"))
    return rows.withColumn("period_date", period_start(F.col("created"), "W"))


_COUNTS_SQL = f"""{COMMENTS_SQL},
    counts AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS period_date, label, count(*) AS n
        FROM comments GROUP BY ALL),
    starts AS (SELECT period_date,
        CAST(row_number() OVER (ORDER BY period_date) AS INTEGER) AS period_int
        FROM (SELECT DISTINCT period_date FROM counts))"""


@query(
    "sentiment_over_time",
    f"WITH {_COUNTS_SQL} SELECT period_int, period_date, label, n FROM counts JOIN starts USING (period_date)",
)
def sentiment_over_time(spark, sf):
    return label_counts(comments(spark, sf), "ts", "label", "W")


@query(
    "sentiment_over_time_filled",
    """WITH c AS (SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS period_date, o_orderpriority AS label FROM orders),
    counts AS (SELECT period_date, label, count(*) AS n FROM c GROUP BY ALL),
    starts AS (SELECT period_date, CAST(row_number() OVER (ORDER BY period_date) AS INTEGER) AS period_int
        FROM (SELECT DISTINCT period_date FROM c))
    SELECT period_int, period_date, l.label, coalesce(n, 0) AS n
    FROM starts CROSS JOIN (SELECT DISTINCT label FROM c) AS l LEFT JOIN counts USING (period_date, label)""",
)
def sentiment_over_time_filled(spark, sf):
    # days on which a priority does not occur
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return label_counts(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", "D", priorities, zero_fill=True)


@query(
    "sentiment_pivot",
    f"""WITH {_COUNTS_SQL}
    SELECT period_int, period_date,
        CAST(coalesce(sum(n) FILTER (label = 'negative'), 0) AS BIGINT) AS negative,
        CAST(coalesce(sum(n) FILTER (label = 'neutral'), 0) AS BIGINT) AS neutral,
        CAST(coalesce(sum(n) FILTER (label = 'positive'), 0) AS BIGINT) AS positive,
        CAST(sum(n) AS BIGINT) AS total
    FROM counts JOIN starts USING (period_date) GROUP BY ALL""",
)
def sentiment_pivot(spark, sf):
    return label_pivot(comments(spark, sf), "ts", "label", "W")


@query(
    "sentiment_pivot_other",
    """WITH c AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS period_date, CASE WHEN event_type <> 'click' THEN event_type END AS label FROM events),
    n AS (SELECT CAST(dense_rank() OVER (ORDER BY period_date) AS INTEGER) AS period_int, period_date,
        count(*) FILTER (label = 'view') AS view, count(*) FILTER (label = 'error') AS error,
        count(*) FILTER (label NOT IN ('view', 'error')) AS other, count(label) AS total FROM c GROUP BY period_date)
    SELECT * FROM n WHERE total > 0""",
)
def sentiment_pivot_other(spark, sf):
    # some event types are not listed, and clicks have no label at all
    rows = table(spark, sf, "events").withColumn("label", F.when(F.col("event_type") != "click", F.col("event_type")))
    return label_pivot(rows, "ts", "label", "W", ["view", "error"], other="other")


@query(
    "sentiment_pivot_month",
    """WITH c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_date, o_orderstatus AS s
        FROM orders)
    SELECT CAST(row_number() OVER (ORDER BY period_date) AS INTEGER) AS period_int, period_date,
        count(*) FILTER (s = 'F') AS "F", count(*) FILTER (s = 'O') AS "O",
        count(*) FILTER (s = 'P') AS "P", count(*) AS total
    FROM c WHERE s IN ('F', 'O', 'P') GROUP BY period_date""",
)
def sentiment_pivot_month(spark, sf):
    return label_pivot(table(spark, sf, "orders"), "o_orderdate", "o_orderstatus", "M", ["F", "O", "P"])


@query(
    "label_stats",
    "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, "
    "count(DISTINCT event_type) AS n_labels FROM events",
)
def stats(spark, sf):
    return label_stats(table(spark, sf, "events"), "event_type")


def _calendar_sql(unit: str) -> str:
    return f"""WITH c AS (SELECT CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS period_date, l_returnflag AS label FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1),
    n AS (SELECT period_date, label, count(*) AS n FROM c GROUP BY ALL),
    days AS (SELECT CAST(unnest(generate_series((SELECT min(period_date) FROM n)::TIMESTAMP, (SELECT max(period_date) FROM n)::TIMESTAMP, INTERVAL 1 {unit})) AS DATE) AS period_date),
    labels AS (SELECT unnest(['A', 'N', 'R']) AS label)
    SELECT CAST(dense_rank() OVER (ORDER BY period_date) AS INTEGER) AS period_int, period_date, label, coalesce(n, 0) AS n
    FROM days CROSS JOIN labels LEFT JOIN n USING (period_date, label)"""


def _register_calendar(name: str, period: str, unit: str) -> None:
    @query(name, _calendar_sql(unit))
    def run(spark, sf):
        # large orders at the highest discount: there are days and weeks without any
        rows = table(spark, sf, "lineitem").where((F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1))
        return label_calendar(rows, "l_shipdate", "l_returnflag", period, ["A", "N", "R"])


_register_calendar("sentiment_calendar", "D", "day")
_register_calendar("sentiment_calendar_week", "W", "week")
