"""Files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...session import shared_dir
from ...sources.files import parse_lines, read_jsonl, read_labelled_csv, write_csv
from ...sources.splitcsv import read_split_csv
from .base import query, table

_DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
])


@query("csv_round_trip", "SELECT doc_id, text, lang FROM documents")
def csv_round_trip(spark, sf):
    path = shared_dir(spark, "csv")
    write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return read_labelled_csv(spark, path, _DOC)


@query("csv_split_read", "SELECT doc_id, replace(text, ' the ', ' \"the\"' || chr(10)) AS text, lang FROM documents")
def csv_split_read(spark, sf):
    # texts are full of quotes and line breaks; every task of the scan writes one file, whose ranges are read by themselves
    path = shared_dir(spark, "csv")
    text = F.replace("text", F.lit(" the "), F.lit(' "the"\n'))
    write_csv(table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang"), path)
    return read_split_csv(spark, path, _DOC)


# Event properties are JSON; those of errors are cut short, those of views lack the field.
_LINE_SQL = """CASE event_type WHEN 'error' THEN left(props, length(props) - 1)
    WHEN 'view' THEN replace(props, '"k"', '"other"') ELSE props END"""
_K = T.StructType([T.StructField("k", T.IntegerType())])


def _lines(spark, sf):
    props, kind = F.col("props"), F.col("event_type")
    line = (
        F.when(kind == "error", F.substring(props, F.lit(1), F.length(props) - 1))
        .when(kind == "view", F.replace(props, F.lit('"k"'), F.lit('"other"')))
        .otherwise(props)
    )
    return table(spark, sf, "events").select("event_id", line.alias("line"))


@query(
    "jsonl_quarantine",
    f"""WITH l AS (SELECT event_id, {_LINE_SQL} AS line FROM events)
    SELECT event_id, CAST(regexp_extract(line, '^\\{{"k": ([0-9]+)\\}}$', 1) AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS reason
    FROM l WHERE regexp_matches(line, '^\\{{"k": [0-9]+\\}}$')
    UNION ALL SELECT event_id, NULL, CASE WHEN line LIKE '%}}' THEN 'missing k' ELSE 'malformed' END
    FROM l WHERE NOT regexp_matches(line, '^\\{{"k": [0-9]+\\}}$')""",
)
def jsonl_quarantine(spark, sf):
    good, bad = parse_lines(_lines(spark, sf), "line", _K)
    good = good.withColumn("reason", F.lit(None).cast("string"))
    return good.unionByName(bad.drop("line"), allowMissingColumns=True).select("event_id", "k", "reason")


@query(
    "jsonl_stop",
    """SELECT event_id, value FROM events WHERE event_id <
    (SELECT min(event_id) FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-20')""",
)
def jsonl_stop(spark, sf):
    # in event order, lines of late errors are broken: the read keeps what comes before the first
    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    broken = (F.col("event_type") == "error") & late
    whole = F.to_json(F.struct("event_id", "value"))
    line = F.when(broken, F.concat(F.lit("{broken "), whole)).otherwise(whole)
    path = shared_dir(spark, "jsonl")
    table(spark, sf, "events").orderBy("event_id").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return read_jsonl(spark, path, schema, on_bad="stop")[0]
