"""Word counts, line counts and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import WHITESPACE, joined, row_json, to_text
from tidewell.operators import aggregate, parse
from tidewell.plans import lines
from tidewell.plans.registry import register
from tidewell.scratch import scratch_dir
from tidewell.sinks import output
from tidewell.sources import files


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return lines.document_lines(files.read_table(spark, folder, "documents"))


def _words_sql(text: str, where: str = "") -> str:
    return f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split({text}, ' ')) AS word FROM documents) {where}
GROUP BY word
"""


_STRIP_SET = WHITESPACE.replace("'", "''")


@register(
    "contains_counts",
    """
SELECT count(*) FILTER (WHERE contains(text, 'a')) AS lines_with_a,
       count(*) FILTER (WHERE contains(text, 'b')) AS lines_with_b
FROM documents
""",
)
def contains_counts(spark, folder):
    return aggregate.count_lines_containing(
        _documents(spark, folder), {"lines_with_a": "a", "lines_with_b": "b"}
    )


@register("wordcount_df", _words_sql("text"))
def wordcount_df(spark, folder):
    return aggregate.word_counts(_documents(spark, folder))


@register("wordcount_sql", _words_sql("trim(text)"))
def wordcount_sql(spark, folder):
    padded = _documents(spark, folder).select(F.concat(F.lit("  "), "value", F.lit(" ")).alias("value"))
    return aggregate.word_counts_sql(padded, "document_lines")


@register("wordcount_strip", _words_sql(f"trim(text, '{_STRIP_SET}')"))
def wordcount_strip(spark, folder):
    padded = _documents(spark, folder).select(
        F.concat(F.lit("\t 　"), "value", F.lit("\r\n ")).alias("value")
    )
    return aggregate.word_counts(padded, strip="all")


def _gappy(spark, folder) -> DataFrame:
    """Documents with every space doubled, so that empty words appear."""
    return _documents(spark, folder).select(
        F.replace("value", F.lit(" "), F.lit("  ")).alias("value")
    )


@register("wordcount_nonempty", _words_sql("text", "WHERE word <> ''"))
def wordcount_nonempty(spark, folder):
    return aggregate.word_counts(_gappy(spark, folder), keep_empty=False)


@register("wordcount_nonempty_udf", _words_sql("text", "WHERE word <> ''"))
def wordcount_nonempty_udf(spark, folder):
    return aggregate.word_counts_where(_gappy(spark, folder), lambda word: len(word) > 0)


@register(
    "text_sink_counts",
    f"""
SELECT {lines.ACCESS_PATH} AS key, count(*) AS count
FROM events WHERE {lines.GOOD_EVENT} GROUP BY 1
""",
)
def text_sink_counts(spark, folder):
    """Counts saved as ``key: count`` text files and read back."""
    log = lines.access_lines(files.read_table(spark, folder, "events"))
    counts = aggregate.count_by(parse.parse_access_log(log), "path")
    path = scratch_dir(spark, "counts-text")
    output.save_text(counts, path, joined(": ", "path", to_text("count")))
    saved = files.read_lines(spark, path).select(F.split("value", ": ").alias("parts"))
    return saved.select(
        F.get("parts", F.lit(0)).alias("key"),
        F.get("parts", F.lit(1)).try_cast("bigint").alias("count"),
    )


# -- people and delimited files ------------------------------------------------------


@register(
    "score_board",
    f"""
SELECT {lines.SCORE} AS score, count(*) AS count
FROM customer WHERE c_nationkey * 2 < 30 AND c_mktsegment <> 'MACHINERY'
GROUP BY 1 ORDER BY 1
""",
)
def score_board(spark, folder):
    people = parse.parse_word_score(lines.score_lines(files.read_table(spark, folder, "customer")))
    return aggregate.score_board(people)


def _people_csv(spark: SparkSession, folder: str, header: bool) -> str:
    path = scratch_dir(spark, "people-csv")
    customer = files.read_table(spark, folder, "customer")
    people = customer.select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("job"),
    )
    people.write.csv(path, sep=";", header=header)
    return path


_PEOPLE_SQL = "SELECT c_name AS name, c_nationkey AS age, c_mktsegment AS job FROM customer"


@register("csv_infer", _PEOPLE_SQL)
def csv_infer(spark, folder):
    return files.read_csv_inferred(spark, _people_csv(spark, folder, True))


@register("csv_schema", _PEOPLE_SQL)
def csv_schema(spark, folder):
    return files.read_csv_typed(spark, _people_csv(spark, folder, False))


@register("delim_positional", "SELECT CAST(o_orderkey AS VARCHAR) AS a FROM orders")
def delim_positional(spark, folder):
    """Text file of thirteen fields, one of which is selected by SQL."""
    path = scratch_dir(spark, "positional-text")
    output.save_text(
        lines.positional_lines(files.read_table(spark, folder, "orders")), path, F.col("value")
    )
    people = files.read_positional(spark, path, "a b c d e f g h i j k l m")
    return aggregate.query_view(people, "people", "SELECT a FROM people")


# -- events --------------------------------------------------------------------------


@register(
    "call_etl",
    f"""
SELECT concat('{{"stationId":"station_', user_id, '","callOut":"186', event_id,
  '","callIn":"189', user_id, '","callStatus":"success","callTime":"',
  strftime(ts, '%Y%m%d%H%M%S'), '","duration":"',
  CAST(floor(value) AS BIGINT) * 1000, '"}}') AS value
FROM events WHERE {lines.GOOD_EVENT} AND {lines.CALL_STATUS} = 'success'
""",
)
def call_etl(spark, folder):
    calls = parse.successful_calls(lines.call_lines(files.read_table(spark, folder, "events")))
    return parse.parse_call_record(calls).select(row_json().alias("value"))


@register(
    "group_mean_pandas",
    "SELECT user_id, round(avg(value), 6) AS v FROM events GROUP BY user_id",
)
def group_mean_pandas(spark, folder):
    means = aggregate.mean_by_pandas(files.read_table(spark, folder, "events"), "user_id", "value")
    return means.withColumn("v", F.round("v", 6))


@register(
    "group_median_pandas",
    """
SELECT event_type, round(median(value), 6) AS v, count(value) AS n FROM events GROUP BY event_type
""",
)
def group_median_pandas(spark, folder):
    """A caller's function sees whole groups, batch by batch."""
    events = files.read_table(spark, folder, "events").select("event_type", "value")
    found = aggregate.apply_groups(events, "event_type", aggregate.medians("value"), "v double, n long")
    return found.withColumn("v", F.round("v", 6))


@register(
    "group_pause_pandas",
    """
SELECT user_id, max(pause) AS pause_us
FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS pause FROM events)
GROUP BY user_id
""",
)
def group_pause_pandas(spark, folder):
    """The longest pause of every user: rows in order of time, over all batches of a group."""
    events = files.read_table(spark, folder, "events").select("user_id", "ts")
    return aggregate.apply_groups(
        events, "user_id", aggregate.longest_pause("ts"), "pause_us long", order_by="ts"
    )
