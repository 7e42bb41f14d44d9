"""Text columns: id lists, percent texts, days, JSON of counts."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clicklens.functions.fixed import OTHER_LABEL, SHARE_PATTERN


def split_list(text: Column) -> Column:
    """Pieces of a comma-joined text.

    Trailing empty pieces are dropped ("7,8,," has two pieces, "," has none),
    but an empty text is one empty piece.
    """
    body = F.rtrim(text, F.lit(","))
    none = F.array().cast("array<string>")
    # Most lists have no trailing comma and need no trimming.
    trimmed = F.when(body == "", none).otherwise(F.split(body, ","))
    return F.when(text.endswith(","), trimmed).otherwise(F.split(text, ","))


def percent(part: Column, whole: Column, pattern: str) -> Column:
    """``part / whole`` as percent text, rounded half-even as the pattern says."""
    ratio = part.cast("double") / whole.cast("double")
    return F.call_function("format_number", ratio, F.lit(pattern))


def day_of_millis(millis: Column) -> Column:
    """Day text of an epoch-millisecond column, in the session's time zone."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def pairs_json(pairs: Column, name: str, count: str) -> Column:
    """JSON of an array of structs, one small object each: ``[{"1":200},{"2":100}]``."""
    return F.to_json(F.transform(pairs, lambda pair: F.create_map(pair[name], pair[count])))


def remark_text(name: Column, part: Column, whole: Column) -> Column:
    """``name:12.34%``; a missing name prints as ``null``."""
    return F.concat(
        F.coalesce(name, F.lit("null")), F.lit(":"), percent(part, whole, SHARE_PATTERN)
    )


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``city_remark`` callable from SQL.

    It takes the clicks of a group's cities, of which it names the first two, and the
    group's total. Counting and choosing these cities stay ordinary aggregates and ranks,
    so no more than two rows of a group are ever collected:

        SELECT area, product, city_remark(collect_list(struct(city_name, n)), total)
        FROM (SELECT *, row_number() OVER (
                PARTITION BY area, product ORDER BY n DESC, city_name) AS place ...)
        WHERE place <= 2 GROUP BY area, product, total

    A null city counts as one more city and prints as ``null``.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION city_remark(
          clicks ARRAY<STRUCT<city: STRING, n: BIGINT>>, total BIGINT)
        RETURNS STRING
        RETURN (
          WITH counted AS (
            SELECT slice(array_sort(clicks, (a, b) -> CASE
                     WHEN a.n > b.n THEN -1 WHEN a.n < b.n THEN 1
                     WHEN a.city IS NULL AND b.city IS NULL THEN 0
                     WHEN a.city IS NULL OR a.city < b.city THEN -1
                     WHEN b.city IS NULL OR a.city > b.city THEN 1 ELSE 0 END), 1, 2) AS leading)
          SELECT concat_ws(', ',
                   transform(leading, c -> concat(
                     coalesce(c.city, 'null'), ':', format_number(c.n / total, '{SHARE_PATTERN}'))),
                   concat('{OTHER_LABEL}:', format_number(
                     aggregate(leading, total, (rest, c) -> rest - c.n) / total,
                     '{SHARE_PATTERN}')))
          FROM counted)
    """)
