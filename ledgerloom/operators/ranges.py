"""Date ranges: spans, fixed windows, and halving until windows are small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days(start: Column, end: Column) -> Column:
    """Days of a range, both ends included."""
    return F.date_diff(end, start) + 1


def middle(start: Column, end: Column) -> Column:
    """The last day of a range's first half."""
    return F.date_add(start, F.floor(F.date_diff(end, start) / 2).cast("int"))


def windows(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """df with a row for each window of `width` days that covers start to end; the last one is cut."""
    first = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"interval {int(width)} days")))
    return df.withColumn("window_start", first).withColumn("window_end", F.least(F.date_add("window_start", width - 1), F.col(end)))


def split_until(rows: DataFrame, day: str, most: int) -> DataFrame:
    """(window_start, window_end, n): the rows' whole range, halved until a window has under `most` rows or one day.

    One pass counts rows by day; the halving works on running counts by day, a table that grows with the calendar only.
    """
    from pyspark.sql import Window

    spark = rows.sparkSession
    by_day = rows.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).count()
    upto = by_day.select("day", F.sum("count").over(Window.orderBy("day")).alias("upto")).orderBy("day").collect()  # one row for each day
    names, total = [r[0] for r in upto], [0, *(r[1] for r in upto)]
    if not names:
        return spark.createDataFrame([], "window_start date, window_end date, n long")
    from bisect import bisect_left, bisect_right
    from datetime import timedelta

    out, todo = [], [(names[0], names[-1])]
    while todo:
        a, b = todo.pop()
        n = total[bisect_right(names, b)] - total[bisect_left(names, a)]
        if n < most or a == b:
            out.append((a, b, n))
        else:
            mid = a + timedelta(days=(b - a).days // 2)
            todo += [(a, mid), (mid + timedelta(days=1), b)]
    return spark.createDataFrame(out, "window_start date, window_end date, n long")
