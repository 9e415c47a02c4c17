"""Raw lines as columns: tokens, numbers, titles, and the reason why a line is not valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.sources.names import dump_date, dump_hour, dump_stamp

#: Reasons, in the order in which they are tried.
REASONS = ("invalid_filename", "malformed_line", "missing_required_value", "non_numeric_metric", "negative_metric", "unsupported_source_project")


def tokens(line: Column) -> Column:
    """All tokens between single spaces; empty ones count."""
    return F.split(line, " ", -1)


def token(parts: Column, k: int) -> Column:
    """The k-th token from 0, null beyond the end, in any SQL mode."""
    return F.get(parts, F.lit(k))


def metric(text: Column) -> Column:
    """A whole number of 64 bits, or null."""
    return text.try_cast("bigint")


def normalized_title(title: Column) -> Column:
    """Percent escapes decoded, broken ones and plus signs kept, underscores as spaces."""
    whole = F.regexp_replace(title, "%(?![0-9A-Fa-f]{2})", "%25")
    plus = F.replace(whole, F.lit("+"), F.lit("%2B"))
    return F.replace(F.coalesce(F.try_url_decode(plus), title), F.lit("_"), F.lit(" "))


def invalid_reason(n_tokens: Column, date: Column, hour: Column, code: Column, title: Column, views: Column, size: Column, project: Column) -> Column:
    """The first of REASONS that holds, or null for a valid line."""
    empty = lambda c: c.isNull() | (c == "")
    holds = (
        date.isNull() | hour.isNull(),
        n_tokens != 4,
        empty(code) | empty(title),
        views.isNull() | size.isNull(),
        (views < 0) | (size < 0),
        project.isNull(),
    )
    out = None
    for reason, held in zip(REASONS, holds, strict=True):
        out = F.when(held, reason) if out is None else out.when(held, reason)
    return out


def parsed(raw: DataFrame) -> DataFrame:
    """raw (value, source_file, source_filename) with tokens, numbers, date and hour."""
    out = raw.withColumns({"parts": tokens(F.col("value")), "stamp": dump_stamp(F.col("source_filename"))})
    out = out.withColumns({name: token(F.col("parts"), k) for k, name in enumerate(("source_project", "page_title", "view_count_raw", "response_size_raw"))})
    out = out.withColumns({"n_tokens": F.size("parts"), "date": dump_date(F.col("stamp")), "hour": dump_hour(F.col("stamp"))}).drop("parts", "stamp")
    return out.withColumns({"view_count": metric(F.col("view_count_raw")), "response_size": metric(F.col("response_size_raw"))})


def classified(raw: DataFrame, dim: DataFrame) -> DataFrame:
    """parsed rows joined to the dimension, with invalid_reason. The dimension has a fixed, tiny number of rows: it is broadcast."""
    out = parsed(raw).join(F.broadcast(dim), "source_project", "left")
    columns = ("n_tokens", "date", "hour", "source_project", "page_title", "view_count", "response_size", "project")
    return out.withColumn("invalid_reason", invalid_reason(*map(F.col, columns)))
