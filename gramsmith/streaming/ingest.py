"""Measure lines that arrive as a stream.

Separating bad lines needs no state: headers are a static table, and each line is
judged by itself. The same grammar serves batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramsmith.operators import badrows


def bad_lines(lines: DataFrame, headers: DataFrame, units: tuple) -> DataFrame:
    """Lines of a stream that don't load, with the reason.

    lines: a streaming frame line_id, file_name, line_nr, raw_line. headers: a
    static frame file_name, raw_line; a stream-static left join, so that a line of
    an unknown file comes out as column_count.
    """
    heads = headers.select(F.col("file_name").alias("head_file"), F.col("raw_line").alias("head_line"))
    body = lines.filter("line_nr IS NULL OR line_nr <> 1").select("line_id", "raw_line", "file_name", "line_nr")
    joined = body.join(heads, F.col("file_name") == F.col("head_file"), "left").select("line_id", "raw_line", "head_line", "line_nr")
    return badrows.judge_lines(joined, units, "measure_lines")
