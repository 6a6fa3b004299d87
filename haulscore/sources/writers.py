"""Sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import move, remove, write_observed


# How text that may hold anything goes through CSV: a mark for missing values that no text is, blanks in quotes, white space and line ends as they are.
WHOLE_TEXT = {"nullValue": "\\N", "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}


def write_csv(frame: DataFrame, path: str, order_by: Sequence[str] = (), mode: str = "errorifexists", whole_text: bool = False) -> None:
    """CSV files with a header. A sort is a range shuffle, so it is asked for here and nowhere earlier.

    Missing values are written as ``NA`` and blanks as nothing. With ``whole_text`` every text comes back as it was from ``read_csv`` with the same
    option, also ``NA``, blanks, quotes, commas and line breaks.
    """
    out = frame.orderBy(*order_by) if order_by else frame
    settings = {"header": "true", "escape": '"', "nullValue": "NA", "emptyValue": ""} | (WHOLE_TEXT if whole_text else {})
    out.write.mode(mode).options(**settings).csv(path)


def write_table(
    frame: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """A stored table. Tasks write their own rows of each partition value: no shuffle, so no hot year."""
    frame.write.mode(mode).format(fmt).partitionBy(*partition_by).save(path)


def write_scores(scores: DataFrame, folder: str, prefix: str = "scores", fmt: str = "csv", mode: str = "errorifexists") -> str:
    """Write scores under a name made from the years they span; gives the path back.

    The span is measured while the rows are written, so they are computed once; the folder gets its name when they are. With ``mode``
    ``overwrite`` an earlier folder of the same years is replaced, else it is an error.
    Parquet output is partitioned by year, so reading one year reads one folder.
    """
    spark, root = scores.sparkSession, folder.rstrip("/")
    written = f"{root}/_{prefix}-{uuid.uuid4().hex}"

    def write(frame: DataFrame) -> None:
        if fmt == "csv":
            write_csv(frame, written)
        else:
            write_table(frame, written, ["Year"], fmt)

    span = write_observed(scores, write, first=F.min("Year"), last=F.max("Year"))
    path = f"{root}/{prefix}_{span['first']}-{span['last']}"
    if mode == "overwrite":
        remove(spark, path)
    move(spark, written, path)
    return path
