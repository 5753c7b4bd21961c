"""Writing corpora. Every sink writes one file per task into a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gristmill.sources.readers import _NULL


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header, every field quoted, quotes doubled, missing text kept apart from empty text.

    Missing text is written as backslash and capital N; a text that consists of these
    two characters alone is read back as missing.
    """
    (
        df.write.mode(mode)
        .option("header", True).option("quoteAll", True)
        .option("quote", '"').option("escape", '"')
        .option("emptyValue", "").option("nullValue", _NULL)
        # keep leading and trailing blanks: they are text
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line in UTF-8; missing fields are written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "errorifexists") -> None:
    """All splits in one pass: one JSON Lines folder per split below ``path``."""
    df.write.mode(mode).partitionBy(split_col).option("ignoreNullFields", False).json(path)


def write_formats(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The same table as Parquet, CSV and JSON Lines below ``path``.

    The computed table is written once as Parquet; the text formats are copies
    of that, so the flow behind ``df`` runs once and nothing is held in memory.
    """
    write_parquet(df, f"{path}/parquet", mode)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet")
    write_csv(stored, f"{path}/csv", mode)
    write_json_lines(stored, f"{path}/json", mode)
