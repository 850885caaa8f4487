"""Carrying a caller's columns along under names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(df: DataFrame, name: str) -> Column:
    return df[quoted(name)]


def packed(df: DataFrame, text_col: str, **named: str) -> DataFrame:
    """Column text, the named columns under given names, and all columns but the text as the struct "rest"."""
    return df.select(
        column(df, text_col).cast("string").alias("text"),
        *[column(df, old).alias(new) for new, old in named.items()],
        F.struct(*[column(df, c) for c in df.columns if c != text_col]).alias("rest"),
    )


def unpacked(df: DataFrame, columns: list[str], text_col: str, **replaced: Column) -> DataFrame:
    """The columns in their order, from "text" and "rest"; some of them replaced."""

    def one(name: str) -> Column:
        if name in replaced:
            return replaced[name]
        return F.col("text") if name == text_col else F.col(f"rest.{quoted(name)}")

    return df.select(*[one(c).alias(c) for c in columns])
