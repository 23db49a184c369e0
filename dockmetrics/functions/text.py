"""Presentation of served tables: rounded fractions and headings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def display_round(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round float columns, halves to the even digit; leave others alone.

    A float is widened first, so that its exact binary value is rounded and not its
    shorter decimal spelling. A double has no wider type to be shown in; no result
    table has one, and doubles stay as they are.
    """

    def shown(field: T.StructField):
        if isinstance(field.dataType, T.FloatType):
            return F.bround(F.col(field.name).cast("double"), digits).alias(field.name)
        return F.col(field.name)

    return df.select(*(shown(field) for field in df.schema.fields))


def column_label(name: str) -> str:
    """Title case; underscores stay and a letter after a digit stays small."""
    return re.sub(r"(?<![a-z0-9])[a-z]", lambda first: first.group().upper(), name.lower())


def table_label(name: str) -> str:
    """Title case with underscores shown as spaces."""
    return column_label(name.replace("_", " "))
