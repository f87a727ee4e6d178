"""Functions that need Python, in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaves(value: object) -> Iterator[str]:
    """Scalars of nested lists and objects in their order; nothing for null."""
    if isinstance(value, dict):
        value = list(value.values())
    if isinstance(value, list):
        for v in value:
            yield from leaves(v)
    elif isinstance(value, bool):
        yield str(value).lower()
    elif value is not None:
        yield str(value)


@F.pandas_udf(T.ArrayType(T.StringType()))
def scalar_leaves(objects: pd.Series) -> pd.Series:
    """The leaves of JSON texts; none for text that is no JSON."""

    def read(x: str | None) -> list[str]:
        try:
            return list(leaves(json.loads(x))) if x else []
        except ValueError:
            return []

    return objects.map(read)


@F.pandas_udf(T.DoubleType())
def character_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts, with difflib's rule for frequent characters."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])
