"""Line scorers: functions from a text column to a score column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[list[str]], list[float]]


def batch_scorer(load: Callable[[], Model], batch_size: int = 32) -> Callable[[Column], Column]:
    """A scorer for a model that scores lists of texts.

    load makes the model; it is called once a task, in the worker, so that the model itself is never shipped. Texts go
    to the model in batches of batch_size. Null texts score null."""

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for texts in parts:
            model = model or load()
            known = texts.dropna()
            out: list[float] = []
            for i in range(0, len(known), batch_size):
                out += model(known.iloc[i : i + batch_size].tolist())
            yield pd.Series(out, index=known.index, dtype="float64").reindex(texts.index)

    score.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, T.DoubleType())
