"""Vectors of text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from threadline.functions.text import tokens


def token_buckets(text: Column, dim: int) -> Column:
    """The bucket of every token: the first 32 bits of its MD5 modulo ``dim``."""
    return F.transform(tokens(text), lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % dim).cast("int"))


def hashed_embedding(text: Column, dim: int = 64) -> Column:
    """Token counts by bucket, scaled to length one; NULL without tokens."""

    @F.pandas_udf("array<float>")
    def normalise(buckets: pd.Series) -> pd.Series:
        def one(values):
            if values is None or len(values) == 0:
                return None
            counts = np.bincount(values, minlength=dim).astype(np.float64)
            return (counts / np.sqrt((counts * counts).sum())).astype(np.float32)

        return buckets.map(one)

    return normalise(token_buckets(text, dim))
