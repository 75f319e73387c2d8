"""Edit distances by bit vectors: a row of the table of distances is two integers of as many bits as one text
has symbols, and a symbol of the other text moves on to the next row in a handful of operations on them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Least number of symbols put in, left out or replaced that make a of b; symbols are characters or words."""
    if a == b:
        return 0
    low, n = 0, min(len(a), len(b))
    while low < n and a[low] == b[low]:
        low += 1
    high = 0
    while high < n - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict = {}
    for i, symbol in enumerate(a):
        where[symbol] = where.get(symbol, 0) | 1 << i
    every, last, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    # up and down: the places at which a row's distance is one more or one less than at the place before
    up, down = every, 0
    for symbol in b:
        same = where.get(symbol, 0)
        diagonal = (((same & up) + up) ^ up) | same
        more, less = down | (every & ~(diagonal | up)), up & diagonal
        score += bool(more & last) - bool(less & last)
        more, less = (more << 1 | 1) & every, less << 1 & every
        straight = same | down
        up, down = less | (every & ~(straight | more)), more & straight
    return score


@pandas_udf(StructType([StructField("chars", IntegerType()), StructField("words", IntegerType())]))
def _distances(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if a is None or b is None else (edit_distance(a, b), edit_distance(a.split(), b.split())) for a, b in zip(x, y, strict=True)]
    return pd.DataFrame(rows, columns=["chars", "words"]).astype("Int32")


def distances(x: Column, y: Column) -> Column:
    """struct(chars, words): the edit distances of two normalised texts over their characters and over their
    words; null where a text is.  The same both ways round."""
    return _distances(x, y)


@pandas_udf(ArrayType(StructType([StructField("chars", IntegerType()), StructField("words", IntegerType())])))
def _pair_distances(texts: pd.Series) -> pd.Series:
    def told(own: Sequence[str]) -> list[dict]:
        return [{"chars": edit_distance(a, b), "words": edit_distance(a.split(), b.split())} for i, a in enumerate(own) for b in own[i + 1 :]]

    return pd.Series([None if t is None else told(list(t)) for t in texts])


def pair_distances(texts: Column) -> Column:
    """distances() of every two of a short array of normalised texts: (0, 1), (0, 2), ..., (1, 2), ...  Marked as
    not deterministic, so that it is made once and no filter on what follows from it is moved below it."""
    return _pair_distances.asNondeterministic()(texts)


def rate(edits: Column, symbols: Column) -> Column:
    """Edits by the reference's symbols, of which an empty one has 1."""
    return edits / F.greatest(F.lit(1), symbols)
