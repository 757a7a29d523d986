"""Small helpers shared by the operators of this subpackage."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SPACE = "\\x20\\x09-\\x0D"  # the white space of the word rule [^\x20\x09-\x0D]+
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: positions and ids made from the
    result stay the same when an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def replacing(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add (whatever
    their letter case): an input column of an output's name is replaced."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in low])


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns of these names (whatever their letter case) under
    other names, and the function that gives a result its own columns back."""
    low = {n.lower() for n in names}
    away = {c: f"_aside_{i}" if c.lower() in low else c for i, c in enumerate(df.columns)}

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(quoted(v)).alias(c) for c, v in away.items()])

    return df.select(*[F.col(quoted(c)).alias(v) for c, v in away.items()]), back


def by_place(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called c0, c1, ..., and where each went: whatever they
    were called, they clash neither with helpers nor with outputs."""
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), at


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each computed once: a generator of one row,
    unlike a projection, is never merged into what uses the columns (where a
    lambda would work them out again for every element), nor is a filter on them
    moved below it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def crc_text(col: str) -> Column:
    """crc32 of a column written as text (a null counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def byte_lists(array) -> list:
    """Python bytes (or None) of a string or binary Arrow column."""
    import pyarrow as pa
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        array = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    return array.to_pylist()


def text_slices(batches, column: int = 0, limit: int = 4 << 20):
    """Each batch in slices of about ``limit`` bytes of text (a longer text is one of
    its own), so that Python copies of few texts exist at a time: (slice, texts)."""
    import numpy as np
    import pyarrow.compute as pc
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            yield part, byte_lists(part.column(column))


class Remembered(dict):
    """key -> ``work(key)``, remembered within about ``budget`` bytes: two generations,
    of which the older goes when the younger holds half of it.  An entry takes about
    ``entry`` bytes; long keys are not kept.  Subclasses say what ``work`` is."""

    def __init__(self, budget: int, entry: int, longest: int = 64):
        self.most, self.longest = max(1, budget // entry // 2), longest
        self.older: dict = {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found
