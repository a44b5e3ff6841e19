"""Pages of a table in any order, found by selection: the table is neither sorted nor written.

Sort keys become numbers that keep their order. A sketch of quantiles proposes cuts of the
first key, the exact number of rows at each cut tells between which cuts the page lies, and the search goes on
there, or with the next key where rows are equal. Once the page ends within the first few thousand rows
of what is left, those are taken by a top-k.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a top-k may pass over, and cuts that one search step proposes.
NEAR, CUTS = 10_000, 64
#: Quantiles are doubles, so every number stays below 2**53; this one is above all others.
_LAST = 1 << 52
#: Bytes of a text that one number holds, and numbers of a text; what follows only a last sort puts in order.
_CHUNK, _CHUNKS = 6, 6


def micros(time: Column) -> Column:
    """Microseconds of a time without zone, which no session zone shifts."""
    days = F.unix_date(time.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(time)) * 60 + F.minute(time)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")


def _numbers(column: Column, kind: T.DataType) -> list[Column]:
    """Longs whose order, one after the other, is that of the column."""
    if isinstance(kind, T.StringType):
        code = F.hex(column.cast("binary"))
        width = 2 * _CHUNK
        return [
            F.conv(F.rpad(F.substring(code, i * width + 1, width), width, "0"), 16, 10).cast("bigint") for i in range(_CHUNKS)
        ]
    if isinstance(kind, (T.TimestampNTZType, T.IntegralType)):
        value = micros(column) if isinstance(kind, T.TimestampNTZType) else column.cast("bigint")
        return [F.shiftright(value, 32), value.bitwiseAND(0xFFFFFFFF)]
    raise TypeError(f"cannot page by {kind.simpleString()}")


def sort_numbers(rows: DataFrame, keys: list[tuple[str, bool]]) -> list[Column]:
    """Ascending longs for keys with whether each is descending; nulls are the largest values."""
    found = []
    for name, down in keys:
        for number in _numbers(F.col(name), rows.schema[name].dataType):
            value = F.coalesce(number, F.lit(_LAST))
            found.append(-value if down else value)
    return found


def page_of(rows: DataFrame, keys: list[tuple[str, bool]], first: int, size: int) -> DataFrame:
    """Rows ``first`` to ``first + size - 1`` in the order of ``keys``, nulls as the largest values."""
    order = [F.col(name).desc_nulls_first() if down else F.col(name).asc_nulls_last() for name, down in keys]
    if first + size <= _near(size):
        return rows.orderBy(*order).offset(first).limit(size)
    # The numbers are columns, so that no condition repeats how they are made.
    numbers = {f"_page_key_{i}": number for i, number in enumerate(sort_numbers(rows, keys))}
    parts = _selected(rows.withColumns(numbers), [F.col(name) for name in numbers], order, first, size)
    found = [part.drop(*numbers) for part in parts]
    return reduce(DataFrame.unionAll, found, rows.limit(0)).orderBy(*order)


def _near(size: int) -> int:
    """Rows up to the end of a page that a top-k takes: more for long pages, which would fall into many slices."""
    return max(NEAR, 4 * size)


def _selected(rows: DataFrame, numbers: list[Column], order: list[Column], first: int, size: int) -> list[DataFrame]:
    """The page, in pieces of slices of ``rows``."""
    if first + size <= _near(size) or not numbers:
        return [rows.orderBy(*order).offset(first).limit(size)]
    key = numbers[0]
    shares = [i / CUTS for i in range(CUTS + 1)]
    proposed = rows.agg(F.percentile_approx(key, shares, 10_000)).first()[0]
    cuts = sorted(set(proposed or []))
    if not cuts:
        return []
    # Of each cut the rows before it and up to it, so that its own rows are a slice too.
    counts = rows.agg(*(F.count_if(key < c) for c in cuts), *(F.count_if(key <= c) for c in cuts), F.count("*")).first()
    edges = [0]
    slices = []
    for i, c in enumerate(cuts):
        slices += [key < c if not i else (key > cuts[i - 1]) & (key < c), key == c]
        edges += [counts[i], counts[len(cuts) + i]]
    slices.append(key > cuts[-1])
    edges.append(counts[2 * len(cuts)])
    end = first + size
    hit = [i for i in range(len(slices)) if edges[i] < min(end, edges[i + 1]) and edges[i + 1] > first]
    if not hit:
        return []
    if end - edges[hit[0]] <= _near(size):
        near = reduce(lambda a, b: a | b, (slices[i] for i in hit))
        return [rows.filter(near).orderBy(*order).offset(first - edges[hit[0]]).limit(size)]
    found = []
    for i in hit:
        start = max(first, edges[i])
        # The rows of one cut are equal in this key.
        rest = numbers[1:] if i % 2 else numbers
        found += _selected(rows.filter(slices[i]), rest, order, start - edges[i], min(end, edges[i + 1]) - start)
    return found
