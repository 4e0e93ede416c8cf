"""Cleaning: drop blank columns, drop blank rows.

Drop-null-fields rule. A leaf column is dropped when every value it holds
(after trimming text) lies in a blank set: ``{'', 'null'}`` for text,
``{-1}`` for int / bigint / double. NULL-typed columns are always dropped.
The rule recurses into structs and arrays of structs (for a leaf under an
array, every element of every row counts). Other types and arrays of
primitives are never dropped.

A real NULL is *not* blank by default: the set of values ``{NULL, ''}`` is
not a subset of ``{'', 'null'}``, so such a column is kept. Pass
``null_is_blank=True`` to treat NULL as blank.

Instead of one ``distinct().collect()`` per column, the whole decision is one
aggregate job: a ``bool_and`` per leaf, partially aggregated on every
executor, so only one row per task crosses the shuffle and one row (one
boolean per column) reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.casts import python_strip
from towerlens.schema import NULL_NUMBER_SET, NULL_STRING_SET, PAYLOAD_FIELDS, MEASURED_AT

_NUMERIC = (T.IntegerType, T.LongType, T.DoubleType)

Path = tuple[str, ...]


def _column(path: list[str]) -> Column:
    return F.col(".".join("`" + name.replace("`", "``") + "`" for name in path))


def _is_blank(value: Column, dtype: T.DataType, null_strings, null_numbers,
              null_is_blank: bool) -> Column | None:
    if isinstance(dtype, T.StringType):
        test = python_strip(value).isin(list(null_strings))
    elif isinstance(dtype, _NUMERIC):
        test = value.isin([float(x) if isinstance(dtype, T.DoubleType) else int(x)
                           for x in null_numbers])
    else:
        return None
    return F.coalesce(test, F.lit(bool(null_is_blank)))


def _leaves(dtype: T.DataType, path: list[str], under_array: list[int]):
    """Yield (path, leaf type, index of array levels) for checkable leaves."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, path + [f.name], under_array)
    elif isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StructType):
            yield from _leaves(dtype.elementType, path, under_array + [len(path)])
    else:
        yield path, dtype, under_array


def _row_test(path: list[str], dtype: T.DataType, arrays: list[int], null_strings,
              null_numbers, null_is_blank: bool) -> Column | None:
    """Per-row boolean: is this leaf blank in this row (all its elements)?"""
    if isinstance(dtype, T.NullType):
        return None
    if not arrays:
        return _is_blank(_column(path), dtype, null_strings,
                         null_numbers, null_is_blank)
    if len(arrays) > 1:
        return F.lit(False)  # arrays of arrays: never dropped

    cut = arrays[0]
    arr = _column(path[:cut])
    inner = path[cut:]

    def elem_blank(x: Column) -> Column:
        v = x
        for name in inner:
            v = v.getField(name)
        return _is_blank(v, dtype, null_strings, null_numbers, null_is_blank)

    if _is_blank(F.lit(None), dtype, null_strings, null_numbers, null_is_blank) is None:
        return None
    # a NULL array counts as one NULL value; an empty array adds nothing
    return F.coalesce(F.forall(arr, elem_blank), F.lit(bool(null_is_blank)))


def scan_null_fields(df: DataFrame, null_strings=NULL_STRING_SET,
                     null_numbers=NULL_NUMBER_SET,
                     null_is_blank: bool = False) -> tuple[list[Path], int]:
    """(paths the drop-null-fields rule removes, number of rows).

    A path is the tuple of names from the top column down, so a dot inside a
    name means nothing.

    One aggregate job; the row count comes with it, so a caller that must
    skip empty batches needs no separate count.
    """
    always: list[Path] = []
    tests: list[tuple[Path, Column]] = []
    leaves = list(_leaves(df.schema, [], []))
    for path, dtype, arrays in leaves:
        if isinstance(dtype, T.NullType):
            always.append(tuple(path))
            continue
        t = _row_test(path, dtype, arrays, null_strings, null_numbers, null_is_blank)
        if t is not None:
            tests.append((tuple(path), t))
    # bool_and over zero rows is NULL: an empty set is a subset of any set
    aggs = [F.coalesce(F.bool_and(t), F.lit(True)).alias(f"c{i}")
            for i, (_, t) in enumerate(tests)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).collect()[0]
    blank = [p for i, (p, _) in enumerate(tests) if row[f"c{i}"]]
    order = {tuple(p): i for i, (p, _, _) in enumerate(leaves)}
    return sorted(always + blank, key=lambda p: order[p]), int(row["n"])


def find_null_fields(df: DataFrame, null_strings=NULL_STRING_SET,
                     null_numbers=NULL_NUMBER_SET, null_is_blank: bool = False) -> list[Path]:
    """Paths of the leaf columns that the drop-null-fields rule removes."""
    return scan_null_fields(df, null_strings, null_numbers, null_is_blank)[0]


def _drop_in_type(dtype: T.DataType, value: Column, rel: list[list[str]]) -> Column | None:
    """Rebuild ``value`` (of ``dtype``) without the relative paths ``rel``.

    Returns None when nothing of the value would remain.
    """
    if isinstance(dtype, T.ArrayType):
        keep_elem = _drop_in_type(dtype.elementType, F.lit(None), rel)
        if keep_elem is None:
            return None
        return F.transform(value, lambda x: _drop_in_type(dtype.elementType, x, rel))
    assert isinstance(dtype, T.StructType)
    here = {p[0] for p in rel if len(p) == 1}
    deeper: dict[str, list[list[str]]] = {}
    for p in rel:
        if len(p) > 1:
            deeper.setdefault(p[0], []).append(p[1:])
    out = value
    remaining = 0
    for f in dtype.fields:
        if f.name in here:
            continue
        if f.name in deeper:
            sub = _drop_in_type(f.dataType, value.getField(f.name), deeper[f.name])
            if sub is None:
                here.add(f.name)
                continue
            out = out.withField(f.name, sub)
        remaining += 1
    if remaining == 0:
        return None
    if here:
        out = out.dropFields(*sorted(here))
    return out


def drop_fields(df: DataFrame, paths: list[Path]) -> DataFrame:
    """Drop columns by path; nested struct and array-of-struct paths too.

    A struct left without fields is dropped as a whole.
    """
    top: set[str] = set()
    nested: dict[str, list[list[str]]] = {}
    for p in paths:
        parts = list(p)
        if len(parts) == 1:
            top.add(parts[0])
        else:
            nested.setdefault(parts[0], []).append(parts[1:])
    cols: list[Column] = []
    for f in df.schema.fields:
        if f.name in top:
            continue
        if f.name in nested:
            v = _drop_in_type(f.dataType, _column([f.name]), nested[f.name])
            if v is None:
                continue
            cols.append(v.alias(f.name))
        else:
            cols.append(_column([f.name]))
    return df.select(*cols)


def drop_null_fields(df: DataFrame, null_strings=NULL_STRING_SET,
                     null_numbers=NULL_NUMBER_SET, null_is_blank: bool = False) -> DataFrame:
    return drop_fields(df, find_null_fields(df, null_strings, null_numbers, null_is_blank))


def clear_null_fields_by(df: DataFrame, keys: list[str], null_strings=NULL_STRING_SET,
                         null_numbers=NULL_NUMBER_SET, null_is_blank: bool = False) -> DataFrame:
    """The drop-null-fields rule decided in each group of ``keys`` on its own.

    A field that is blank in a whole group is NULL in its rows: groups share one
    schema, and a dropped field is restored as NULL by the mapping anyway. The
    flags are one row a group (partial ``bool_and`` in each task), joined back on the keys; a
    NULL key is a group. Columns that may be blank are top-level text and numbers.
    """
    tests = {}
    for f in df.schema.fields:
        if f.name not in keys:
            test = _is_blank(_column([f.name]), f.dataType, null_strings, null_numbers, null_is_blank)
            if test is not None:
                tests[f.name] = test
    if not tests:
        return df
    flags = df.groupBy(*[_column([k]).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        *[F.bool_and(t).alias(f"_blank{i}") for i, t in enumerate(tests.values())])
    same = reduce(lambda a, b: a & b, [_column([k]).eqNullSafe(flags[f"_key{i}"]) for i, k in enumerate(keys)])
    at = {c: i for i, c in enumerate(tests)}
    return df.join(flags, same).select(*[
        F.when(~flags[f"_blank{at[c]}"], _column([c])).alias(c) if c in at else _column([c]) for c in df.columns])


def remove_null_rows(df: DataFrame, payload: list[str] | None = None,
                     extended: bool = True) -> DataFrame:
    """Remove rows whose payload fields are all NULL (``extended``: or blank text).

    Metadata such as ``record_ts`` is not payload; were it included, no row
    could ever qualify.
    """
    if payload is None:
        wanted = set(PAYLOAD_FIELDS) | {MEASURED_AT}
        payload = [c for c in df.columns if c in wanted]
    if not payload:
        return df
    types = dict((f.name, f.dataType) for f in df.schema.fields)

    def empty(c: str) -> Column:
        col = F.col(f"`{c}`")
        if extended and isinstance(types[c], T.StringType):
            return col.isNull() | (F.trim(col) == "")
        return col.isNull()

    all_empty = reduce(lambda a, b: a & b, [empty(c) for c in payload])
    return df.filter(~all_empty)
