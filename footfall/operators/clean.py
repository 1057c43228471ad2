"""Row filters and flat projections of raw logs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _present(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "string":
        return F.trim(F.col(name)) != ""
    return F.col(name).isNotNull()


def is_clean(df: DataFrame, require: Iterable[str], any_of: Iterable[str] = ()) -> Column:
    """Whether every ``require`` column and at least one ``any_of`` column of a row has a value; never null."""
    parts = [F.coalesce(_present(df, name), F.lit(False)) for name in require]
    choices = [F.coalesce(_present(df, name), F.lit(False)) for name in any_of]
    if choices:
        parts.append(reduce(lambda a, b: a | b, choices))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def clean_events(df: DataFrame, require: Iterable[str], any_of: Iterable[str] = ()) -> DataFrame:
    """Keep rows where every ``require`` column and at least one ``any_of`` column has a value."""
    for name in require:
        df = df.where(_present(df, name))
    choices = [_present(df, name) for name in any_of]
    return df.where(reduce(lambda a, b: a | b, choices)) if choices else df


def extract_props(df: DataFrame, keys: Mapping[str, str] | Sequence[str], col: str = "properties") -> DataFrame:
    """Lift map entries to columns; a missing key gives null. ``keys``: {map key: column name} or keys."""
    pairs = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    return df.withColumns({name: F.col(col)[k] for k, name in pairs.items()})


def encode(
    df: DataFrame,
    maps: Mapping[str, Mapping[str, float]] | None = None,
    bins: Mapping[str, Sequence[tuple[float, float]]] | None = None,
    other: float | None = None,
    suffix: str = "_code",
) -> DataFrame:
    """Code categories and bin ranges.

    ``maps``: {column: {value: code}}; a value without a code gives null.
    ``bins``: {column: [(low, high), ...]}, both ends included, coded 1, 2, ...; a value in no
    range gets ``other`` or, by default, the next code.
    """
    out: dict[str, Column] = {}
    for name, codes in (maps or {}).items():
        expr = F.lit(None).cast("double")
        for value, code in codes.items():
            expr = F.when(F.col(name) == F.lit(value), F.lit(float(code))).otherwise(expr)
        out[name + suffix] = expr
    for name, ranges in (bins or {}).items():
        number = F.col(name).try_cast("double")
        expr = F.lit(float(other if other is not None else len(ranges) + 1))
        for code in range(len(ranges), 0, -1):
            low, high = ranges[code - 1]
            expr = F.when(number.between(low, high), F.lit(float(code))).otherwise(expr)
        out[name + suffix] = expr
    return df.withColumns(out)


def mask_fields(df: DataFrame, cols: Iterable[str], how: str = "sha2") -> DataFrame:
    """Hide private fields: ``sha2`` keeps them joinable, ``mask`` keeps only their shape."""
    if how not in ("sha2", "mask"):
        raise ValueError("how must be 'sha2' or 'mask'")
    hide = (lambda c: F.sha2(F.col(c).cast("string"), 256)) if how == "sha2" else (lambda c: F.mask(F.col(c)))
    return df.withColumns({c: hide(c) for c in cols})
