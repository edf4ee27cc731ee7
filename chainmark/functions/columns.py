"""Column expressions and small frame rewrites for cleaning measurement and section tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.constants import (
    EXCLUDED_ATTRIBUTES, ID_REPAIRS, MAIN_LINE_CODES, OTHER_LINE, TLX_END_KM,
)


def clean_name(name: str) -> str:
    """Lower snake case, e.g. ``Chainage Start (km)`` to ``chainage_start_km``."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its clean name; two columns may not become the same."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning: {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed(dict(names))


def drop_excluded(df: DataFrame, excluded: Sequence[str] = EXCLUDED_ATTRIBUTES) -> DataFrame:
    """P3."""
    return df.drop(*excluded)


def common_columns(frames: Sequence[DataFrame]) -> tuple[list[str], list[list[str]]]:
    """Columns all frames share (in the first one's order), and what each has beyond them."""
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    return shared, [[c for c in f.columns if c not in shared] for f in frames]


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of the shared columns only."""
    shared, _ = common_columns(frames)
    return reduce(lambda a, b: a.unionByName(b), [f.select(*shared) for f in frames])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all columns; a column missing from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing; Spark would otherwise sort it above every number."""
    floats = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def repair_id(col: Column, repairs: Sequence[tuple[str, str]] = ID_REPAIRS) -> Column:
    """P6."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), repairs, col)


def id_part(col: Column, number: int) -> Column:
    """Part of an id split on underscores, counted from 1; null when there is no such part."""
    return F.try_element_at(F.split(col, "_"), F.lit(number))


def line_region(col: Column) -> Column:
    """P9."""
    return id_part(col, 1)


def line_of_id(col: Column, chainage: Column) -> Column:
    """Line of a measurement from the region and line code in its id.

    The exceptions test region and code together, and the codes are one map lookup, so that the id is taken
    apart as few times as possible even where the optimizer copies this expression into a filter.
    """
    both = F.substring_index(col, "_", 2)
    codes = F.create_map(*[F.lit(v) for pair_ in MAIN_LINE_CODES.items() for v in pair_])
    return (
        F.when(both == "Thomas_MLW", F.when(chainage <= TLX_END_KM, "TLX").otherwise("MLX"))
        .when(both == "Firetail_ELB", "SML")
        .when(both == "Future_SLB", "EML")
        .otherwise(F.coalesce(F.try_element_at(codes, id_part(col, 2)), F.lit(OTHER_LINE)))
    )


def chainage_km(major: Column, minor: Column) -> Column:
    """P10: whole kilometres plus metres."""
    return major + minor / F.lit(1000.0)


def as_double(col: Column) -> Column:
    """Number from text; null when the text is none, NaN counts as missing."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def class_key(col: Column) -> Column:
    """``Mild Curve`` to ``mild_curve``."""
    return F.lower(F.replace(col, F.lit(" "), F.lit("_")))


def chainage_key(line: Column | str, start_hm: Column, end_hm: Column) -> Column:
    """Segment key from whole hectometres; the sign is not part of the text."""
    name = F.lit(line) if isinstance(line, str) else line
    return F.format_string("CHAIN-%s-S-%05d-E-%05d-MAINLINE", name, F.abs(start_hm), F.abs(end_hm))


def attribute_key(key: Column) -> Column:
    """TLX segments are listed under MLX in the attribute tables."""
    return F.replace(key, F.lit("TLX"), F.lit("MLX"))


def half_up(col: Column, digits: int) -> Column:
    """Rounding to a number of digits, halves upwards, by plain arithmetic."""
    unit = float(10 ** digits)
    return F.floor(col * F.lit(unit) + F.lit(0.5)) / F.lit(unit)


def half_even(col: Column, digits: int) -> Column:
    """Rounding with halves to the even digit, as the source system rounds."""
    return F.bround(col, digits)


def pair(a: Column, b: Column) -> Column:
    """Two values in order."""
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def or_default(col: Column, default) -> Column:
    """P18."""
    return F.coalesce(col, F.lit(default))


def is_clean(df: DataFrame) -> bool:
    """A measurement table with an ``id`` column was cleaned before."""
    return "id" in df.columns


def tags_of(col: Column) -> Column:
    """comma text to a set of tags."""
    parts = F.transform(F.split(col, ","), lambda t: F.trim(t))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def has_any(tags: Column, wanted: Sequence[str]) -> Column:
    """F8: the two tag sets intersect."""
    return F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted]))


def has_all(tags: Column, wanted: Sequence[str]) -> Column:
    """F8: every wanted tag is present."""
    return reduce(lambda a, b: a & b, [F.array_contains(tags, t) for t in wanted])


def join_set(col: Column) -> Column:
    """K7: a set as sorted comma text."""
    return F.array_join(F.array_sort(F.array_distinct(col)), ",")
