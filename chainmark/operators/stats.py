"""Per-section statistics of measurements, and the status derived from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainmark.constants import SPEED_MEASURES, WEAR_MEASURES
from chainmark.functions.columns import class_key
from chainmark.functions.condition import flag_columns, status_level, status_score, status_string
from chainmark.operators.scale import lookup_join
from chainmark.session import checkpointed, stored

# Largest group whose values one task may hold for exact percentiles: six measures of distinct doubles.
GROUP_ROWS = 1_000_000
PROBS = {"p50": 0.5, "p75": 0.75, "p90": 0.9}


def in_section(points: DataFrame, key: str = "section_id") -> DataFrame:
    """A1: points without a section take part in no group."""
    return points.where(F.col(key).isNotNull())


def _moments(measures: Mapping[str, str]) -> list[Column]:
    out = []
    for source, name in measures.items():
        c = F.col(source)
        out += [F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"),
                _mean(c).alias(f"avg_{name}"), F.stddev_pop(c).alias(f"std_{name}")]
    return out


def _mean(col: Column) -> Column:
    """Mean whose sum is exact to twelve decimals, so that it is the same in every order and can be compared as it is.

    So for groups whose values are zero or of a size from 1e-6 to below 1e14; a group that holds any other value,
    NaN and infinity included, has the plain average of doubles.
    """
    exact, size = col.try_cast("decimal(26,12)"), F.abs(col)
    outside = F.count_if((col.isNotNull() & exact.isNull()) | ((size > 0) & (size < 1e-6)))
    return F.when(outside == 0, F.sum(exact).cast("double") / F.count(exact)).otherwise(F.avg(col.cast("double")))


def _complete(col: Column, missing: str, value: Column) -> Column:
    """With ``propagate`` a group that misses a value has no percentile; ``skip`` ignores missing values."""
    if missing == "skip":
        return value
    return F.when(F.count(col) == F.count(F.lit(1)), value)


def _percentiles(measures: Mapping[str, str], missing: str, approx: bool) -> list[Column]:
    out = []
    for source, name in measures.items():
        c = F.col(source)
        probs = F.array(*[F.lit(p) for p in PROBS.values()])
        found = F.percentile_approx(c, list(PROBS.values())) if approx else F.percentile(c, probs)
        out.append(_complete(c, missing, found).alias(f"_pct_{name}"))
    return out


def _spread(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    cols = {f"{p}_{name}": F.col(f"_pct_{name}")[i] for name in measures.values() for i, p in enumerate(PROBS)}
    return df.withColumns(cols).drop(*[f"_pct_{name}" for name in measures.values()])


def split_percentiles(points: DataFrame, measures: Mapping[str, str], key: str = "section_id", missing: str = "propagate") -> DataFrame:
    """A6 for groups of any size: exact percentiles with no group held in one task.

    Values are counted per (group, measure, value) before the shuffle, range-partitioned by value and written
    once. Counts per range partition give the rank offsets; only the partitions that hold a wanted rank are
    scanned again.
    """
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [key, "_measure"]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("_measure"), F.col(source).cast("double").alias("_value"))
        for source, name in measures.items()]))
    values = (
        points.select(key, pairs.alias("_pair")).select(key, "_pair.*")
        .groupBy(*group, "_value").agg(F.count(F.lit(1)).alias("_cnt"))
    )
    ranged = checkpointed(
        values.repartitionByRange(parts, *group, "_value").sortWithinPartitions(*group, "_value")
        .withColumn("_part", F.spark_partition_id())
    )
    valued = ranged.where(F.col("_value").isNotNull())
    missing_counts = ranged.where(F.col("_value").isNull()).select(*group, F.lit(True).alias("_missing"))
    ordered = Window.partitionBy(*group).orderBy("_part")
    pieces = (
        valued.groupBy(*group, "_part").agg(F.sum("_cnt").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
        .withColumn("_total", F.sum("_size").over(Window.partitionBy(*group)))
    )

    def rank(p: float) -> Column:
        return F.lit(p) * (F.col("_total") - 1)

    wanted = F.lit(False)
    for p in PROBS.values():
        for r in (F.floor(rank(p)), F.ceil(rank(p))):
            wanted = wanted | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")))
    scanned = lookup_join(valued, pieces.where(wanted).drop("_size"), [*group, "_part"], how="inner")
    inside = Window.partitionBy(*group, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    scanned = scanned.withColumn("_end", F.col("_before") + F.sum("_cnt").over(inside))
    scanned = scanned.withColumn("_start", F.col("_end") - F.col("_cnt"))

    def at_rank(r: Column) -> Column:
        return F.max(F.when((r >= F.col("_start")) & (r < F.col("_end")), F.col("_value")))

    picks = []
    for label, p in PROBS.items():
        picks += [at_rank(F.floor(rank(p))).alias(f"_lo_{label}"), at_rank(F.ceil(rank(p))).alias(f"_hi_{label}"),
                  F.max(rank(p) - F.floor(rank(p))).alias(f"_f_{label}")]
    found = scanned.groupBy(*group).agg(*picks)
    interpolated = [
        (F.col(f"_lo_{b}") + (F.col(f"_hi_{b}") - F.col(f"_lo_{b}")) * F.col(f"_f_{b}")).alias(b) for b in PROBS]
    found = found.select(*group, *interpolated)
    if missing != "skip":
        found = lookup_join(found, missing_counts, group).where(F.col("_missing").isNull()).drop("_missing")
    wide = [
        F.max(F.when(F.col("_measure") == name, F.col(p))).alias(f"{p}_{name}")
        for name in measures.values() for p in PROBS]
    return found.groupBy(key).agg(*wide)


def measure_stats(
    points: DataFrame, measures: Mapping[str, str], key: str = "section_id", missing: str = "propagate",
    approx: bool = False, hot_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Count, min, max, mean, population deviation and p50/p75/p90 per group.

    The key and the measures are written once, so that what made them runs once. Sums and counts come first, and
    groups with more than ``hot_rows`` rows take ``split_percentiles``, so that no task holds their values.
    """
    points = in_section(points, key).select(key, *measures)
    count = F.count(F.lit(1)).alias("num_points")
    exact = _percentiles(measures, missing, approx)
    if approx:
        return _spread(points.groupBy(key).agg(count, *_moments(measures), *exact), measures)
    points = stored(points, "measures")
    base = checkpointed(points.groupBy(key).agg(count, *_moments(measures)))
    hot = base.where(F.col("num_points") > hot_rows).select(key, F.lit(True).alias("_hot"))
    if hot.limit(1).count() == 0:
        found = _spread(points.groupBy(key).agg(*exact), measures)
    else:
        marked = lookup_join(points, hot, [key])
        cold = _spread(marked.where(F.col("_hot").isNull()).groupBy(key).agg(*exact), measures)
        found = cold.unionByName(split_percentiles(marked.where(F.col("_hot")).drop("_hot"), measures, key, missing))
    return base.join(found, key, "left")


def rp_stats(points: DataFrame, **options) -> DataFrame:
    """The six wear measures per section."""
    return measure_stats(points, WEAR_MEASURES, **options)


def tg_stats(points: DataFrame) -> DataFrame:
    """Speeds per section."""
    aggs = []
    for c in SPEED_MEASURES:
        aggs += [F.min(c).alias(f"min_{c}"), F.avg(c).alias(f"avg_{c}"), F.max(c).alias(f"max_{c}")]
    return in_section(points).groupBy("section_id").agg(F.count(F.lit(1)).alias("num_points"), *aggs)


def first_section_rows(sections: DataFrame, order: str = "seq") -> DataFrame:
    """First row per section id in table order."""
    others = [c for c in sections.columns if c != "section_id"]
    return (
        sections.groupBy("section_id")
        .agg(F.min_by(F.struct(*others), order).alias("_row"))
        .select("section_id", *[F.col(f"_row.{c}").alias(c) for c in others])
    )


def with_section(stats: DataFrame, sections: DataFrame, order: str = "seq") -> DataFrame:
    """Section attributes onto aggregated rows."""
    return stats.join(first_section_rows(sections, order), "section_id")


def with_status(stats: DataFrame) -> DataFrame:
    """Flags, status string, level and score; needs ``classification`` and ``hand``."""
    flags = flag_columns(class_key(F.col("classification")), F.col("hand"))
    return (
        stats.withColumns(flags)
        .withColumn("status_string", status_string())
        .withColumn("status_level", status_level(F.col("status_string")))
        .withColumn("status_score", status_score(F.col("status_string")))
    )


def unclassified(sections: DataFrame) -> DataFrame:
    """Sections whose class or hand has no limits; their status is null."""
    from chainmark.constants import STATUS_PARAMS
    from chainmark.functions.condition import limit_of

    limits = [limit_of(class_key(F.col("classification")), p, F.col("hand"), t).isNull() for t in "we" for p in STATUS_PARAMS]
    bad = limits[0]
    for term in limits[1:]:
        bad = bad | term
    return sections.where(bad)


def with_speeds(rp_sections: DataFrame, tg_sections: DataFrame) -> DataFrame:
    """Six speed columns onto the wear table."""
    speeds = [f"{a}_{c}" for c in SPEED_MEASURES for a in ("min", "avg", "max")]
    return rp_sections.join(tg_sections.select("section_id", *speeds), "section_id", "left")
