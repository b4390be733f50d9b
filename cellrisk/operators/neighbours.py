"""Neighbour operators on integer grid cells.

All of them are *scatter* plans: every source row is exploded to the cells
it influences (a fixed, small offset list), contributions are combined by a
``groupBy`` on the target key, and Spark's map-side partial aggregation folds
the copies before the shuffle.  When the input is range-partitioned on the
cell keys (see ``cluster_cells``), neighbours share a task and the fan-out
mostly collapses before it reaches the network.

The fan-out always runs on aggregated cells (cell x period / slot rows),
never on raw incidents, so a hot cell costs one row per period, not one row
per incident.

``radius_pairs`` builds the in-radius cell pair table for the haversine
kernel with an equi-join on latitude bands and longitude cells: each row is
exploded to the cells that its circle meets, never to all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk.functions.space import gaussian_weight, haversine_km
from cellrisk.params import CUTOFF_KM, EARTH_RADIUS_KM, SIGMA_KM


def offsets(radius: int, include_self: bool = True) -> list[tuple[int, int]]:
    return [(di, dj) for di in range(-radius, radius + 1) for dj in range(-radius, radius + 1)
            if include_self or (di, dj) != (0, 0)]


def _offset_array(offs: list[tuple[int, int]], weights: list[float] | None = None) -> Column:
    items = []
    for n, (di, dj) in enumerate(offs):
        fields = [F.lit(di).alias("di"), F.lit(dj).alias("dj")]
        if weights is not None:
            fields.append(F.lit(float(weights[n])).alias("w"))
        items.append(F.struct(*fields))
    return F.array(*items)


def cluster_cells(df: DataFrame, gi: str = "gi", gj: str = "gj",
                  num_partitions: int | None = None) -> DataFrame:
    """Range-partition on (gi, gj) so spatial neighbours share a task.  The
    range partitioning also satisfies a later ``Window.partitionBy(gi, gj)``."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, gi, gj)


def scatter(df: DataFrame, keys: list[str], value_cols: dict[str, Column],
            offs: list[tuple[int, int]], weights: list[float] | None,
            gi: str = "gi", gj: str = "gj", carry: list[str] | None = None,
            aggs: dict[str, str] | None = None) -> DataFrame:
    """Generic neighbour scatter.

    Each row is exploded to the cells ``(gi+di, gj+dj)``; ``value_cols`` are
    evaluated per copy with ``w`` (the offset weight) and ``is_self``
    available as columns.  ``aggs`` maps an output name to ``sum``/``count``
    of the named per-copy column.  ``carry`` columns are picked from the
    self copy, so the source row is re-attached by the same shuffle: the
    result holds one row per (target, other keys) with ``_present`` = 1 when
    the target itself was a source row.
    """
    carry = carry or []
    other = [k for k in keys if k not in (gi, gj)]
    arr = _offset_array(offs, weights)
    ex = (df.withColumn("_o", F.explode(arr))
          .withColumn("is_self", (F.col("_o.di") == 0) & (F.col("_o.dj") == 0))
          .withColumn("w", F.col("_o.w") if weights is not None else F.lit(1.0)))
    ex = ex.select(
        (F.col(gi) + F.col("_o.di")).cast("int").alias(gi),
        (F.col(gj) + F.col("_o.dj")).cast("int").alias(gj),
        *other, "is_self",
        *[c.alias(n) for n, c in value_cols.items()],
        *[F.when(F.col("is_self"), F.col(c)).alias(c) for c in carry])
    agg_exprs = []
    for out, (fn, src) in (aggs or {}).items():
        agg_exprs.append(getattr(F, fn)(src).alias(out))
    agg_exprs += [F.max(c).alias(c) for c in carry]
    agg_exprs.append(F.max(F.col("is_self").cast("int")).alias("_present"))
    return ex.groupBy(gi, gj, *other).agg(*agg_exprs)


def kernel_sum(df: DataFrame, value: str, out: str, keys: list[str], radius: int = 2,
               bandwidth: float = 1.0, gi: str = "gi", gj: str = "gj") -> DataFrame:
    """``out[c] = sum_{|di|,|dj|<=radius} value[c+d] * exp(-(di^2+dj^2)/(2 bw^2))``
    (not normalised; absent cells count 0), added to the rows of ``df``.
    Only the keys and the value fan out; the sums come back by a key join."""
    offs = offsets(radius)
    ws = [math.exp(-(di * di + dj * dj) / (2.0 * bandwidth * bandwidth)) for di, dj in offs]
    res = scatter(df.select(*keys, value), keys, {"_v": F.col(value) * F.col("w")}, offs, ws, gi, gj,
                  aggs={out: ("sum", "_v")})
    return df.join(res.drop("_present"), keys, "left")


def neighbour_mean(df: DataFrame, value: str, out: str, keys: list[str],
                   fixed_divisor: float | None = None, gi: str = "gi", gj: str = "gj") -> DataFrame:
    """Mean of ``value`` over the 8 surrounding cells, added to the rows of
    ``df``.  Only the keys and the value fan out.

    ``fixed_divisor=None``: divide by the neighbours present with a non-null
    value, none -> null.  ``fixed_divisor=8``: sum over present neighbours / 8
    always (absent neighbours count 0)."""
    offs = offsets(1)
    vals = {"_v": F.when(~F.col("is_self"), F.col(value)),
            "_n": F.when(~F.col("is_self") & F.col(value).isNotNull(), F.lit(1))}
    res = scatter(df.select(*keys, value), keys, vals, offs, None, gi, gj,
                  aggs={"_s": ("sum", "_v"), "_k": ("count", "_n")})
    res = df.join(res.drop("_present"), keys, "left")
    if fixed_divisor is None:
        m = F.when(F.col("_k") > 0, F.col("_s") / F.col("_k"))
    else:
        m = F.coalesce(F.col("_s"), F.lit(0.0)) / F.lit(float(fixed_divisor))
    return res.withColumn(out, m.cast("double")).drop("_s", "_k")


def _band_cells(band: Column, reach: float) -> Column:
    """Into how many longitude cells a latitude band is cut: each is at least as
    wide as the reach of any point of the band and of those beside it; bands
    from which the pole is in reach are one cell."""
    edge = F.greatest(F.abs((band - 1) * reach - 90), F.abs((band + 2) * reach - 90))
    return F.when(edge + reach >= 90, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / _lon_reach(edge, reach)))).cast("int")


def _lon_reach(lat: Column, reach: float) -> Column:
    """Degrees of longitude that a circle of ``reach`` degrees around a point spans to each side."""
    return F.when(F.abs(lat) + reach >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(math.radians(reach))) / F.cos(F.radians(lat))))))


def radius_pairs(cells: DataFrame, cutoff_km: float = CUTOFF_KM, sigma_km: float = SIGMA_KM,
                 cell: str = "cell_id", lat: str = "lat_r", lon: str = "lon_r") -> DataFrame:
    """All (cell, neighbour) pairs with haversine distance <= cutoff, with
    the Gaussian weight, anywhere on the globe.  ``cells`` holds one row per cell;
    cells without coordinates have no pairs.

    Plan: latitude bands as high as the cutoff, each cut into longitude cells of
    its own width, modulo 360.  A row is in one (band, cell); the probe side is
    exploded to the cells that its circle meets in its own band and the two
    beside it, from its own latitude; then an equi-join on integer keys and a
    distance filter.
    """
    reach = min(180.0, math.degrees(cutoff_km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-9)
    turned = F.pmod(F.col(lon).cast("double"), F.lit(360.0))
    base = (cells.select(F.col(cell), F.col(lat).cast("double").alias("_lat"), turned.alias("_lon"), F.col(lon).cast("double").alias("_own")).filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
            .withColumn("_band", F.floor((F.col("_lat") + 90) / reach).cast("int")))

    def place(at: Column, n: Column) -> Column:
        return F.floor(at * n / 360).cast("int")
    probe = base.select(F.col(cell).alias("src"), F.col("_lat").alias("src_lat"), F.col("_own").alias("src_lon"), "_lon",
                        F.explode(F.sequence(F.col("_band") - 1, F.col("_band") + 1)).alias("_band"))
    probe = probe.withColumns({"_n": _band_cells(F.col("_band"), reach), "_span": _lon_reach(F.col("src_lat"), reach) + 1e-9})
    first, last = (place(F.col("_lon") + sign * F.col("_span"), F.col("_n")) for sign in (-1, 1))
    met = F.sequence(first, F.least(last, first + F.col("_n") - 1))
    probe = probe.select("src", "src_lat", "src_lon", "_band", "_n", F.explode(met).alias("_place")).withColumn("_place", F.pmod("_place", "_n"))
    build = base.select(F.col(cell).alias("nbr"), F.col("_lat").alias("nbr_lat"), F.col("_own").alias("nbr_lon"), "_band",
                        F.pmod(place(F.col("_lon"), _band_cells(F.col("_band"), reach)), _band_cells(F.col("_band"), reach)).alias("_place"))
    d = haversine_km("src_lat", "src_lon", "nbr_lat", "nbr_lon")
    return (probe.join(build, ["_band", "_place"]).withColumn("d_km", d).filter(F.col("d_km") <= F.lit(cutoff_km))
            .select(F.col("src").alias(cell), "nbr", "d_km", gaussian_weight(F.col("d_km"), sigma_km).alias("w")))
