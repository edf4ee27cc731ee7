"""Map projections as column arithmetic: transverse Mercator zones and web Mercator."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ellipsoids (semi-major axis in metres, inverse flattening) and the zone grid.
GRS80 = (6378137.0, 298.257222101)
WGS84 = (6378137.0, 298.257223563)
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
WEB_MERCATOR = 3857
LONLAT = 4326


@dataclass(frozen=True)
class Zone:
    """One transverse Mercator zone and its series of third order in the third flattening."""

    meridian: float
    north: float
    ellipsoid: tuple[float, float]

    @property
    def n(self) -> float:
        f = 1.0 / self.ellipsoid[1]
        return f / (2.0 - f)

    @property
    def radius(self) -> float:
        n = self.n
        return SCALE * self.ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def alpha(self) -> list[float]:
        n = self.n
        return [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]

    @property
    def beta(self) -> list[float]:
        n = self.n
        return [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]

    @property
    def delta(self) -> list[float]:
        n = self.n
        return [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]


def zone_of(srid: int) -> Zone:
    """Zone of an EPSG code: 283zz (GDA94), 326zz (north) or 327zz (south)."""
    family, number = divmod(srid, 100)
    meridian = 6.0 * number - 183.0
    if not 1 <= number <= 60:
        raise ValueError(f"unsupported EPSG code: {srid}")
    if family == 283:
        return Zone(meridian, FALSE_NORTHING_SOUTH, GRS80)
    if family == 326:
        return Zone(meridian, 0.0, WGS84)
    if family == 327:
        return Zone(meridian, FALSE_NORTHING_SOUTH, WGS84)
    raise ValueError(f"unsupported EPSG code: {srid}")


# Values by name: a dict of columns, or one struct column.
Step = Callable[[Mapping[str, Column] | Column], dict[str, Column]]


def _forward_steps(srid: int) -> list[Step]:
    """Degrees (x, y) to metres in steps, each naming the values the next one uses more than once."""
    if srid == LONLAT:
        return []
    if srid == WEB_MERCATOR:
        r = WGS84[0]
        return [lambda v: {"x": F.radians(v["x"]) * r, "y": F.log(F.tan(F.lit(math.pi / 4) + F.radians(v["y"]) / 2)) * r}]
    zone = zone_of(srid)
    k = 2 * math.sqrt(zone.n) / (1 + zone.n)

    def angles(v):
        return {"s": F.sin(F.radians(v["y"])), "lon": F.radians(v["x"] - F.lit(zone.meridian))}

    def conformal(v):
        return {"t": F.sinh(F.atanh(v["s"]) - F.lit(k) * F.atanh(F.lit(k) * v["s"])), "lon": v["lon"]}

    def sphere(v):
        return {"xi": F.atan2(v["t"], F.cos(v["lon"])), "eta": F.atanh(F.sin(v["lon"]) / F.sqrt(F.lit(1.0) + v["t"] * v["t"]))}

    def series(v):
        east, north = v["eta"], v["xi"]
        for j, a in enumerate(zone.alpha, start=1):
            east = east + F.lit(a) * F.cos(v["xi"] * (2.0 * j)) * F.sinh(v["eta"] * (2.0 * j))
            north = north + F.lit(a) * F.sin(v["xi"] * (2.0 * j)) * F.cosh(v["eta"] * (2.0 * j))
        return {"x": F.lit(FALSE_EASTING) + east * F.lit(zone.radius), "y": F.lit(zone.north) + north * F.lit(zone.radius)}

    return [angles, conformal, sphere, series]


def _inverse_steps(srid: int) -> list[Step]:
    """Metres (x, y) to degrees in steps."""
    if srid == LONLAT:
        return []
    if srid == WEB_MERCATOR:
        r = WGS84[0]
        return [lambda v: {"x": F.degrees(v["x"] / r), "y": F.degrees(F.atan(F.exp(v["y"] / r)) * 2 - F.lit(math.pi / 2))}]
    zone = zone_of(srid)

    def scaled(v):
        return {"xi": (v["y"] - F.lit(zone.north)) / F.lit(zone.radius), "eta": (v["x"] - F.lit(FALSE_EASTING)) / F.lit(zone.radius)}

    def sphere(v):
        xi, eta = v["xi"], v["eta"]
        for j, b in enumerate(zone.beta, start=1):
            xi = xi - F.lit(b) * F.sin(v["xi"] * (2.0 * j)) * F.cosh(v["eta"] * (2.0 * j))
            eta = eta - F.lit(b) * F.cos(v["xi"] * (2.0 * j)) * F.sinh(v["eta"] * (2.0 * j))
        return {"xi": xi, "eta": eta}

    def latitude(v):
        return {"chi": F.asin(F.sin(v["xi"]) / F.cosh(v["eta"])), "lon": F.atan2(F.sinh(v["eta"]), F.cos(v["xi"]))}

    def series(v):
        lat = v["chi"]
        for j, d in enumerate(zone.delta, start=1):
            lat = lat + F.lit(d) * F.sin(v["chi"] * (2.0 * j))
        return {"x": F.lit(zone.meridian) + F.degrees(v["lon"]), "y": F.degrees(lat)}

    return [scaled, sphere, latitude, series]


def _chain(x: Column, y: Column, steps: list[Step]) -> tuple[Column, Column]:
    values = {"x": x, "y": y}
    for step in steps:
        values = step(values)
    return values["x"], values["y"]


def _chain_over(pts: Column, steps: list[Step]) -> Column:
    """The steps over a vertex list, one pass per step, so that no value is worked out twice."""
    for step in steps:
        def one(p):
            return F.struct(*[c.alias(name) for name, c in step(p).items()])  # noqa: B023
        pts = F.transform(pts, one)
    return pts


def forward(lon: Column, lat: Column, srid: int) -> tuple[Column, Column]:
    """G1: degrees to metres."""
    return _chain(lon, lat, _forward_steps(srid))


def inverse(x: Column, y: Column, srid: int) -> tuple[Column, Column]:
    """G1: metres to degrees."""
    return _chain(x, y, _inverse_steps(srid))


def forward_line(pts: Column, srid: int) -> Column:
    """G1: a vertex list in degrees to metres."""
    return _chain_over(pts, _forward_steps(srid))


def inverse_line(pts: Column, srid: int) -> Column:
    """G1: a vertex list in metres to degrees."""
    return _chain_over(pts, _inverse_steps(srid))


def utm_srid(lon: Column, lat: Column) -> Column:
    """EPSG code of the zone a position lies in; null without a position."""
    number = F.least(F.greatest(F.floor((lon + 180.0) / 6.0) + 1, F.lit(1)), F.lit(60))
    return (F.when(lat < 0, F.lit(32700)).otherwise(F.lit(32600)) + number).cast("int")


def working_srid(setting: str, layers, geometry: str = "geometry") -> int:
    """EPSG code to work in: the named one, or with ``utm`` the zone that most rows of the first layer with
    positions lie in, of equally common ones the smallest code.

    ``layers`` hold lon/lat points or vertex lists, of which the first vertex counts. With no position at all the fallback
    is web Mercator.
    """
    if setting.lower().startswith("epsg:"):
        return int(setting.split(":")[1])
    for layer in layers:
        if geometry not in layer.columns:
            continue
        kind = layer.schema[geometry].dataType.typeName()
        p = F.col(geometry) if kind == "struct" else F.get(F.col(geometry), F.lit(0))
        zones = layer.select(utm_srid(p["x"], p["y"]).alias("srid")).where("srid is not null").groupBy("srid").agg(F.count(F.lit(1)).alias("n"))
        row = zones.orderBy(F.desc("n"), "srid").first()
        if row:
            return row["srid"]
    return WEB_MERCATOR
