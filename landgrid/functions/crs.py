"""Map projections as column arithmetic, following the published closed forms.

Albers equal-area conic: Snyder, "Map Projections: A Working Manual" (USGS PP 1395), chapter 14.
Transverse Mercator: the Krueger series in the third flattening n, to order n^4.
The shift between NAD83 and WGS84 is taken as zero.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgrid.functions.geom import _col

# fixed values: the GRS 1980 ellipsoid
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101


def _atanh(v: Column) -> Column:
    return F.log((1 + v) / (1 - v)) / 2


@dataclass(frozen=True)
class Albers:
    lat_origin: float
    lon_origin: float
    parallel_1: float
    parallel_2: float
    false_east: float = 0.0
    false_north: float = 0.0

    def _constants(self):
        e2 = GRS80_F * (2 - GRS80_F)
        e = math.sqrt(e2)

        def authalic(lat):
            s = math.sin(math.radians(lat))
            return (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)

        def scale(lat):
            s = math.sin(math.radians(lat))
            return math.cos(math.radians(lat)) / math.sqrt(1 - e2 * s * s)

        m1, m2 = scale(self.parallel_1), scale(self.parallel_2)
        q0, q1, q2 = (authalic(v) for v in (self.lat_origin, self.parallel_1, self.parallel_2))
        n = math.sin(math.radians(self.parallel_1)) if q1 == q2 else (m1 * m1 - m2 * m2) / (q2 - q1)
        c = m1 * m1 + n * q1
        return e2, e, n, c, GRS80_A * math.sqrt(c - n * q0) / n

    def forward(self, lon, lat) -> tuple[Column, Column]:
        e2, e, n, c, rho0 = self._constants()
        s = F.sin(F.radians(_col(lat)))
        q = (1 - e2) * (s / (1 - e2 * s * s) + _atanh(e * s) / e)
        rho = GRS80_A * F.sqrt(c - n * q) / n
        theta = n * F.radians(_col(lon) - self.lon_origin)
        return self.false_east + rho * F.sin(theta), self.false_north + rho0 - rho * F.cos(theta)

    def inverse(self, x, y) -> tuple[Column, Column]:
        e2, e, n, c, rho0 = self._constants()
        east, north = _col(x) - self.false_east, rho0 - (_col(y) - self.false_north)
        rho2 = east * east + north * north
        theta = F.atan2(math.copysign(1.0, n) * east, math.copysign(1.0, n) * north)
        q = (c - rho2 * (n * n) / (GRS80_A * GRS80_A)) / n
        q_pole = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
        beta = F.asin(q / q_pole)
        # series from the authalic to the geodetic latitude
        lat = (beta
               + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta)
               + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta)
               + (761 * e2**3 / 45360) * F.sin(6 * beta))
        return self.lon_origin + F.degrees(theta / n), F.degrees(lat)


@dataclass(frozen=True)
class TransverseMercator:
    lon_origin: float
    scale: float = 0.9996
    false_east: float = 500000.0
    false_north: float = 0.0

    def _series(self):
        n = GRS80_F / (2 - GRS80_F)
        radius = GRS80_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
                 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
                 61 * n**3 / 240 - 103 * n**4 / 140,
                 49561 * n**4 / 161280)
        beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
                n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
                17 * n**3 / 480 - 37 * n**4 / 840,
                4397 * n**4 / 161280)
        delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
                 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
                 56 * n**3 / 15 - 136 * n**4 / 35,
                 4279 * n**4 / 630)
        return n, radius * self.scale, alpha, beta, delta

    def forward(self, lon, lat) -> tuple[Column, Column]:
        n, radius, alpha, _, _ = self._series()
        k = 2 * math.sqrt(n) / (1 + n)
        s = F.sin(F.radians(_col(lat)))
        t = F.sinh(_atanh(s) - k * _atanh(k * s))
        dlon = F.radians(_col(lon) - self.lon_origin)
        xi = F.atan2(t, F.cos(dlon))
        eta = _atanh(F.sin(dlon) / F.sqrt(1 + t * t))
        east, north = eta, xi
        for j, a in enumerate(alpha, start=1):
            east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        return self.false_east + radius * east, self.false_north + radius * north

    def inverse(self, x, y) -> tuple[Column, Column]:
        _, radius, _, beta, delta = self._series()
        xi0 = (_col(y) - self.false_north) / radius
        eta0 = (_col(x) - self.false_east) / radius
        xi, eta = xi0, eta0
        for j, b in enumerate(beta, start=1):
            xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
            eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        lat = chi
        for j, d in enumerate(delta, start=1):
            lat = lat + d * F.sin(2 * j * chi)
        return self.lon_origin + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


# fixed values: EPSG parameters of the systems in use
CALIFORNIA_ALBERS_PROJECTION = Albers(0.0, -120.0, 34.0, 40.5, 0.0, -4000000.0)
CONUS_ALBERS_PROJECTION = Albers(23.0, -96.0, 29.5, 45.5, 0.0, 0.0)
UTM_10N_PROJECTION = TransverseMercator(-123.0)

PROJECTIONS = {3310: CALIFORNIA_ALBERS_PROJECTION, 5070: CONUS_ALBERS_PROJECTION, 26910: UTM_10N_PROJECTION}


def reproject(x, y, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates from one system to another, over longitude and latitude (4326)."""
    for srid in (source, target):
        if srid != 4326 and srid not in PROJECTIONS:
            raise ValueError(f"unknown SRID {srid}; known are 4326 and {sorted(PROJECTIONS)}")
    x, y = _col(x), _col(y)
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else PROJECTIONS[source].inverse(x, y)
    return (lon, lat) if target == 4326 else PROJECTIONS[target].forward(lon, lat)
