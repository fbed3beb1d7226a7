"""Coordinate systems as staged columns: Krovak east-north (EPSG:5514), web Mercator (3857), UTM (326xx, 327xx).

Each step is a column of its own. The optimiser keeps a column apart if it is used more than once, so no formula is
written out again inside another, and generated code stays small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values, published with the coordinate system: ellipsoids, datum shift and Krovak parameters.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
BESSEL_A, BESSEL_F = 6377397.155, 1 / 299.1528128
SHIFT = (572.213, 85.334, 461.94)
ROTATION = tuple(math.radians(s / 3600) for s in (4.9732, 1.529, 5.2484))
SCALE = 3.5378e-6
KROVAK_E2 = 0.006674372230614
LATITUDE, LONGITUDE = math.radians(49.5), math.radians(24 + 50 / 60)
CONE, PARALLEL, K0 = math.pi / 2 - 1.04216856380474, math.radians(78.5), 0.9999


_STEPS = "_proj_"


def _step(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns({_STEPS + n: c for n, c in columns.items()})


def _c(name: str) -> Column:
    return F.col(_STEPS + name)


def _done(df: DataFrame, out: tuple[str, str], finite: Column, first: Column, second: Column) -> DataFrame:
    """The result as an array of one struct taken apart again: conditions on it, and such as the optimiser infers, stop
    there. Pushed further they would have each step written out in all that use it, whose number doubles with each."""
    others = [c for c in df.columns if not c.startswith(_STEPS) and c not in out]
    place = F.struct(F.when(finite, first).alias(out[0]), F.when(finite, second).alias(out[1]))
    return df.select(*others, F.inline(F.array(place)))


def _finite(lon: Column, lat: Column) -> Column:
    return ~F.isnan(lon) & ~F.isnan(lat) & (F.abs(lon) <= 360) & (F.abs(lat) <= 90)


def krovak(df: DataFrame, lon: str = "lon", lat: str = "lat", out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """df with metres east and north; NULL where a coordinate is NULL or not finite."""
    e2 = WGS84_F * (2 - WGS84_F)
    df = _step(df, lam=F.radians(lon), sin=F.sin(F.radians(lat)), cos=F.cos(F.radians(lat)))
    df = _step(df, n=WGS84_A / F.sqrt(1 - e2 * _c("sin") * _c("sin")))
    geocentric = (_c("n") * _c("cos") * F.cos(_c("lam")), _c("n") * _c("cos") * F.sin(_c("lam")), _c("n") * (1 - e2) * _c("sin"))
    df = _step(df, **{k: (v - t) / (1 + SCALE) for k, v, t in zip(("x0", "y0", "z0"), geocentric, SHIFT)})
    rx, ry, rz = ROTATION
    x, y, z = _c("x0"), _c("y0"), _c("z0")
    df = _step(df, x1=x + rz * y - ry * z, y1=y - rz * x + rx * z, z1=z + ry * x - rx * y)
    b, e2 = BESSEL_A * (1 - BESSEL_F), BESSEL_F * (2 - BESSEL_F)
    x, y, z = _c("x1"), _c("y1"), _c("z1")
    df = _step(df, r=F.sqrt(x * x + y * y))
    df = _step(df, th=F.atan2(z * BESSEL_A, _c("r") * b))
    df = _step(df, s3=F.pow(F.sin(_c("th")), F.lit(3.0)), c3=F.pow(F.cos(_c("th")), F.lit(3.0)))
    df = _step(df, lam2=F.atan2(y, x), phi2=F.atan2(z + e2 / (1 - e2) * b * _c("s3"), _c("r") - e2 * BESSEL_A * _c("c3")))
    e, sin0 = math.sqrt(KROVAK_E2), math.sin(LATITUDE)
    a = BESSEL_A * math.sqrt(1 - KROVAK_E2) / (1 - KROVAK_E2 * sin0**2)
    b = math.sqrt(1 + KROVAK_E2 * math.cos(LATITUDE) ** 4 / (1 - KROVAK_E2))
    gamma = math.asin(sin0 / b)
    t0 = math.tan(math.pi / 4 + gamma / 2) * ((1 + e * sin0) / (1 - e * sin0)) ** (e * b / 2) / math.tan(math.pi / 4 + LATITUDE / 2) ** b
    n, r0 = math.sin(PARALLEL), K0 * a / math.tan(PARALLEL)
    df = _step(df, es=e * F.sin(_c("phi2")))
    df = _step(df, u=2 * (F.atan(t0 * F.pow(F.tan(_c("phi2") / 2 + math.pi / 4), F.lit(b)) / F.pow((1 + _c("es")) / (1 - _c("es")), F.lit(e * b / 2))) - math.pi / 4),
               v=b * (LONGITUDE - _c("lam2")))
    df = _step(df, t=F.asin(math.cos(CONE) * F.sin(_c("u")) + math.sin(CONE) * F.cos(_c("u")) * F.cos(_c("v"))))
    df = _step(df, d=n * F.asin(F.cos(_c("u")) * F.sin(_c("v")) / F.cos(_c("t"))),
               rho=r0 * math.tan(PARALLEL / 2 + math.pi / 4) ** n / F.pow(F.tan(_c("t") / 2 + math.pi / 4), F.lit(n)))
    return _done(df, out, _finite(F.col(lon), F.col(lat)), -_c("rho") * F.sin(_c("d")), -_c("rho") * F.cos(_c("d")))


def web_mercator(df: DataFrame, lon: str = "lon", lat: str = "lat", out: tuple[str, str] = ("x", "y")) -> DataFrame:
    x, y = WGS84_A * F.radians(lon), WGS84_A * F.log(F.tan(F.radians(lat) / 2 + math.pi / 4))
    return _done(df, out, _finite(F.col(lon), F.col(lat)), x, y)


#: UTM: scale on the central meridian, false easting and the false northing of the south.
UTM_K0, UTM_EAST, UTM_SOUTH = 0.9996, 500_000.0, 10_000_000.0


def utm_zone(lon: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(60), (F.floor((lon + 180) / 6) + 1).cast("int")))


def utm_to_lonlat(df: DataFrame, x: str, y: str, zone: Column, north: Column, out: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """Inverse transverse Mercator by the usual series in powers of the distance from the central meridian."""
    e2 = WGS84_F * (2 - WGS84_F)
    ep2, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (F.col(y) - F.when(north, 0.0).otherwise(UTM_SOUTH)) / UTM_K0 / (WGS84_A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    df = _step(df, mu=mu, mid=zone * 6.0 - 183)
    m = _c("mu")
    df = _step(df, p=m + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * m) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * m)
               + 151 * e1**3 / 96 * F.sin(6 * m) + 1097 * e1**4 / 512 * F.sin(8 * m))
    df = _step(df, sin=F.sin(_c("p")), cos=F.cos(_c("p")))
    df = _step(df, w=1 - e2 * _c("sin") * _c("sin"), t=_c("sin") * _c("sin") / (_c("cos") * _c("cos")), c=ep2 * _c("cos") * _c("cos"))
    df = _step(df, n=WGS84_A / F.sqrt(_c("w")))
    df = _step(df, d=(F.col(x) - UTM_EAST) / (_c("n") * UTM_K0), q=_c("w") / (1 - e2))
    d, t, c = _c("d"), _c("t"), _c("c")
    lat = _c("p") - _c("sin") / _c("cos") * _c("q") * (
        d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, F.lit(4.0)) / 24
        + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, F.lit(6.0)) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, F.lit(3.0)) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, F.lit(5.0)) / 120) / _c("cos")
    return _done(df, out, F.col(x).isNotNull() & F.col(y).isNotNull(), _c("mid") + F.degrees(lon), F.degrees(lat))


def _helmert_inverse() -> list[list[float]]:
    """The matrix that turns Bessel's geocentric axes back, exactly that of the forward shift."""
    rx, ry, rz = ROTATION
    m = [[1, rz, -ry], [-rz, 1, rx], [ry, -rx, 1]]
    minor = lambda i, j: [[m[a][b] for b in range(3) if b != j] for a in range(3) if a != i]
    det2 = lambda q: q[0][0] * q[1][1] - q[0][1] * q[1][0]
    det = sum((-1) ** j * m[0][j] * det2(minor(0, j)) for j in range(3))
    return [[(-1) ** (i + j) * det2(minor(j, i)) / det for j in range(3)] for i in range(3)]


#: Steps of the fixed point of Krovak's latitude; each gains a factor of some 300.
KROVAK_STEPS = 5


def krovak_to_lonlat(df: DataFrame, x: str = "x", y: str = "y", out: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """Degrees on WGS84 of Krovak's metres, the inverse of `krovak` at height 0; NULL where a coordinate is NULL or not
    finite. The height above Bessel's ellipsoid, which moves the place by millimetres, is found in a second pass."""
    e, sin0 = math.sqrt(KROVAK_E2), math.sin(LATITUDE)
    a = BESSEL_A * math.sqrt(1 - KROVAK_E2) / (1 - KROVAK_E2 * sin0**2)
    b = math.sqrt(1 + KROVAK_E2 * math.cos(LATITUDE) ** 4 / (1 - KROVAK_E2))
    t0 = math.tan(math.pi / 4 + math.asin(sin0 / b) / 2) * ((1 + e * sin0) / (1 - e * sin0)) ** (e * b / 2) / math.tan(math.pi / 4 + LATITUDE / 2) ** b
    n, r0 = math.sin(PARALLEL), K0 * a / math.tan(PARALLEL)
    east, north = F.col(x), F.col(y)
    df = _step(df, rho=F.sqrt(east * east + north * north), d=F.atan2(-east, -north) / n)
    df = _step(df, t=2 * (F.atan(F.pow(r0 / _c("rho"), F.lit(1 / n)) * math.tan(PARALLEL / 2 + math.pi / 4)) - math.pi / 4))
    df = _step(df, u=F.asin(math.cos(CONE) * F.sin(_c("t")) - math.sin(CONE) * F.cos(_c("t")) * F.cos(_c("d"))))
    df = _step(df, lam=LONGITUDE - F.asin(F.cos(_c("t")) * F.sin(_c("d")) / F.cos(_c("u"))) / b,
               k=F.pow(F.tan(_c("u") / 2 + math.pi / 4) / t0, F.lit(1 / b)), phi=_c("u"))
    for _ in range(KROVAK_STEPS):
        df = _step(df, es=e * F.sin(_c("phi")))
        df = _step(df, phi=2 * (F.atan(_c("k") * F.pow((1 + _c("es")) / (1 - _c("es")), F.lit(e / 2))) - math.pi / 4))
    bessel_e2, wgs_e2 = BESSEL_F * (2 - BESSEL_F), WGS84_F * (2 - WGS84_F)
    df = _step(df, sin=F.sin(_c("phi")), cos=F.cos(_c("phi")), h=F.lit(0.0))
    df = _step(df, nu=BESSEL_A / F.sqrt(1 - bessel_e2 * _c("sin") * _c("sin")))
    m, polar = _helmert_inverse(), WGS84_A * (1 - WGS84_F)
    for _ in range(2):
        geocentric = ((_c("nu") + _c("h")) * _c("cos") * F.cos(_c("lam")), (_c("nu") + _c("h")) * _c("cos") * F.sin(_c("lam")), (_c("nu") * (1 - bessel_e2) + _c("h")) * _c("sin"))
        df = _step(df, **dict(zip(("x1", "y1", "z1"), geocentric)))
        v = [_c("x1"), _c("y1"), _c("z1")]
        df = _step(df, **{k: (m[i][0] * v[0] + m[i][1] * v[1] + m[i][2] * v[2]) * (1 + SCALE) + SHIFT[i] for i, k in enumerate(("x0", "y0", "z0"))})
        df = _step(df, r=F.sqrt(_c("x0") * _c("x0") + _c("y0") * _c("y0")))
        df = _step(df, th=F.atan2(_c("z0") * WGS84_A, _c("r") * polar))
        df = _step(df, lat=F.atan2(_c("z0") + wgs_e2 / (1 - wgs_e2) * polar * F.pow(F.sin(_c("th")), F.lit(3.0)), _c("r") - wgs_e2 * WGS84_A * F.pow(F.cos(_c("th")), F.lit(3.0))))
        df = _step(df, h=_c("h") - (_c("r") / F.cos(_c("lat")) - WGS84_A / F.sqrt(1 - wgs_e2 * F.sin(_c("lat")) * F.sin(_c("lat")))))
    finite = F.abs(east + north) < float("inf")
    return _done(df, out, finite, F.degrees(F.atan2(_c("y0"), _c("x0"))), F.degrees(_c("lat")))


def web_mercator_to_lonlat(df: DataFrame, x: str = "x", y: str = "y", out: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    return _done(df, out, F.abs(F.col(x) + F.col(y)) < float("inf"), F.degrees(F.col(x) / WGS84_A), F.degrees(2 * F.atan(F.exp(F.col(y) / WGS84_A)) - math.pi / 2))


def utm(df: DataFrame, zone: int, north: bool, lon: str = "lon", lat: str = "lat", out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Transverse Mercator by the series in powers of the distance from the central meridian, millimetres within a zone."""
    e2 = WGS84_F * (2 - WGS84_F)
    ep2 = e2 / (1 - e2)
    df = _step(df, phi=F.radians(lat), sin=F.sin(F.radians(lat)), cos=F.cos(F.radians(lat)))
    phi = _c("phi")
    arc = WGS84_A * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - 35 * e2**3 / 3072 * F.sin(6 * phi))
    df = _step(df, m=arc, n=WGS84_A / F.sqrt(1 - e2 * _c("sin") * _c("sin")), t=_c("sin") * _c("sin") / (_c("cos") * _c("cos")), c=ep2 * _c("cos") * _c("cos"),
               a=F.radians(F.col(lon) - (zone * 6.0 - 183)) * _c("cos"))
    a, t, c = _c("a"), _c("t"), _c("c")
    df = _step(df, a2=a * a)
    a2 = _c("a2")
    east = UTM_K0 * _c("n") * a * (1 + a2 * ((1 - t + c) / 6 + a2 * (5 - 18 * t + t * t + 72 * c - 58 * ep2) / 120)) + UTM_EAST
    rest = a2 * (0.5 + a2 * ((5 - t + 9 * c + 4 * c * c) / 24 + a2 * (61 - 58 * t + t * t + 600 * c - 330 * ep2) / 720))
    up = UTM_K0 * (_c("m") + _c("n") * _c("sin") / _c("cos") * rest) + (0.0 if north else UTM_SOUTH)
    return _done(df, out, _finite(F.col(lon), F.col(lat)), east, up)


#: Projections from longitude and latitude, and back, by EPSG code; those of UTM are made from the code.
FORWARD = {5514: krovak, 3857: web_mercator}
BACK = {5514: krovak_to_lonlat, 3857: web_mercator_to_lonlat}


def _utm_of(epsg: int) -> tuple[int, bool] | None:
    zone = epsg % 100
    return (zone, epsg < 32700) if epsg // 100 in (326, 327) and 1 <= zone <= 60 else None


def _known(epsg: int) -> None:
    if epsg != 4326 and epsg not in FORWARD and _utm_of(epsg) is None:
        raise ValueError(f"EPSG:{epsg} is not known; known are 4326, {', '.join(map(str, FORWARD))}, 32601-32660 and 32701-32760")


def project(df: DataFrame, epsg: int, lon: str = "lon", lat: str = "lat", out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """From longitude and latitude on WGS84."""
    _known(epsg)
    if epsg == 4326:
        return df.withColumns({out[0]: F.col(lon), out[1]: F.col(lat)})
    if zone := _utm_of(epsg):
        return utm(df, *zone, lon, lat, out)
    return FORWARD[epsg](df, lon, lat, out)


def unproject(df: DataFrame, epsg: int, x: str = "x", y: str = "y", out: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """To longitude and latitude on WGS84."""
    _known(epsg)
    if epsg == 4326:
        return df.withColumns({out[0]: F.col(x), out[1]: F.col(y)})
    if zone := _utm_of(epsg):
        return utm_to_lonlat(df, x, y, F.lit(zone[0]), F.lit(zone[1]), out)
    return BACK[epsg](df, x, y, out)


def transform(df: DataFrame, source: int, target: int, x: str = "x", y: str = "y", out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Places from one system to another: every known system is one step from WGS84, so any two are two steps apart.
    East comes before north in all of them."""
    _known(source), _known(target)
    if source == target:
        return df.withColumns({out[0]: F.col(x), out[1]: F.col(y)})
    # the steps' columns have names that a user's table does not
    at = ("_lon_" + out[0], "_lat_" + out[1])
    return project(unproject(df, source, x, y, at), target, *at, out).drop(*at)
