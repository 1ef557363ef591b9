"""Column functions: text, dates, codes, rounding policies and geography."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_KM = 6371.0088


def slug(c: Column) -> Column:
    """Small letters and digits with single hyphens; if nothing is left, the first 8 characters of the MD5."""
    s = F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(s == "", F.substring(F.md5(c), 1, 8)).otherwise(s)


def camel_split(c: Column) -> Column:
    return F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")


def before_bracket(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, "^([^(（]*)", 1))


@F.pandas_udf(T.StringType())
def normal_name(s: pd.Series) -> pd.Series:
    """NFKD, ASCII, small letters a-z only."""
    return s.map(lambda v: None if v is None else re.sub("[^a-z]", "", unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()))


def fuzzy_date(c: Column, end: bool = False) -> Column:
    """`~1897`, `1897-05`, `1897-05-02`: missing parts are the first ones, or for an end the last ones."""
    y, m, d = (F.nullif(F.regexp_extract(c, r"(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?", i), F.lit("")).cast("int") for i in (1, 2, 3))
    month = F.coalesce(m, F.lit(12 if end else 1))
    first = F.make_date(y, month, F.coalesce(d, F.lit(1)))
    return F.when(d.isNull() & F.lit(end), F.last_day(first)).otherwise(first)


def flags(letters: Column, values: dict[str, int]) -> Column:
    """Sum of the bits whose letter occurs."""
    out = F.lit(0)
    for letter, bit in values.items():
        out = out + F.when(F.contains(letters, F.lit(letter)), F.lit(bit)).otherwise(F.lit(0))
    return out


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cell_km2(row: Column, degrees: float) -> Column:
    """Area of a cell of a regular grid whose row 0 is the northernmost."""
    north = 90 - row * degrees
    return F.lit(EARTH_KM**2) * F.radians(F.lit(degrees)) * (F.sin(F.radians(north)) - F.sin(F.radians(north - degrees)))


def zigzag(c: Column) -> Column:
    return F.shiftleft(c, 1).bitwiseXOR(F.shiftright(c, 63))


def share(part: Column, total: Column) -> Column:
    """Null where the total is null or zero."""
    return F.when(total != 0, part / total)


def role(roles: Column, code: str) -> Column:
    """`c1 c2=name;*=other`: the name of the first part whose codes hold the code or are *; null if none does."""
    parts = F.filter(F.split(F.coalesce(roles, F.lit("")), ";"), lambda p: F.contains(p, F.lit("=")))
    codes = lambda p: F.trim(F.split_part(p, F.lit("="), F.lit(1)))
    fits = F.filter(parts, lambda p: (codes(p) == "*") | F.array_contains(F.split(codes(p), r"\s+"), code))
    return F.trim(F.regexp_extract(F.get(fits, F.lit(0)), "(?s)^[^=]*=(.*)$", 1))


def holds(test: str, text: str, detail: Column) -> Column:
    """contains, startswith or lacks; false for a null or empty detail."""
    found = {"contains": F.contains(detail, F.lit(text)), "startswith": F.startswith(detail, F.lit(text)), "lacks": ~F.contains(detail, F.lit(text))}[test]
    return F.coalesce((detail != "") & found, F.lit(False))


def compact(name: str, c: Column, whole: frozenset[str] = frozenset()) -> Column:
    """Rounded as documents want it: the columns named as whole to integers (half to even), shares to 7 places, others to 3;
    NaN is null."""
    c = F.nanvl(c, F.lit(None).cast("double"))
    return F.bround(c, 0).cast("long") if name in whole else F.bround(c, 7 if "share" in name else 3)


def lighten(colour: Column, t: float) -> Column:
    """A #rrggbb colour, t of the way to white."""
    part = lambda i: F.conv(F.substring(colour, i, 2), 16, 10).cast("double")
    return F.lower(F.concat(F.lit("#"), *[F.lpad(F.hex(F.bround(part(i) + (255 - part(i)) * t, 0).cast("long")), 2, "0") for i in (2, 4, 6)]))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Web Mercator in fractions of the map, from its north-west corner."""
    phi = F.radians(lat)
    return (lon + 180) / 360, (1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / F.lit(3.141592653589793)) / 2


def unmercator(x: Column, y: Column) -> tuple[Column, Column]:
    return x * 360 - 180, F.degrees(F.atan(F.sinh(F.lit(3.141592653589793) * (1 - 2 * y))))


def snapshot_date(year: Column) -> Column:
    """1 July of a year."""
    return F.make_date(year, F.lit(7), F.lit(1))


def int_date(yyyymmdd: Column) -> Column:
    """An integer like 19390901 as ISO text; null where it isn't a date."""
    return F.date_format(F.try_to_timestamp(yyyymmdd.cast("string"), F.lit("yyyyMMdd")), "yyyy-MM-dd")


def planar_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance on a plane that is true at the second place."""
    return F.hypot((lon1 - lon2) * 111.32 * F.cos(F.radians(lat2)), (lat1 - lat2) * 110.57)


def planar_km2(square_degrees: Column, lat: Column) -> Column:
    return square_degrees * 111.32 * 111.32 * F.cos(F.radians(lat))


def lambert(lon: Column, lat: Column, n: float, lon0: float = 5.0) -> tuple[Column, Column]:
    """Lambert conformal conic on the unit sphere: x east and y north of the pole."""
    rho = 1 / F.pow(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2), F.lit(n))
    turn = F.radians(lon - lon0) * n
    return rho * F.sin(turn), -rho * F.cos(turn)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def pair_key(a: Column, b: Column) -> Column:
    """One number for two ids below 4096, whichever comes first."""
    return F.least(a, b) * 4096 + F.greatest(a, b)


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _imul(a: Column, b: Column) -> Column:
    """The low 32 bits of a product of 32-bit numbers, by 16-bit halves so that no 64-bit product overflows."""
    return _low32(a * b.bitwiseAND(F.lit(0xFFFF)) + F.shiftleft(_low32(a * F.shiftright(b, 16)).bitwiseAND(F.lit(0xFFFF)), 16))


def random_step(seed: Column) -> tuple[Column, Column]:
    """The next state of a 32-bit generator, and its number in [0, 1). The increment and the shifts."""
    state = _low32(seed.cast("long") + F.lit(0x6D2B79F5))
    t = _imul(state.bitwiseXOR(F.shiftright(state, 15)), state.bitwiseOR(F.lit(1)))
    t = t.bitwiseXOR(_low32(t + _imul(t.bitwiseXOR(F.shiftright(t, 7)), t.bitwiseOR(F.lit(61)))))
    return state, t.bitwiseXOR(F.shiftright(t, 14)) / F.lit(4294967296.0)


def only_cjk(name: Column) -> Column:
    """The trimmed name if it holds unified ideographs alone, else null."""
    name = F.trim(name)
    return F.when(name.rlike(r"^[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{20000}-\x{323AF}]+$"), name)


def byte_sum(data: Column) -> Column:
    """Sum of the bytes modulo 2**32."""
    pairs = F.regexp_extract_all(F.hex(data), F.lit("(..)"), F.lit(1))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda n, x: _low32(n + F.conv(x, 16, 10).cast("long")))


def fold(code: Column, named: dict[str, str], fallback: Column, missing: str = "-99") -> Column:
    """A code by a table of foldings; the fallback, folded too, where the code is missing or null."""
    table = F.create_map(*[F.lit(x) for kv in named.items() for x in kv])
    code = F.when(code.isNull() | (code == missing), fallback).otherwise(code)
    return F.coalesce(F.try_element_at(table, code), code)


def ramp(c: Column, stops: list[tuple[float, float]]) -> Column:
    """Linear between the stops (at, value), level beyond them."""
    out = F.when(c <= stops[0][0], F.lit(float(stops[0][1])))
    for (a, u), (b, v) in zip(stops, stops[1:], strict=False):
        out = out.when(c <= b, F.lit(float(u)) + (c - a) * F.lit((v - u) / (b - a)))
    return F.when(c.isNotNull(), out.otherwise(F.lit(float(stops[-1][1]))))


def hash_colour(key: Column) -> Column:
    """A steady #rrggbb colour of a key: hue, lightness and saturation from its MD5."""
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    hue, light, sat = h % 360 / F.lit(360.0), 0.55 + F.shiftright(h, 9) % 12 / F.lit(100.0), 0.35 + F.shiftright(h, 13) % 20 / F.lit(100.0)
    top = light + sat - light * sat
    low = 2 * light - top

    def channel(shift: float) -> Column:
        t = F.pmod(hue + shift, F.lit(1.0))
        v = F.when(t < 1 / 6, low + (top - low) * 6 * t).when(t < 0.5, top).when(t < 2 / 3, low + (top - low) * (2 / 3 - t) * 6).otherwise(low)
        return F.lpad(F.lower(F.hex(F.bround(v * 255, 0).cast("long"))), 2, "0")

    return F.concat(F.lit("#"), channel(1 / 3), channel(0.0), channel(-1 / 3))


def round_points(points: Column, places: int) -> Column:
    """Coordinates rounded inside an array of [x, y]."""
    return F.transform(points, lambda p: F.transform(p, lambda v: F.round(v, places)))
