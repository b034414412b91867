"""Per-pixel column functions: brightness temperature, geostationary navigation, spectral indices, masks, reclassification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class codes of the public land-cover maps, to fuel classes 1 forest, 2 shrub regrowth, 3 shrub, 4 grass, 5 crop, 6 no fuel.
WORLDCOVER_FUEL = {10: 1, 20: 3, 30: 4, 40: 5}
DYNAMIC_FUEL = {1: 1, 5: 3, 2: 4, 4: 5}
REGROWTH = (3, 4)


@dataclass(frozen=True)
class Calibration:
    """What an image file says of its counts."""

    gain: float = -0.0037
    offset: float = 15.2
    wavelength_um: float = 10.4
    c0: float = -0.1
    c1: float = 1.0
    c2: float = 0.0
    error: int = 65_535
    outside: int = 65_534
    light: float = 2.99792458e8
    planck: float = 6.62606957e-34
    boltzmann: float = 1.3806488e-23


def brightness_temperature(count: Column, k: Calibration = Calibration()) -> Column:
    """Radiance by the file's gain, the inverse of Planck's law, then the file's correction; null for invalid counts."""
    wl = k.wavelength_um * 1e-6
    radiance = k.gain * count + k.offset
    usable = ~count.isin(k.error, k.outside) & (radiance > 0)
    te = (k.planck * k.light / (k.boltzmann * wl)) / F.log(2.0 * k.planck * k.light**2 / (F.when(usable, radiance) * 1e6 * wl**5) + 1.0)
    return k.c0 + k.c1 * te + k.c2 * te * te


@dataclass(frozen=True)
class Navigation:
    """Normalised geostationary projection."""

    sub_lon: float = 140.7
    cfac: float = 20_466_275.0
    coff: float = 2750.5
    distance: float = 42_164.0
    equator: float = 6378.137
    pole: float = 6356.7523


def pixel_lonlat(line: Column, col: Column, n: Navigation = Navigation()) -> tuple[Column, Column]:
    """Where the view ray of a pixel meets the ellipsoid; null where it misses the Earth."""
    ax, ay = F.radians((col - n.coff) * 65_536.0 / n.cfac), F.radians((line - n.coff) * 65_536.0 / n.cfac)
    east, south, down = F.sin(ax), F.sin(ay), F.cos(ax) * F.cos(ay)
    # in the frame of the satellite's meridian: x out of the Earth, y east, z north
    x0, flat = n.distance, (n.equator / n.pole) ** 2
    a = down * down + east * east + flat * south * south
    half = x0 * down
    disc = half * half - a * (x0 * x0 - n.equator * n.equator)
    t = (half - F.sqrt(F.when(disc >= 0, disc))) / a
    x, y, z = x0 - t * down, t * east, -t * south
    return F.degrees(F.atan2(y, x)) + n.sub_lon, F.degrees(F.atan2(z * flat, F.hypot(x, y)))


def ratio(a: Column, b: Column) -> Column:
    """I8: normalised difference, null where the sum is zero."""
    return F.try_divide(a - b, a + b)


def burn_indices(b: dict[str, Column]) -> dict[str, Column]:
    """Seven indices, high where burned; null where they aren't defined."""
    b12, b8a = b["b12"], b["b8a"]
    return {
        "nbr": ratio(b12, b8a),
        "nbrswir": F.try_divide(b12 - b["b11"] - 0.02, b12 + b["b11"] + 0.1),
        "ndswir": ratio(b["b11"], b8a),
        "mirbi": 10 * b12 - 9.8 * b["b11"] + 2,
        "bais2": (1 - F.sqrt(F.try_divide(b["b6"] * b["b7"] * b8a, b["b4"]))) * (F.try_divide(b12 - b8a, F.sqrt(b12 + b8a)) + 1),
        "nbr_plus": F.try_divide(b12 - b8a - b["b3"] - b["b2"], b12 + b8a + b["b3"] + b["b2"]),
        "atbi": F.when(b8a > 0, ratio(b12, b8a) * F.try_divide(b12, b8a)),
    }


def clear_sky(scl: Column, snow: bool = False) -> Column:
    """Scene classes that show the ground (and dark ones, if asked)."""
    return scl.isin(4, 5, 6, 7, *((2,) if snow else ()))


def state_clear(qa: Column) -> Column:
    """The two lowest bits are the cloud state."""
    return qa.bitwiseAND(3) == 0


def reclassify(code: Column, table: dict[int, int], other: int = 6) -> Column:
    """Class codes by a table, all others to one class; masked stays masked."""
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(code == k, v).otherwise(out)
    return F.when(code.isNotNull(), out)


def worldcover_fuel(wc: Column, tmf: Column) -> Column:
    """Tree cover that another map has as regrowth is shrub regrowth."""
    return F.when((wc == 10) & tmf.isin(*REGROWTH), 2).otherwise(reclassify(wc, WORLDCOVER_FUEL))


def dynamic_fuel(dw: Column, tmf: Column) -> Column:
    return F.when((dw == 1) & tmf.isin(*REGROWTH), 2).otherwise(reclassify(dw, DYNAMIC_FUEL))


def judgement_flags(wc: Column, tmf: Column) -> dict[str, Column]:
    """Calls that could go another way, as flags."""
    return {"degraded": (wc == 10) & (tmf == 2), "unresolved": (wc == 10) & tmf.isin(0, 5, 6), "wetland": wc == 90}
