"""Scalar column functions: identifiers, times, calendars, angles, planes, grids, token and sentinel parsing."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

M_PER_DEG = 111_320.0
EARTH_M = 6_371_008.8
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def stable_id(satellite, instrument, acq_date, acq_time, lat, lon) -> Column:
    """H1: SHA-1 of the six key fields joined by a pipe, coordinates with five decimals."""
    return F.sha1(F.format_string("%s|%s|%s|%s|%.5f|%.5f", satellite, instrument, acq_date, acq_time, lat, lon))


def acquisition_time(acq_date, acq_time) -> Column:
    """H2: a date and a time of day without leading zeros to an instant; null where either is malformed."""
    return F.try_to_timestamp(F.concat(F.col(acq_date), F.lit(" "), F.lpad(F.col(acq_time), 4, "0")), F.lit("yyyy-MM-dd HHmm"))


def local_day(ts, offset_hours: int = 9) -> Column:
    """H3: the calendar day at a fixed offset from UTC."""
    return F.to_date(F.col(ts) + F.expr(f"INTERVAL '{offset_hours}' HOUR"))


def day_close(day, hour: int = 15) -> Column:
    """H4: the UTC instant at which a local day is over."""
    return F.col(day).cast("timestamp_ntz") + F.expr(f"INTERVAL '{hour}' HOUR")


def circle_day(day) -> Column:
    """H5: day of the year on a circle of 365; 29 February has the number of the 28th and later days don't shift."""
    y = F.year(day)
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.dayofyear(day) - F.when(leap & (F.dayofyear(day) >= 60), 1).otherwise(0)


def circle_distance(a: Column, b: Column, n: int = 365) -> Column:
    """Days between two places on the circle."""
    d = F.abs(a - b)
    return F.least(d, n - d)


def month_start(day) -> Column:
    """H6 (with next_month, previous_month, month_end below)."""
    return F.to_date(F.date_trunc("month", day))


def next_month(day) -> Column:
    return F.add_months(month_start(day), 1)


def previous_month(day) -> Column:
    return F.add_months(month_start(day), -1)


def month_end(day) -> Column:
    return F.last_day(day)


def floor_slot(ts, minutes: int = 10) -> Column:
    """H7: the slot that an instant falls in, as epoch seconds."""
    s = F.unix_seconds(F.col(ts).cast("timestamp"))
    return s - s % (60 * minutes)


def slot_range(first: Column, last: Column, minutes: int) -> Column:
    """H7: slots (epoch seconds) from the first to the last, both included; none if they are reversed."""
    return F.when(first <= last, F.sequence(first, last, F.lit(60 * minutes).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def local_day_slots(day, minutes: int = 10, offset_hours: int = 9) -> Column:
    """H8: the slots of a true local day, midnight to midnight there."""
    start = F.unix_seconds(F.col(day).cast("timestamp")) - 3600 * offset_hours
    return F.sequence(start, start + 86_400 - 60 * minutes, F.lit(60 * minutes).cast("long"))


def look_windows(first_seen, last_seen, pre_days: int, post_days: int) -> tuple[Column, Column, Column, Column]:
    """H9: (pre from, pre to, post from, post to), ends excluded: before is over when the first day begins, after begins the day after the last."""
    a, b = F.to_date(first_seen), F.to_date(last_seen)
    return F.date_sub(a, pre_days), a, F.date_add(b, 1), F.date_add(b, 1 + post_days)


def rain_window(day, offset_hours: int = 9) -> tuple[Column, Column]:
    """First and last of the 24 hour-ending stamps of the rain day that ends at local noon."""
    noon = F.unix_seconds(F.col(day).cast("timestamp")) + 3600 * (12 - offset_hours)
    return noon - 23 * 3600, noon


def prior_map_year(day, latest: int) -> tuple[Column, Column, Column]:
    """Annual map of the year before; that or the latest one; the largest loss code that counts as before."""
    y = F.year(day)
    return y - 1, F.least(y - 1, F.lit(latest)), y - 2001


def lagged_dates(ts, lag_days: Column, offset_hours: int = 9) -> tuple[Column, Column]:
    """UTC and local date of an instant minus a lag in (fractions of) days."""
    s = F.unix_seconds(F.col(ts).cast("timestamp")) - F.round(lag_days * 86_400).cast("long")
    return F.to_date(F.timestamp_seconds(s)), F.to_date(F.timestamp_seconds(s + 3600 * offset_hours))


def has_token(text, token: str) -> Column:
    """A whole space-separated token; null and ``M`` have none."""
    return F.array_contains(F.split(F.coalesce(F.col(text), F.lit("M")), " +"), token)


def measured(text) -> Column:
    """A number, null for the missing sentinel and anything else that is none."""
    return F.expr(f"try_cast(`{text}` AS DOUBLE)")


def at_ceiling(value: Column, ceiling: float = 6.21) -> Column:
    """A reading at the sensor's limit is censored."""
    return F.abs(value - ceiling) < 1e-6


def known_direction(drct: Column, sknt: Column) -> Column:
    """A direction, null when calm or variable."""
    return F.when(drct.isNotNull() & (sknt > 0), drct)


def angle_between(a: Column, b: Column) -> Column:
    """Smallest absolute difference in degrees."""
    d = F.pmod(a - b, F.lit(360.0))
    return F.least(d, 360.0 - d)


def wind_from(drct: Column, sknt: Column, bearing: Column, half_width: float) -> Column:
    """The wind comes from a bearing, within a sector; false when calm, variable or unknown."""
    return F.coalesce((sknt > 0) & (angle_between(drct, bearing) <= half_width), F.lit(False))


def plane(lat: Column, lon: Column, mean_lat: Column) -> tuple[Column, Column]:
    """Metres east and north on one plane for a whole set."""
    return lon * (F.cos(F.radians(mean_lat)) * M_PER_DEG), lat * M_PER_DEG


def distance_bearing(lat: Column, lon: Column, lat0: float, lon0: float, mean_lat: Column) -> tuple[Column, Column]:
    """Kilometres and compass bearing from a fixed place, on the plane of the set."""
    dx = (lon - lon0) * M_PER_DEG * F.cos(F.radians(mean_lat))
    dy = (lat - lat0) * M_PER_DEG
    return F.hypot(dx, dy) / 1000.0, F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def flat_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a local plane around the first point."""
    k = math.pi / 180 * EARTH_M
    return F.hypot((lon2 - lon1) * k * F.cos(F.radians(lat1)), (lat2 - lat1) * k)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def initial_bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle bearing in degrees."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def compass(bearing: Column) -> Column:
    """One of eight names."""
    at = F.floor(F.pmod(bearing + 22.5, F.lit(360.0)) / 45).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in COMPASS]), at)


def grid_cell(lat: Column, lon: Column, bbox: tuple[float, float, float, float], cell_m: float) -> tuple[Column, Column, int, int]:
    """Column and row on a metric grid anchored at the south-west corner, the far edges in the last cell; and the grid's size."""
    w, s, e, n = bbox
    kx = M_PER_DEG * math.cos(math.radians((s + n) / 2))
    nx, ny = max(1, math.ceil((e - w) * kx / cell_m)), max(1, math.ceil((n - s) * M_PER_DEG / cell_m))

    def index(v: Column, size: int) -> Column:
        return F.least(F.greatest(F.floor(v), F.lit(0)), F.lit(size - 1)).cast("int")

    return index((lon - w) * (kx / cell_m), nx), index((lat - s) * (M_PER_DEG / cell_m), ny), nx, ny


def box_km2(w: Column, s: Column, e: Column, n: Column) -> Column:
    """Area of a box of degrees."""
    return (e - w) * 111.320 * F.cos(F.radians((s + n) / 2)) * (n - s) * 110.574


def relative_humidity(t: Column, dew: Column) -> Column:
    """Magnus formula, percent, at most 100; null if either is."""
    def vapour(x):
        return F.exp(17.625 * x / (243.04 + x))

    return F.when(t.isNotNull() & dew.isNotNull(), F.least(100 * vapour(dew) / vapour(t), F.lit(100.0)))


def distance_band(m: Column) -> Column:
    """Bands of a distance to a box, upper ends included; null stays null."""
    return F.when(m <= 0, "inside").when(m <= 375, "within 375 m").when(m <= 750, "within 750 m").when(m <= 1500, "within 1500 m").when(m.isNotNull(), "beyond 1500 m")


def look_direction(d: Column, pre: Column, first: Column) -> Column:
    """Where a prior day lies between a look before and the first day; strict on both sides."""
    return F.when((d < pre) & (pre < first), "scar in pre").when((pre < d) & (d < first), "earlier burn included").otherwise("no prior detection")


def area_bounds(changed: Column, clear: Column, whole: Column, quantile: float) -> tuple[Column, Column, Column]:
    """Area expected by chance, upper bound with what was hidden, clear share (null without area)."""
    return (1 - quantile) * clear, changed + whole - clear, F.try_divide(clear, whole)


def bit_field(q: Column, mask: int, shift: int) -> Column:
    """H29."""
    return F.shiftright(q.bitwiseAND(mask), shift)


def mercator_tile(lat: Column, lon: Column, zoom: int, clamp: bool = True) -> tuple[Column, Column, Column]:
    """Column and row of a web tile, clamped to the map, and its row counted from the south. Without ``clamp``, what lies beyond the map keeps the number that the formula gives."""
    n = 1 << zoom
    y = F.radians(F.greatest(F.least(lat, F.lit(85.05112878)), F.lit(-85.05112878)) if clamp else lat)
    x = F.floor((lon + 180) / 360 * n)
    row = F.floor((1 - F.log(F.tan(y) + 1 / F.cos(y)) / math.pi) / 2 * n)

    def inside(v):
        return (F.least(F.greatest(v, F.lit(0)), F.lit(n - 1)) if clamp else v).cast("int")

    return inside(x), inside(row), (n - 1) - inside(row)


def scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Metrics that are null where their denominator is empty."""
    p, r, s = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    return {"precision": p, "recall": r, "f1": F.try_divide(2 * p * r, p + r), "balanced_accuracy": (r + s) / 2}


def stretch(v: Column, low: Column, high: Column) -> Column:
    """To 0-255 between two limits; null on an empty range."""
    return F.round(F.least(F.greatest(F.try_divide(v - low, high - low), F.lit(0.0)), F.lit(1.0)) * 255)


def thousands(v: Column) -> Column:
    """H36."""
    return F.format_number(v, 0)
