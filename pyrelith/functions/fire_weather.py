"""Fire-danger codes as column expressions: the published equations of the Canadian FWI system and of the KBDI.

One step takes yesterday's code and today's weather; series fold the steps (operators.fire_danger). Null weather gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(cond: Column, a, b) -> Column:
    return F.when(cond, a).otherwise(b)


# Equation 1 of the published FWI system (Van Wagner and Pickett, 1985), as are all below up to ``fwi``.
def moisture_of(code: Column) -> Column:
    """Fine-fuel moisture content (percent) that a code stands for."""
    return 147.2 * (101.0 - code) / (59.5 + code)


# Equations 2 to 10.
def ffmc_step(prev: Column, temp: Column, rh: Column, wind: Column, rain: Column) -> Column:
    rh = F.least(rh, F.lit(99.9999))
    m = moisture_of(prev)
    net = F.greatest(rain - 0.5, F.lit(1e-9))
    soak = 42.5 * net * F.exp(-100.0 / (251.0 - m)) * (1 - F.exp(-6.93 / net))
    extra = pick(m > 150, 0.0015 * F.pow(m - 150, 2) * F.sqrt(net), F.lit(0.0))
    m = F.least(pick(rain > 0.5, m + soak + extra, m), F.lit(250.0))
    shared = F.exp((rh - 100) / 10), 0.18 * (21.1 - temp) * (1 - F.exp(-0.115 * rh))
    dry_to = 0.942 * F.pow(rh, F.lit(0.679)) + 11 * shared[0] + shared[1]
    wet_to = 0.618 * F.pow(rh, F.lit(0.753)) + 10 * shared[0] + shared[1]

    def rate(h: Column) -> Column:
        k = 0.424 * (1 - F.pow(h, F.lit(1.7))) + 0.0694 * F.sqrt(wind) * (1 - F.pow(h, F.lit(8)))
        return F.pow(F.lit(10.0), -k * 0.581 * F.exp(0.0365 * temp))

    wetting = wet_to - (wet_to - m) * rate((100 - rh) / 100)
    drying = dry_to + (m - dry_to) * rate(rh / 100)
    # below both equilibria it gains moisture, above the drying one it loses some, between them it stays
    m = F.when((m < dry_to) & (m < wet_to), wetting).when(m > dry_to, drying).otherwise(m)
    return F.least(F.greatest(59.5 * (250 - m) / (147.2 + m), F.lit(0.0)), F.lit(101.0))


# Equations 11 to 17.
def dmc_step(prev: Column, temp: Column, rh: Column, rain: Column, day_length: float) -> Column:
    gain = 1.894e-4 * (F.greatest(temp, F.lit(-1.1)) + 1.1) * (100 - rh) * day_length
    p = F.greatest(prev, F.lit(1e-9))
    slope = F.when(p <= 33, 100 / (0.5 + 0.3 * p)).when(p <= 65, 14 - 1.3 * F.log(p)).otherwise(6.2 * F.log(p) - 17.2)
    net = F.greatest(0.92 * rain - 1.27, F.lit(0.0))
    moisture = 20 + 280 * F.exp(-0.023 * prev) + 1000 * net / (48.77 + slope * net)
    after = F.greatest(43.43 * (5.6348 - F.log(moisture - 20)), F.lit(0.0))
    return F.greatest(pick(rain > 1.5, after, prev) + gain, F.lit(0.0))


# Equations 18 to 23.
def dc_step(prev: Column, temp: Column, rain: Column, factor: float) -> Column:
    loss = F.greatest((0.36 * (F.greatest(temp, F.lit(-2.8)) + 2.8) + factor) / 2, F.lit(0.0))
    net = F.greatest(0.83 * rain - 1.27, F.lit(0.0))
    after = F.greatest(prev - 400 * F.log(1 + 3.937 * net / (800 * F.exp(-prev / 400))), F.lit(0.0))
    return F.greatest(pick(rain > 2.8, after, prev) + loss, F.lit(0.0))


# Equations 24 to 26.
def isi(ffmc: Column, wind: Column) -> Column:
    m = moisture_of(ffmc)
    return 0.208 * F.exp(0.05039 * wind) * 91.9 * F.exp(-0.1386 * m) * (1 + F.pow(m, F.lit(5.31)) / 4.93e7)


# Equations 27a and 27b.
def bui(dmc: Column, dc: Column) -> Column:
    u = F.coalesce(F.try_divide(0.8 * dc * dmc, dmc + 0.4 * dc), F.lit(0.0))
    less = dmc - (0.92 + F.pow(0.0114 * dmc, F.lit(1.7))) * F.coalesce(F.try_divide(dmc - u, dmc), F.lit(0.0))
    return pick(u < dmc, F.greatest(less, F.lit(0.0)), u)


# Equations 28 to 30.
def fwi(isi_: Column, bui_: Column) -> Column:
    d = pick(bui_ > 80, 1000 / (25 + 108.64 * F.exp(-0.023 * bui_)), 0.626 * F.pow(bui_, F.lit(0.809)) + 2)
    b = 0.1 * isi_ * d
    return pick(b > 1, F.exp(2.72 * F.pow(F.greatest(0.434 * F.log(F.greatest(b, F.lit(1.0))), F.lit(0.0)), F.lit(0.647))), b)


def net_rain(rain: Column, run: Column, interception: float) -> Column:
    """What of a day's rain passes the canopy, given the rain of its run of wet days up to and with it."""
    return F.greatest(run - interception, F.lit(0.0)) - F.greatest(run - rain - interception, F.lit(0.0))


# The published drought factor (Keetch and Byram, 1968) in millimetres and degrees Celsius.
def kbdi_step(prev: Column, t_max: Column, net: Column, yearly_rain: Column) -> Column:
    """Keetch-Byram deficit in mm, 0 to 203.2: net rain first, then drying."""
    q = F.greatest(prev - net, F.lit(0.0))
    dq = (203.2 - q) * (0.968 * F.exp(0.0875 * t_max + 1.5552) - 8.30) / (1 + 10.88 * F.exp(-0.001736 * yearly_rain)) * 1e-3
    return F.least(q + F.greatest(dq, F.lit(0.0)), F.lit(203.2))
