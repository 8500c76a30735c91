"""Source-strength expressions for river and sewage sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def river_strength(base, kind, flow_dep, tide_dep, flow: Column, tide: Column, temp: Column) -> Column:
    """Base emission scaled by flow, tide, temperature and bridge exposure; at most 50."""
    x = base * F.when(flow_dep, F.least(F.lit(2.0), flow / 50.0)).otherwise(1.0)
    x = x * F.when(tide_dep, F.lit(1.5) - tide * 0.5).otherwise(1.0)
    warm = (temp - 20.0) * 0.02 + 1.0
    x = x * F.greatest(F.lit(0.5), F.least(F.lit(1.5), warm))
    return F.least(F.lit(50.0), x * F.when(kind == "bridge", 1.3).otherwise(1.0))


# fixed values: sulfide kinetics (rate constant, activation energy, gas constant,
# reference kelvin, optimal pH, oxygen scale, base production)
K0, ACTIVATION, GAS, T_REF, PH_OPT, DO_SCALE, BASE = 0.015, 60000.0, 8.314, 293.15, 7.2, 0.5, 50.0


def sulfide_production(flow, temp_c, ph, oxygen, tide, lat, lon) -> Column:
    """Noise-free production rate in ppb."""
    arrhenius = F.exp((F.lit(1.0) / (temp_c + 273.15) - 1.0 / T_REF) * (-ACTIVATION / GAS)) * K0
    dph = (ph - PH_OPT) / 1.5
    x = (
        arrhenius * BASE * F.exp(dph * dph * -0.5) * F.exp(oxygen / -DO_SCALE)
        * (F.exp(tide / -0.5) * 0.5 + 1.0) / (flow / 100.0 + 1.0)
    )
    place = (
        F.when((lat > 32.53) & (lat < 32.55) & (lon > -117.13) & (lon < -117.11), 1.5)
        .when((lat > 32.52) & (lat < 32.54) & (lon > -117.15) & (lon < -117.14), 1.3)
        .otherwise(1.0)
    )
    return F.greatest(x * place, F.lit(0.0))
