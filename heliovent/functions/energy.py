"""Wind and solar potential of one observation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heliovent.functions.rounding import round_cents

# Fixed values of the index definitions.
DEFAULT_UV = 5.0  # average daylight, where no UV was measured
WIND_SCALE = 100.0
WIND_EXPONENT = 3.0


def wind_index(speed: Column) -> Column:
    """Cube of the wind speed, scaled; no measured wind counts as calm."""
    calm = F.coalesce(speed, F.lit(0.0))
    return round_cents(F.pow(calm, F.lit(WIND_EXPONENT)) / F.lit(WIND_SCALE))


def cloud_factor(clouds: Column) -> Column:
    """Share of light passing the clouds; unknown cover counts as clear sky."""
    return F.lit(1.0) - F.coalesce(clouds, F.lit(0.0)) / F.lit(100.0)


def solar_index(uv: Column, clouds: Column) -> Column:
    return round_cents(F.coalesce(uv, F.lit(DEFAULT_UV)) * cloud_factor(clouds))
