"""Column expressions and exact statistics helpers."""

from .columns import (  # noqa: F401
    concentration_band,
    counter_hash,
    floor_days,
    mean_of,
    minmax,
    pop_std,
    risk_band,
    safe_ratio,
    sample_std,
    standard_normal,
    uniform_closed_open,
    week_sunday,
)
from .quantiles import exact_quantiles, exact_quantiles_many  # noqa: F401
