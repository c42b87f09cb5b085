from pricelens.functions.columns import (  # noqa: F401
    numeric_columns, string_columns, clip, log10_label, inverse_log10, key_hash, as_float32,
)
from pricelens.functions.joins import lookup_join, bounded_count  # noqa: F401
from pricelens.functions.quantiles import exact_quantiles, approx_quantiles  # noqa: F401
