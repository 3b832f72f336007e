"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from shroud.functions.columns import (  # noqa: F401
    EXACT, FLOAT_PATTERN, INT_PATTERN, canonical_int, col_of, concat_key, is_missing,
    missing_flag, r6, to_double, to_int, weight_col,
)
from shroud.functions.entropy import entropy_agg  # noqa: F401
from shroud.functions.joins import attach, sized_broadcast  # noqa: F401
