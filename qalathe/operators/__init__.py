"""Table operators shared by the plans."""

from .lookup import first_per_key, last_per_key, unique_lookup_join  # noqa: F401
from .ordering import best_first, duplicate_flags, duplicate_summary, most_frequent, value_counts  # noqa: F401
from .quantiles import column_quantiles, exact_quantiles  # noqa: F401
from .rows import beside, literal_rows  # noqa: F401
