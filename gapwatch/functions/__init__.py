from gapwatch.functions.bitmaps import bits_of, block_of, inner_gap_lengths
from gapwatch.functions.payload import leaf_fields, payload_json
from gapwatch.functions.quantiles import exact_quantiles, ranked_values
from gapwatch.functions.ranking import top_ranked, with_share_and_rank
from gapwatch.functions.times import from_micros, micros, parse_utc, start_of_hour

__all__ = [
    "bits_of", "block_of", "inner_gap_lengths", "leaf_fields", "payload_json", "exact_quantiles", "ranked_values",
    "top_ranked", "with_share_and_rank", "from_micros", "micros", "parse_utc", "start_of_hour",
]
