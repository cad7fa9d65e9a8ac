from tierlake.functions.scores import (
    bin_of,
    is_malformed,
    is_nan,
    number,
    parse_score,
    positive,
    year_of,
)

__all__ = ["bin_of", "is_malformed", "is_nan", "number", "parse_score", "positive", "year_of"]
