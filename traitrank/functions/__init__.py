"""Column expressions; all of them run inside the JVM."""

from traitrank.functions.json_values import (
    exact_text_or_null,
    first_truthy,
    has_wide_number,
    is_truthy,
    python_float_text,
    stringify_or_null,
    variant_at,
)
from traitrank.functions.scoring import collection_label, fallback_text, odds_score
from traitrank.functions.token_ids import hex_to_decimal, numeric_order, parse_token_id

__all__ = [
    "collection_label",
    "fallback_text",
    "exact_text_or_null",
    "first_truthy",
    "has_wide_number",
    "hex_to_decimal",
    "is_truthy",
    "numeric_order",
    "odds_score",
    "parse_token_id",
    "python_float_text",
    "stringify_or_null",
    "variant_at",
]
