from modelloom.functions.columns import (
    as_text,
    bucketize,
    cents_rounded,
    cents_truncated,
    default_if_falsy,
    empty_like,
    fill_template,
    flag,
    free_name,
    json_fields,
)

__all__ = [
    "as_text", "bucketize", "cents_rounded", "cents_truncated", "default_if_falsy",
    "empty_like", "fill_template", "flag", "free_name", "json_fields",
]
