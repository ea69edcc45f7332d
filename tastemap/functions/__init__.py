from tastemap.functions.exprs import (  # noqa: F401
    clip,
    dot,
    hash_key,
    hash_number,
    log_discount,
    round_score,
    array_norm,
)
