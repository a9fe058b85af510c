from hopscope.functions.expressions import (
    DEFAULT_SAMPLE_SEED,
    INFINITY,
    KEY_SEPARATOR,
    NO_NEIGHBOURS,
    comma_tokens,
    finite_or_zero,
    infinity_to_null,
    next_hop,
    null_to_infinity,
    sample_key,
    strip_trailing,
    whitespace_tokens,
)

__all__ = [
    "DEFAULT_SAMPLE_SEED",
    "INFINITY",
    "KEY_SEPARATOR",
    "NO_NEIGHBOURS",
    "comma_tokens",
    "finite_or_zero",
    "infinity_to_null",
    "next_hop",
    "null_to_infinity",
    "sample_key",
    "strip_trailing",
    "whitespace_tokens",
]
