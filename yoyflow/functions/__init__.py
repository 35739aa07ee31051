"""Column-level helpers (no UDFs: every helper returns a native Column)."""

from yoyflow.functions.keys import (
    decode_client,
    decode_code,
    encode_key,
    key_length,
    year_suffix,
)
from yoyflow.functions.rules import Rule, classify, classify_with_id
from yoyflow.functions.text import (
    concat_null,
    eq_ci,
    eq_ci_cols,
    isin_ci,
    like_ci,
    ne_ci_cols,
    norm,
    not_isin_ci,
    not_like_ci,
)

__all__ = [
    "Rule",
    "classify",
    "classify_with_id",
    "concat_null",
    "decode_client",
    "decode_code",
    "encode_key",
    "eq_ci",
    "eq_ci_cols",
    "isin_ci",
    "key_length",
    "like_ci",
    "ne_ci_cols",
    "norm",
    "not_isin_ci",
    "not_like_ci",
    "year_suffix",
]
