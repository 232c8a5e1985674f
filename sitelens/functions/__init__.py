"""Column functions: each returns a native Spark ``Column`` expression, so they
stay inside whole-stage code generation and never call back into Python."""

from sitelens.functions.fmt import epoch_ms, epoch_ms_to_date, fmt_count, fmt_fixed, fmt_pct
from sitelens.functions.keys import normalise_key
from sitelens.functions.numeric import (
    NUMERIC_TEXT,
    coerce_numeric,
    nan_to_null,
    parts_sum,
    ratio_or_zero,
    residual,
)
from sitelens.functions.text import reading_time, slugify, snippet, word_count
from sitelens.functions.urls import (
    add_param,
    decode_categories,
    encode_categories,
    make_params,
    parse_params,
    query_string,
)

__all__ = [
    "NUMERIC_TEXT", "add_param", "coerce_numeric", "decode_categories",
    "encode_categories", "epoch_ms", "epoch_ms_to_date", "fmt_count", "fmt_fixed", "fmt_pct",
    "make_params", "nan_to_null", "normalise_key", "parse_params", "parts_sum",
    "query_string", "ratio_or_zero", "reading_time", "residual", "slugify", "snippet", "word_count",
]
