"""Scalar Column expressions (see ``exprs``)."""

from loanlife.functions.exprs import (  # noqa: F401
    accrued_interest, as_money, as_number, idiv, is_blank, month_diff, month_index,
    ne_null_safe, nonzero, nullsum, quarter_label, rate_fallback, transition_label,
    vintage, waterfall,
)
