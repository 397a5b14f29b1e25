from .columns import (
    action_display_class,
    currency_text,
    is_priced,
    percent_text,
    round_sig,
    round_to_long,
    safe_ratio,
    ticker_code,
)

__all__ = [
    "action_display_class",
    "currency_text",
    "is_priced",
    "percent_text",
    "round_sig",
    "round_to_long",
    "safe_ratio",
    "ticker_code",
]
