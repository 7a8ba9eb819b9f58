from shelfmark.functions.columns import (
    currency_label,
    date_label,
    days_on_market,
    extract_attribute,
    no_match_is_null,
    product_url,
    variant_price,
    weekday_name,
    zone_local_date,
)

__all__ = [
    "currency_label",
    "date_label",
    "days_on_market",
    "extract_attribute",
    "no_match_is_null",
    "product_url",
    "variant_price",
    "weekday_name",
    "zone_local_date",
]
