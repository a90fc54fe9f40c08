from medallion.functions.keys import attribute_hash, business_key
from medallion.functions.connect_decimal import decode_connect_decimal, encode_connect_decimal
from medallion.functions.ordering import EVENT_ORDER, event_order

__all__ = [
    "attribute_hash",
    "business_key",
    "decode_connect_decimal",
    "encode_connect_decimal",
    "EVENT_ORDER",
    "event_order",
]
