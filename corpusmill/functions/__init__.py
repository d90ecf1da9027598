from corpusmill.functions.keys import order_key, text_hash
from corpusmill.functions.text import WHITESPACE, in_length_band, strip_ws

__all__ = ["WHITESPACE", "in_length_band", "order_key", "strip_ws", "text_hash"]
