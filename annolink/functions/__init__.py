"""Column -> Column building blocks (all built-in Spark expressions)."""

from annolink.functions.text import (  # noqa: F401
    java_trim, utf16_length, comma_list, pad_right_keep, page_name, page_label,
    starts_with_brace, split_terms,
)
from annolink.functions.time import epoch_ms_to_iso  # noqa: F401
from annolink.functions.keys import long_to_key_bytes, key_bytes_to_long  # noqa: F401
