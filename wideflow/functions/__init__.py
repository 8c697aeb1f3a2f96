"""Column-expression helpers (all JVM built-ins)."""
from .text import (is_blank, is_blank_or_no, not_blank, jtrim, fill_minus_one,
                   fill_null_word, nonblank_or_null, md5_hex, token32, FILLS)
from .keys import (base32, digits_to_long, packed_digits, packed_invoice_no,
                   year_part, header_row_key, detail_row_key, with_packed_invoice_no,
                   with_year_part)
