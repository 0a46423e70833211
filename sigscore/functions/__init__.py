"""Column functions: score curves and text helpers."""

from sigscore.functions.curves import (DEFAULT_CURVES, add_ten, hfc, score_expr,  # noqa: F401
                                       speedtest)
from sigscore.functions.text import is_blank, normalise_text, trim_blanks  # noqa: F401
from sigscore.functions.sql import register_sql_functions  # noqa: F401,E402
