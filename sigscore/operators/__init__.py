"""DataFrame -> DataFrame operators."""

from sigscore.operators.aggregate import count_rows  # noqa: F401
from sigscore.operators.dimension import (dim_columns, dim_columns_wide, dim_current,  # noqa: F401
                                          dim_duplicate_keys, join_inner_alias,
                                          lookup_halflife)
from sigscore.operators.enrich import (cook_signals, enrich_halflife, score_signals,  # noqa: F401
                                       score_signals_text_ts, score_simple,
                                       with_score_by_subtype)
from sigscore.operators.preview import describe_schema, preview_cooked, preview_rows  # noqa: F401
from sigscore.operators.projections import (add_null_column, add_product_column,  # noqa: F401
                                            filter_gt, select_columns, select_score_inputs,
                                            select_two, with_text_timestamps)
from sigscore.operators.sizing import fits_broadcast, lookup_join, measured_size, within_keys  # noqa: F401
