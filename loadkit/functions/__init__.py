"""Column expressions and numbering helpers."""

from loadkit.functions.exprs import (  # noqa: F401
    any_null,
    basename,
    instance_key,
    key_expression,
    literal_prefix,
    ntz_literal,
    nonempty_row,
    padded_run_id,
    resolve_columns,
    substitute,
)
from loadkit.functions.numbering import number_within  # noqa: F401
