"""Column expressions shared by the operators (all JVM-side built-ins)."""

from sylva.functions.paths import (  # noqa: F401
    branch_string,
    diff_signature,
    fork_nodes,
    leaf,
    mask_token,
    masked_token,
    padded_symbol,
    path_ids,
    token_key,
    vocab_display,
)
from sylva.functions.text import (  # noqa: F401
    file_stem,
    numbered_line,
    split_lines,
    with_extension,
)
