"""Built-in-only column expressions (vectors, text, dates)."""

from basalt.functions.text import day_diff, first_word, initial, second_word, starts_with_ci, strip_and_cast
from basalt.functions.vectors import (
    dot,
    lit_matrix,
    lit_vector,
    of_width,
    sigmoid,
    sq_dist,
    to_double_array,
    vadd,
    vscale,
    vsum,
)

__all__ = [
    "day_diff", "first_word", "initial", "second_word", "starts_with_ci", "strip_and_cast",
    "dot", "lit_matrix", "lit_vector", "of_width", "sigmoid", "sq_dist", "to_double_array",
    "vadd", "vscale", "vsum",
]
