"""DataFrame operators: output tail, quality checks, merge, reshape, joins, ordering."""

from . import joins, merge, ordering, quality, reshape, tail
from .joins import join_dimension
from .merge import merge as null_safe_merge
from .ordering import global_row_number
from .reshape import explode_list, flatten, unpivot, zip_lists
from .tail import (cast_to_schema, clean_strings, fill_defaults, output_tail, prepare_output,
                   project, require_columns)

__all__ = [
    "cast_to_schema", "clean_strings", "explode_list", "fill_defaults",
    "flatten", "global_row_number", "join_dimension", "joins", "merge", "null_safe_merge",
    "ordering", "output_tail", "prepare_output", "project", "quality", "require_columns",
    "reshape", "tail", "unpivot", "zip_lists",
]
