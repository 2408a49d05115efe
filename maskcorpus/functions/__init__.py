"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from maskcorpus.functions.text import (
    example_id, function_id, line_count, mask_budget, py_split, py_strip, sentinel, split_lines,
)

__all__ = ["example_id", "function_id", "line_count", "mask_budget", "py_split", "py_strip",
           "sentinel", "split_lines"]
