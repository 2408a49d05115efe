"""maskcorpus: build, split, encode and score masked-code datasets with PySpark.

Every operator is a DataFrame -> DataFrame function; Python kernels run only
where Spark has no native expression (archive reading, syntax parsing, NFKC,
the per-word BPE merge loop, a user's model call).
"""

from maskcorpus.config import Params

__all__ = ["Params"]
