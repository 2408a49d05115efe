"""Parameters and fixed values of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference pipeline's for equal results.
# ---------------------------------------------------------------------------
MASK_TOKEN = "<extra_id_0>"
PAD_TOKEN = "<pad>"
EOS_TOKEN = "</s>"
UNK_TOKEN = "<unk>"
# Special tokens in id order: <pad> <unk> </s> <extra_id_0> ... <extra_id_99>
N_SENTINELS = 100
SPECIAL_TOKENS = [PAD_TOKEN, UNK_TOKEN, EOS_TOKEN] + [f"<extra_id_{i}>" for i in range(N_SENTINELS)]
# Permissive licences kept by the catalog filter (SPDX ids).
LICENSE_ALLOW = ["MIT", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "ISC"]
# Keywords tried in this order on the `if` line; the condition ends at the first ':'.
IF_KEYWORDS = ["elif", "if"]
IF_TERMINATOR = ":"
DEFAULT_BRANCH = "main"
SOURCE_SUFFIX = ".py"
# Python's str.isspace() set as one regex class (same text is valid Java regex and RE2):
# \t \n \v \f \r, the four information separators, space, NEL and Unicode category Z.
PY_WHITESPACE_CLASS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Pipeline parameters.

    The four sizes are cuts: None keeps everything (all repositories, all
    functions, PRETRAIN_SHARE of them for pre-training and the rest for
    fine-tuning). ``reference_sizes`` has the reference's own cuts.
    """

    max_repos: int | None = None
    min_stars: int = 10
    language: str = "Python"
    licenses: tuple[str, ...] = tuple(LICENSE_ALLOW)
    total_functions_target: int | None = None
    pretrain_target: int | None = None
    finetune_target: int | None = None
    pretrain_share: float = 0.7
    vocab_size: int = 32_000
    max_length: int = 512
    mask_rate_percent: int = 15
    min_tokens: int = 10
    train_fraction: float = 0.8
    val_fraction: float = 0.1
    holdout_fraction: float = 0.05
    seed: int = 42
    keywords: tuple[str, ...] = tuple(IF_KEYWORDS)
    terminator: str = IF_TERMINATOR
    mask_token: str = MASK_TOKEN


def reference_sizes(**other) -> Params:
    """The reference's configuration: its cuts at 1,000 repositories and 500,000 functions (350,000 + 150,000)."""
    sizes = {"max_repos": 1000, "total_functions_target": 500_000, "pretrain_target": 350_000, "finetune_target": 150_000}
    return Params(**{**sizes, **other})
