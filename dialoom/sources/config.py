"""Where a job runs and its paths."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def environment(env: Mapping[str, str] | None = None) -> str:
    """colab, kaggle or local, told by the variables that these services set."""
    env = os.environ if env is None else env
    if "COLAB_RELEASE_TAG" in env or "COLAB_GPU" in env:
        return "colab"
    if "KAGGLE_KERNEL_RUN_TYPE" in env:
        return "kaggle"
    return "local"


@dataclass(frozen=True)
class JobConfig:
    data: str
    output: str
    max_length: int = 4096
    seed: int = 42

    @classmethod
    def of(cls, env: str | None = None, root: str = ".") -> JobConfig:
        bases = {"colab": "/content", "kaggle": "/kaggle/working", "local": root}
        base = bases[env or environment()]
        return cls(f"{base}/data/output", f"{base}/output")
