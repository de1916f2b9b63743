"""Parameters of pipelines: merged files, and the seed."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np


def load_parameters(folder: str) -> dict:
    """All ``parameters*.yml`` of a folder on the driver, merged in the order of their names."""
    import yaml

    out: dict = {}
    for path in sorted(Path(folder).glob("parameters*.yml")):
        out |= yaml.safe_load(path.read_text()) or {}
    return out


def global_seed(params: dict) -> int:
    return int(params["GLOBAL_SEED"])


def seed_driver(seed: int) -> None:
    """Seeds of the driver's generators; Spark's estimators take theirs as a parameter."""
    random.seed(seed)
    np.random.seed(seed)
