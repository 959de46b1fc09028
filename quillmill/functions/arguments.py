"""Checks and defaults for scalar arguments (plain Python, no data)."""

from __future__ import annotations

import math


def resolve_block_size(given: int | None, model_max_length: int, max_positions: int = 1024) -> int:
    if given is not None:
        return min(given, model_max_length)
    if model_max_length <= max_positions:
        return model_max_length
    return min(1024, max_positions) if max_positions > 0 else 1024


def sample_sizes(batch: int, eval_steps: int, version: int = 2) -> tuple[int, int]:
    """Rows of a train and a validation shard used in test mode."""
    if version == 2:
        return batch * eval_steps * 2, batch * eval_steps * 2
    return batch * eval_steps * 3, eval_steps


def resolve_interval(interval: float, max_steps: int) -> int:
    """A logging, evaluation or save interval; below 1 it is a share of all steps."""
    return math.ceil(max_steps * interval) if interval < 1 else int(interval)
