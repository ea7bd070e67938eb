"""Savitzky-Golay weights, worked out on the driver."""

from __future__ import annotations

import numpy as np


def hat_matrix(window: int, degree: int) -> np.ndarray:
    """Row i gives the fitted value of sample i of a window as weights of its samples."""
    half = window // 2
    powers = np.vander(np.arange(-half, half + 1, dtype=float), degree + 1)
    return powers @ np.linalg.pinv(powers)


def odd_window(window: int) -> int:
    return window if window % 2 else window + 1
