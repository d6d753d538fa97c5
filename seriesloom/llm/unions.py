"""Joining linked rows of one task, so that a task sends a link a row instead of all its pairs."""

from __future__ import annotations

import numpy as np


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """For each of ``n`` rows the smallest row that links ``a[i]`` - ``b[i]`` lead to.

    ``labels`` continues from an earlier result, so that links can come in blocks.
    """
    labels = np.arange(n) if labels is None else labels
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:  # every row points to a root
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
    return labels
