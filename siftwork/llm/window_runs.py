"""Stretches of neighbouring windows that share a fingerprint taken from their content.

The fingerprint of a window is the least hash of the k unit stretches inside it, so equal windows
have equal fingerprints. Neighbours mostly share theirs: a run is a maximal stretch of windows with
one fingerprint, and there is about one run for each half window. A window can only be repeated if
its fingerprint is, so it is enough to count one fingerprint per run. Runs of the same content hash
hold the same windows, which settles the inside of repeated passages with one row per run; single
windows need to be compared only where runs of one fingerprint differ, at the passages' ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from siftwork.llm.common import RollingHashes, mixed, runs_of, sliding_minimum

_anchors = RollingHashes(0x9E3779B97F4A7C15)
_contents = RollingHashes(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Runs:
    """Runs of one document, and the prefix sums from which contents are hashed."""

    anchors: np.ndarray
    starts: np.ndarray
    ends: np.ndarray  # exclusive, in windows
    repeats_itself: np.ndarray  # whether one run may hold a window twice
    sums: np.ndarray
    width: int

    def contents(self, chosen: np.ndarray) -> np.ndarray:
        """Hashes of all units of the chosen runs."""
        ends = self.ends[chosen] - 1 + self.width
        return _contents.stretches(self.sums, self.starts[chosen], ends)

    def windows(self) -> np.ndarray:
        return _contents.windows(self.sums, self.width)


def window_runs(units: np.ndarray, width: int, k: int) -> Runs | None:
    """The runs of windows of ``width`` units; None for shorter sequences."""
    if len(units) < width:
        return None
    grams = _anchors.windows(_anchors.sums(units), k)
    least = sliding_minimum(grams, width - k + 1)
    starts, ends = runs_of(least)
    # A window can come again within its run only if the fingerprint does: the window that
    # starts with it is then followed by another one of the run.
    again = (grams[: len(least) - 1] == least[:-1]) & (least[1:] == least[:-1])
    twice = np.zeros(len(starts), dtype=bool)
    twice[np.searchsorted(starts, np.flatnonzero(again), side="right") - 1] = True
    return Runs(least[starts], starts, ends, twice, _contents.sums(units), width)


def cells_of(anchors: np.ndarray, bits: int, row: int = 0) -> np.ndarray:
    """Cells of a count-min row of 2**bits cells; rows lie one behind the other."""
    salt = np.uint64((0xA0761D6478BD642F * (row + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mixed(anchors ^ salt) >> np.uint64(64 - bits)) + np.uint64(row << bits)
