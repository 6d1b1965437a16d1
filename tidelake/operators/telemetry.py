"""Counters of what writes did."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass
class WriteStats:
    """Mutating calls that were tried, commits that succeeded, bytes of data files they added. Reads count nothing."""

    requests: int = 0
    commits: int = 0
    bytes: int = 0

    def tried(self) -> None:
        self.requests += 1

    def committed(self, size: int = 0) -> None:
        self.commits += 1
        self.bytes += size
