"""Texts spelled from a table of byte strings, many at once: one row gather and one mask for each batch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

GATHERED = 8 << 20


class Spelling:
    """``texts(codes, ends)`` joins ``words[code]`` for each run of codes; words are any byte strings."""

    def __init__(self, words: Sequence[bytes]):
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.blob = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The words in rows of ``width`` bytes (longer ones cut), and which bytes of a row count."""
        if width not in self.tables:
            at = np.arange(width)
            used = at < self.sizes[:, None]
            self.tables[width] = self.blob[np.where(used, self.starts[:, None] + at, 0)], used
        return self.tables[width]

    def join(self, codes: np.ndarray) -> np.ndarray:
        """All words of ``codes``, one after the other."""
        out, at = [], 0
        while at < len(codes):
            part = codes[at:at + 200_000]
            width = 8
            while width < self.sizes[part].max():
                width *= 2
            step = max(1, GATHERED // width)
            part = part[:step]
            rows, used = self.table(width)
            out.append(rows[part][used[part]])
            at += len(part)
        return np.concatenate(out) if out else np.zeros(0, np.uint8)

    def texts(self, codes: np.ndarray, ends: np.ndarray, cut: int = 0) -> list[bytes]:
        """One byte string for each run ``codes[ends[k-1]:ends[k]]``; its last ``cut`` bytes are left out."""
        data = self.join(codes).tobytes()
        stops = np.concatenate([[0], np.cumsum(self.sizes[codes])])[np.concatenate([[0], ends])].tolist()
        return [data[a:max(a, b - cut)] for a, b in zip(stops, stops[1:])]
