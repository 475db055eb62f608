"""Tokenizer ids of whole texts, with the pieces between plain spaces memoised.

Both vocabularies split a text before any merge, and a single U+0020 between two
non-white characters is always such a split.  So the ids of a text are the ids of
its pieces in order, and a piece that was seen before need not be encoded again.
Where a space touches other white space, the text is only cut at the safe spaces.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np

from sparkfold.llm.worker import keep_only

SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
LONGEST_KEPT = 64
RUN = 64
#: Stands alone between two pieces where the vocabulary drops white space; always one token.
MARK = "\x01"


class ChunkEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes.

    ``keeps_space``: the vocabulary puts the space in front of the next piece
    (byte-level); otherwise white space is dropped.  At most ``most`` pieces are
    remembered; a full memory is emptied.
    """

    def __init__(self, path: str, keeps_space: bool, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.most = most
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.odd: set[str] = set()
        vocabulary = self.tokenizer.get_vocab()
        # tokens that only the start of a piece (its space) or the mark gives
        self.is_edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if keeps_space:
            self.is_edge[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        else:
            self.is_edge[self.tokenizer.encode(MARK, add_special_tokens=False).ids] = True
        gc.set_threshold(200_000)  # strings and bytes form no cycles; the default walks a large memory over and over

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in out]

    def _learn(self, memory: dict[str, bytes], missing: set[str], lead: str) -> list[str]:
        """Encode pieces that the memory lacks; returns those too long to remember.

        Pieces that follow a space are encoded in runs, told apart by ``is_edge``.
        """
        new = list(missing)
        alone = [p for p in new if memory is self.first or " " in p or MARK in p or "<|" in p or len(p) > LONGEST_KEPT or not p]
        memory.update(zip(alone, self._ids([lead + p for p in alone])))
        apart = set(alone)
        joint = [p for p in new if p not in apart] if apart else new
        runs = [joint[i:i + RUN] for i in range(0, len(joint), RUN)]
        texts = [" " + " ".join(r) if self.keeps_space else f" {MARK} ".join(r) + f" {MARK}" for r in runs]
        for run, e in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            edges = (4 * np.flatnonzero(self.is_edge[ids])).tolist()
            if len(edges) != len(run):
                raise ValueError("the vocabulary does not split as expected")
            data = ids.tobytes()
            if self.keeps_space:
                memory.update((p, data[x:y]) for p, x, y in zip(run, edges, [*edges[1:], len(data)]))
            else:
                memory.update((p, data[x:y]) for p, x, y in zip(run, [0, *(x + 4 for x in edges)], edges))
        return [p for p in alone if len(p) > LONGEST_KEPT]

    def _cut(self, texts: list[str]) -> tuple[list[list[str]], set[str]]:
        """Each text's pieces, and those that the memory lacks; texts with other white space beside a space are only
        cut where it is safe."""
        cut = [t.split(" ") for t in texts]
        new = set().union(*cut).difference(self.rest)  # not ``-``: that walks the whole memory
        if self.keeps_space:
            self.odd.update(p for p in new if not p or p[0].isspace() or p[-1].isspace())
            if self.odd:
                new -= self.odd
                for i, c in enumerate(cut):
                    if not self.odd.isdisjoint(c):
                        cut[i] = SAFE_SPACE.split(texts[i])
                        new.update(p for p in cut[i] if p not in self.rest)
        return cut, new

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.rest) + len(self.odd) > self.most:
            self.first.clear()
            self.rest.clear()
            self.odd.clear()
        cut, new = self._cut(texts)
        if self.keeps_space:
            heads, tails = [c[0] for c in cut], [c[1:] for c in cut]
            long_first = self._learn(self.first, set(heads).difference(self.first), "")
            long_rest = self._learn(self.rest, new, " ")
            get, head = self.rest.__getitem__, self.first.__getitem__
            out = [head(h) + b"".join(map(get, t)) for h, t in zip(heads, tails)]
            for p in long_first:
                del self.first[p]
        else:
            long_rest = self._learn(self.rest, new, "")
            get = self.rest.__getitem__
            out = [b"".join(map(get, c)) for c in cut]
        for p in long_rest:
            del self.rest[p]
        return out


def encoder(path: str, keeps_space: bool) -> ChunkEncoder:
    """One encoder per Python worker, so its memory serves later tasks too, until another operator's run there."""
    kept = keep_only("encoder")
    if (path, keeps_space) not in kept:
        kept[path, keeps_space] = ChunkEncoder(path, keeps_space)
    return kept[path, keeps_space]


def slices(texts: list[str], chars: int = 2_000_000):
    """Index ranges whose texts hold about ``chars`` characters (one longer text stands alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
