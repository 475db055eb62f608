"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array.  In each round every word's
lowest-ranked neighbouring pair is merged wherever it stands in the word, leftmost
first; words without a known pair leave the array.  A pair's rank is found by binary
search in the sorted keys ``left << 32 | right``, and only pairs beside a merge are
searched again.  This gives the ids of one merge at a time, because each merge makes
a symbol of its own, so a pair that holds it ranks after the merge that made it
(checked on loading).

Texts are cut at plain spaces, which no word crosses, and the pieces seen before are
remembered (at most ``most``; a full memory is emptied).
"""

from __future__ import annotations

import gc
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkfold.llm.chunk_encode import slices
from sparkfold.llm.spelling import Spelling

NO_RANK = np.int32(2**31 - 1)
LONGEST_KEPT = 64


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class MergeRounds:
    """``merge(words)``: the ids of each word (bytes), as one flat array and the end of each word in it."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], dtype=np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in letters], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        born = np.full(max(vocabulary.values()) + 1, -1, dtype=np.int64)
        born[made] = np.arange(len(made))
        rank = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError("the merges are not in the order in which their symbols arise")
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks, self.made = (left << 32 | right)[order], rank[order].astype(np.int32), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(symbols), NO_RANK, dtype=np.int32)  # of the pair that starts here
        inside = np.flatnonzero(word[:-1] == word[1:])
        ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.repeat(least, sizes)
            open_ = least < NO_RANK
            if not open_.all():
                done_symbols.append(symbols[~open_])
                done_words.append(word[~open_])
                symbols, word, ranks, least = symbols[open_], word[open_], ranks[open_], least[open_]
                if not len(symbols):
                    break
            site = np.flatnonzero(ranks == least)
            # a run of equal symbols: every second pair
            run = np.concatenate([[True], (np.diff(site) > 1) | (ranks[site[1:]] != ranks[site[:-1]])])
            start = np.maximum.accumulate(np.where(run, np.arange(len(site)), 0))
            site = site[(np.arange(len(site)) - start) % 2 == 0]
            symbols[site] = self.made[ranks[site]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[site + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, ranks, site = symbols[keep], word[keep], ranks[keep], place[site]
            touched = np.zeros(len(symbols) + 1, dtype=bool)
            touched[site] = touched[site - 1] = True  # -1: the spare last place
            again = np.flatnonzero(touched[:-1])
            ranks[again] = NO_RANK
            if len(again) and again[-1] == len(symbols) - 1:
                again = again[:-1]
            again = again[word[again] == word[again + 1]]
            ranks[again] = self.rank(symbols[again], symbols[again + 1])
        if not done_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        symbols = symbols[np.argsort(word, kind="stable")]
        return symbols, np.cumsum(np.bincount(word, minlength=len(words)))


class BpeCodec:
    """Encodes and decodes as the vocabulary file says: special tokens, normaliser, word pattern, merges."""

    def __init__(self, path: str, most: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, (words, _) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or words["behavior"] != "Removed":
            raise ValueError(f"{path}: another kind of vocabulary")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # white space is what the pattern leaves out; the plain space is kept to tell the pieces apart
        self.words = regex.compile(words["pattern"]["Regex"] + "| ")
        self.library = Tokenizer.from_file(path)
        self.letter_bytes = {c: b for b, c in enumerate(byte_letters())}
        self.rounds = MergeRounds(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.most = most
        self.by_piece: dict[str, bytes] = {}
        self.by_word: dict[str, bytes] = {}
        strings = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        top = max(strings) + 1
        self.token_texts = Spelling([f"{strings.get(i, '')} ".encode() for i in range(top)])
        self.numbers = Spelling([f"{i} ".encode() for i in range(top)])
        gc.set_threshold(200_000)

    def _words(self, text: str) -> list[str]:
        """Normalised words of a text, with " " for each of its plain spaces."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a final capital sigma has no form of its own here
        return self.words.findall(text.lower())

    def _any_words(self, text: str) -> list[str]:
        """The words of a text; code points younger than Python's Unicode tables are left to the library's pattern."""
        if all(unicodedata.category(c) != "Cn" for c in text):
            return [w for w in self._words(text) if w != " "]
        library = self.library
        parts = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(self.letter_bytes[c] for c in part).decode() for part, _ in parts]

    def _merge(self, words: set[str]) -> None:
        new = list(words.difference(self.by_word))
        if new:
            ids, ends = self.rounds.merge([w.encode() for w in new])
            data, stops = ids.astype("<u4").tobytes(), (4 * ends).tolist()
            self.by_word.update((w, data[a:b]) for w, a, b in zip(new, [0, *stops], stops))

    def _learn(self, pieces: set[str]) -> list[str]:
        """Encode pieces that are not remembered; returns those too long to stay."""
        new = list(pieces.difference(self.by_piece))
        joined = " ".join(new)
        apart = {p for p in new if "<|" in p} if "<|" in joined else set()
        young = {c for c in set(joined) if unicodedata.category(c) == "Cn"}
        if young:
            apart.update(p for p in new if not young.isdisjoint(p))
        plain = [p for p in new if p not in apart] if apart else new
        found = self._words(" ".join(plain) if apart else joined)
        odd = {p: [s if s in self.special else self._any_words(s) for s in self.cut_special.split(p)] for p in apart}
        words = set(found)
        for parts in odd.values():
            words.update(w for s in parts if not isinstance(s, str) for w in s)
        words.discard(" ")
        self._merge(words)
        get, at = self.by_word.__getitem__, 0
        for p in plain:
            try:
                end = found.index(" ", at)
            except ValueError:
                end = len(found)
            self.by_piece[p] = get(found[at]) if end - at == 1 else b"".join(map(get, found[at:end]))
            at = end + 1
        for p, parts in odd.items():
            self.by_piece[p] = b"".join(self.special[s].to_bytes(4, "little") if isinstance(s, str) else b"".join(map(get, s)) for s in parts)
        for w in words:
            if len(w) > LONGEST_KEPT:
                del self.by_word[w]
        return [p for p in new if len(p) > LONGEST_KEPT]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's end."""
        if len(self.by_piece) + len(self.by_word) > self.most:
            self.by_piece.clear()
            self.by_word.clear()
        cut = [t.split(" ") for t in texts]
        long = self._learn(set().union(*cut))
        get = self.by_piece.__getitem__
        out = [b"".join(map(get, c)) for c in cut]
        for p in long:
            del self.by_piece[p]
        ends = np.cumsum([len(b) // 4 for b in out], dtype=np.int64)
        return np.frombuffer(b"".join(out), dtype="<u4"), ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Each text's tokens joined by one space, in UTF-8: the vocabulary names no decoder."""
        return self.token_texts.texts(ids, ends, cut=1)

    def decimal(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Each text's ids in decimal, joined by one space."""
        return self.numbers.texts(ids, ends, cut=1)


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """One codec for each Python worker, so its memory serves later tasks too."""
    if path not in _CODECS:
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_text, decoded) of every whole text, row by row, without a shuffle.

    ``ids``: little-endian uint32; ``ids_text``: the decimal ids joined by one space;
    ``decoded``: the text that the ids give back, in UTF-8.  A null text counts as
    empty; an empty text has no ids and empty texts; null and repeated doc_ids and
    repeated rows stay as they are; other columns are ignored; an empty table gives
    no rows.  A text is encoded whole, however long; memory holds one batch of about
    2,000,000 characters (or one longer text).
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_text", pa.binary()),
                        ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                ids, ends = own.encode(texts[lo:hi])
                stops = [0, *(4 * ends).tolist()]
                data = ids.tobytes()
                columns = [b.column(0).slice(lo, hi - lo), pa.array(np.diff(ends, prepend=0)),
                           pa.array([data[x:y] for x, y in zip(stops, stops[1:])], pa.binary()),
                           pa.array(own.decimal(ids, ends), pa.binary()), pa.array(own.decode(ids, ends), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, ids_text binary, decoded binary")
