"""Language identification by compression.

For each language a raw-content dictionary is gathered from labelled texts; a text
is compressed with every dictionary, in blocks so that the dictionary and not the
text's own past decides, and the language with the smallest sum of sizes wins.
Case and everything but letters is folded away first.  Sizes are whole bytes, too
coarse for a short text: its sizes are summed over several starts, at a higher level.
Where the second smallest is hardly larger the choice is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.samples import fold

LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")
SHORT, SHIFTS = 256, 8
#: Ends every dictionary and starts every block: it saves the same in all, so that short blocks aren't stored plain.
MARK = b"0123456789876543210123456787654321012345676543210"
UNKNOWN = "und"


def fold_text(text: str) -> str:
    return OTHER.sub(" ", text.lower())


def dictionaries(docs: DataFrame, modulus: int = 5, held_out: int = 0, per_language: int = 300, size: int = 96 << 10) -> dict[str, bytes]:
    """lang -> at most ``size`` bytes of text, an equal part from each of about ``per_language`` documents.

    Rows are taken by a hash of doc_id below a bound that follows from the language's
    row count, so a language costs the driver the same however many rows it has.
    """
    known = docs.select(F.col("doc_id").cast("long"), "lang", "text").filter("lang is not null and text is not null").filter(fold(modulus) != held_out)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    span = 1 << 40
    bounds = counts.select("lang", F.least(F.lit(span), F.ceil(F.lit(float(span * per_language)) / F.col("n"))).alias("bound"))
    part = size // per_language
    # a piece from a place that the hash picks; a document gives at most four parts, so short ones leave no gap
    length, h = F.length("text"), F.xxhash64("doc_id", "text")
    start = F.pmod(h, F.greatest(F.lit(1), length - 4 * part)) + 1
    sample = (known.join(F.broadcast(bounds), "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < F.col("bound"))
              .select("lang", "doc_id", F.substring("text", start.cast("int"), F.lit(4 * part)).alias("piece")))
    pieces: dict[str, list[bytes]] = {}
    for r in sample.toLocalIterator():
        pieces.setdefault(r.lang, []).append((r.doc_id is None, r.doc_id or 0, fold_text(r.piece).encode()))
    out = {}
    for lang, own in sorted(pieces.items()):
        own = [p for *_, p in sorted(own)]
        share = max(part, size // max(1, len(own)))
        out[lang] = b"\n".join(p[:share] for p in own)[:size]
    return out


class Judge:
    """Compressed sizes of texts under each language's dictionary."""

    def __init__(self, content: dict[str, bytes], level: int = 3, short_level: int = 12, block: int = 2048):
        self.languages = sorted(content)
        self.block = block
        self.packers = [self._packer(content[lang], level) for lang in self.languages]
        self.short_packers = [self._packer(content[lang], short_level) for lang in self.languages]

    @staticmethod
    def _packer(content: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content + MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, text: bytes) -> list[int]:
        if len(text) < SHORT:
            blocks = [text[i:] for i in range(min(SHIFTS, len(text)))]
        else:
            blocks = [text[i:i + self.block] for i in range(0, len(text), self.block)]
        packers = self.packers if len(text) > self.block else self.short_packers
        return [sum(len(p.compress(MARK + b)) for b in blocks) for p in packers]

    def judge(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """(language, score, rejected): the score is the chosen one's share when every byte saved doubles the odds."""
        if not self.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        folded = fold_text(text).encode()
        sizes = self.sizes(folded)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best] + 64)
        saved = SHIFTS if len(folded) < SHORT else 1
        share = 1 / sum(2.0 ** -min(64, (s - sizes[best]) / saved) for s in sizes)
        return self.languages[best], share, second - sizes[best] < max(2, margin * sizes[best])


def identify(docs: DataFrame, content: dict[str, bytes], modulus: int = 5, held_out: int = 0, margin: float = 0.01) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every whole text.

    Null texts, texts without a letter, and all texts when nothing was learned:
    ``und``, score 0, rejected.  Equal sizes: the alphabetically first language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for b in batches:
            rows = [judge.judge(t, margin) for t in b.column(2).to_pylist()]
            if rows:
                lang, score, rejected = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                                                 names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long"), (fold(modulus) == held_out).alias("held_out"), "text")
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def classify(docs: DataFrame) -> DataFrame:
    return identify(docs, dictionaries(docs))
