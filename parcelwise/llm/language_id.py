"""Language identification with language-bitmask n-gram filters.

Method: a bit-sliced Bloom filter has one machine word of language bits per slot.  An n-gram of
language l sets bit l in the n-gram's slots; the bitwise AND of its slots gives all languages that contain it, in one
lookup.  A text's n-grams are looked up, the hits of each language counted, the counts corrected for the
filter's false positives of that language, and the largest share decides.

Scale: the filters are learned from a sample of at most about ``SAMPLE`` labelled documents per language (a documented
bound; chosen by a hash of the id) and keep the n-grams that a stated share of a language's sample has, so their size
does not follow the data.  Prediction is one narrow pass over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import received, send
from .words import byte_table, mix64, text_chunks

SAMPLE = 2000
SIZES = (2, 3, 4)
LEAST_SHARE = 0.05
HASHES = 3
UNKNOWN = "und"
_LETTERS = byte_table(bytes(b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)))
_ASCII = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


@dataclass
class LanguageFilter:
    """Slots of language bits (slot, word of 64 languages), the languages and their order of frequency."""

    slots: np.ndarray
    languages: list[str]
    prior: int

    @property
    def false_positive(self) -> np.ndarray:
        bits = np.array([((self.slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))])
        return bits ** HASHES

    def look_up(self, grams: np.ndarray) -> np.ndarray:
        """Language bits of each n-gram hash: one row of words per n-gram."""
        first, *more = _places(grams, len(self.slots))
        out = self.slots[first]
        for at in more:
            out = out & self.slots[at]
        return out


def _places(grams: np.ndarray, slots: int):
    """The slots of each n-gram: one per hash, for a filter of any (power of two) size."""
    mask, step = np.uint64(slots - 1), (grams >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((grams + np.uint64(i) * step) & mask).astype(np.int64)


def make_filter(grams: list[tuple[int, int]], languages: list[str], prior: int) -> LanguageFilter:
    """Filter of (language number, n-gram hash) pairs, with ten slots a pair or more (at least 2**12)."""
    bits = max(12, int(np.ceil(np.log2(10 * len(grams) + 1))))
    slots = np.zeros((1 << bits, -(-max(1, len(languages)) // 64)), np.uint64)
    pairs = np.array(grams, np.int64).reshape(-1, 2)
    numbers, hashes = pairs[:, 0], np.ascontiguousarray(pairs[:, 1]).view(np.uint64)
    bit = np.left_shift(np.uint64(1), (numbers % 64).astype(np.uint64))
    for at in _places(hashes, len(slots)):
        np.bitwise_or.at(slots, (at, numbers // 64), bit)
    return LanguageFilter(slots, languages, prior)


def _grams(data: np.ndarray, offsets: np.ndarray):
    """For each size: (hash of the n-gram that begins at each byte, whether it lies inside its text)."""
    mapped = np.zeros(len(data) + 8, np.uint8)
    np.take(_LETTERS, data, out=mapped[:len(data)])
    loads = np.ascontiguousarray(np.ndarray((len(data),), "<u8", buffer=mapped, strides=(1,)))  # aligned
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for n in SIZES:
        yield mix64((loads & np.uint64((1 << (8 * n)) - 1)) + np.uint64(n << 56)), left >= n


def _counted(numbers: dict):
    """Per task: documents of each language that contain each n-gram."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                lang = np.array([numbers[x] for x in batch.column("lang").slice(lo, hi - lo).to_pylist()])
                text = np.repeat(np.arange(hi - lo), np.diff(offsets))
                for gram, inside in _grams(data, offsets):
                    pair = np.unique(np.stack([gram[inside], text[inside].astype(np.uint64)], 1), axis=0)
                    both, n = np.unique(np.stack([pair[:, 0], lang[pair[:, 1].astype(np.int64)].astype(np.uint64)], 1), axis=0,
                                        return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 1].astype(np.int32)), pa.array(both[:, 0].view(np.int64)),
                                                      pa.array(n)], ["number", "gram", "n"])
    return run


def learn(labelled: DataFrame, sample: int = SAMPLE, least_share: float = LEAST_SHARE) -> LanguageFilter:
    """Filter learned from (doc_id, text, lang); rows with a null id, text or lang are left out, repeated rows count each time.

    An empty table gives a filter that predicts ``und``.  Other columns, whatever their names, are not read.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return make_filter([], [], 0)
    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, sample / sizes[name])))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    chosen = chosen.select(F.col("text").cast("binary").alias("text"), "lang")
    taken = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    numbers = {name: i for i, name in enumerate(languages)}
    least = F.create_map(*[x for name in languages for x in (F.lit(numbers[name]), F.lit(max(1.0, least_share * taken.get(name, 0))))])
    grams = chosen.mapInArrow(_counted(numbers), "number int, gram long, n long").groupBy("number", "gram").agg(
        F.sum("n").alias("n")).where(F.col("n") >= F.element_at(least, F.col("number")))
    pairs = [(r.number, r.gram) for r in grams.select("number", "gram").collect()]
    return make_filter(pairs, languages, numbers[max(languages, key=lambda x: (sizes[x], x))])


def _predict(sent, keep: list[str]):
    def run(batches):
        model: LanguageFilter = received(sent)
        wrong = model.false_positive
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                total, hits = np.zeros(hi - lo), np.zeros((hi - lo, len(model.languages)))
                if len(data):
                    for gram, inside in _grams(data, offsets):
                        total += np.diff(np.concatenate([[0], np.cumsum(inside)])[offsets])
                        words = model.look_up(gram)
                        words[~inside] = 0
                        for i in range(len(model.languages)):
                            bit = (words[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                            hits[:, i] += np.diff(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])[offsets])
                share = np.clip((hits / np.maximum(total, 1)[:, None] - wrong) / np.maximum(1e-9, 1 - wrong), 0, None)
                part = batch.slice(lo, hi - lo)
                texts = part.column("text")
                plain = np.diff(np.concatenate([[0], np.cumsum(_ASCII[data])])[offsets]) > 0
                names, scores = [], []
                for r in range(hi - lo):
                    lettered = plain[r] or (texts[r].is_valid and any(map(str.isalpha, texts[r].as_py().decode("utf-8", "replace"))))
                    if not lettered or not model.languages:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(share[r])) if share[r].any() else model.prior
                    names.append(model.languages[best])
                    scores.append(float(share[r, best] / share[r].sum()) if share[r].any() else 0.0)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 [*keep, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: LanguageFilter, keep: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held (``keep`` or null), lang_pred, score in 0 to 1.

    ``und`` with score 0 for a null text or one without a letter (Unicode's categories L; digits, fractions and numerals are none), or if nothing was learned.  A lettered text without any known
    n-gram gets the most frequent language with score 0.  Only the text is an input.  Repeated rows and null ids are predicted like any
    other, an empty table gives no rows, and other columns are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None).cast("boolean") if keep is None else keep).alias("held"),
                      F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_predict(send(docs.sparkSession, model), ["doc_id", "held"]),
                          "doc_id long, held boolean, lang_pred string, score double")


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
