"""Toxicity classifier by non-negative positive-unlabelled learning.

Method: only confirmed toxic texts and unlabelled texts are learned from.  The risk of a linear
classifier is prior * risk(toxic as 1) + max(0, risk(unlabelled as 0) - prior * risk(toxic as 0)): what the unlabelled texts
would cost as clean, less the toxic ones among them, never below zero.  It is minimised with Adam in numpy.  The class prior is
a parameter or the share of toxic rows among the labelled ones.

A text's features are its words and their beginnings (4 to 7 bytes), hashed; each counts with its share of
the text, so length does not matter and every part of a long text counts.  The classifier uses the features of ``LEAST_TEXTS`` or more toxic texts whose
mean share is at least e times higher in toxic than in unlabelled texts; their log ratios are where the weights start.

Scale: the fit takes bounded samples (``POSITIVES`` toxic and ``UNLABELLED`` other texts, each whole),
chosen by a hash of the id; features are counted in Spark and only the selected ones come to the driver; scoring is one narrow pass over whole texts with a model of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, received, send
from .words import ALNUM, mix64, text_chunks, word_spans

BITS = 22
BEGINNINGS = (4, 5, 6, 7)
POSITIVES, UNLABELLED = 2000, 6000
LEAST_RATIO, LEAST_TEXTS, SMOOTHING = 1.0, 3, 1e-5
#: shares are summed as whole numbers of this fraction, so sums do not depend on their order
ONE = 1 << 40
ALL = -1
STEPS, RATE, PULL, SCALE = 400, 0.1, 1e-3, 25.0


@dataclass
class ToxicModel:
    numbers: np.ndarray  # selected features
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.numbers] = self.weights
        return out


#: what is learned where nothing tells toxic texts from others: every text scores 0
NOTHING_TOXIC = ToxicModel(np.empty(0, np.int32), np.empty(0, np.float32), -30.0)


def _occurrences(data: np.ndarray, offsets: np.ndarray):
    """(feature number and text of every occurrence of a feature, as one pair of arrays per kind of feature)."""
    words, mapped, starts, length, at = word_spans(data, offsets, ALNUM)
    loads = np.ndarray((len(data) + 1,), "<u8", buffer=mapped, strides=(1,))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    yield (words >> np.uint64(64 - BITS)).astype(np.int32), text
    for n in BEGINNINGS:
        some = np.flatnonzero(length >= n)
        h = mix64((loads[starts[some]] & np.uint64((1 << (8 * n)) - 1)) + np.uint64(n << 56))
        yield (h >> np.uint64(64 - BITS)).astype(np.int32), text[some]


def features(data: np.ndarray, offsets: np.ndarray):
    """(feature numbers, shares, text offsets): distinct features of each text, their shares summing to 1."""
    pair = [(text << BITS) | number for number, text in _occurrences(data, offsets)]
    pair, n = np.unique(np.concatenate(pair), return_counts=True)
    text = pair >> BITS
    total = np.bincount(text, weights=n, minlength=len(offsets) - 1)
    return (pair & ((1 << BITS) - 1)).astype(np.int32), (n / total[text]).astype(np.float32), np.searchsorted(text, np.arange(len(offsets)))


def _described(among: np.ndarray):
    """Features of each text that are in the sorted list ``among``, with their shares of the whole text."""
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                number, value, cuts = features(data, offsets)
                numbers, values = [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    top = np.arange(a, b)[np.isin(number[a:b], among, assume_unique=True)]
                    numbers.append(number[top].tobytes())
                    values.append(value[top].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.binary()), pa.array(values, pa.binary())], ["numbers", "values"])
    return run


def _sums(batches):
    """Of each feature of whole texts: in how many texts it is and the sum of its shares; all texts count under ``ALL``."""
    texts, shares, every = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            number, value, _ = features(data, offsets)
            np.add.at(texts, number, 1)
            np.add.at(shares, number, np.rint(value.astype(np.float64) * ONE).astype(np.int64))
            every += hi - lo
    some = np.flatnonzero(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, ALL).astype(np.int32)), pa.array(np.append(texts[some], every)),
                                      pa.array(np.append(shares[some], 0))], ["number", "texts", "share"])


def _summed(texts: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(number, texts, share) over a bounded sample of texts, at most 2^BITS rows, and the number of texts."""
    found = texts.select("text").mapInArrow(_sums, "number int, texts long, share long")
    found = materialize(found.groupBy("number").agg(F.sum("texts").alias("texts"), F.sum("share").alias("share")), name)
    every = found.where(F.col("number") == ALL).first()
    return found.where(F.col("number") != ALL), every.texts if every else 0


def _collected(texts: DataFrame, run) -> list:
    """(numbers, shares) of a bounded sample of texts, in an order that depends on the texts only."""
    found = texts.select("text").mapInArrow(run, "numbers binary, values binary").toArrow()
    pairs = sorted(zip(found.column("numbers").to_pylist(), found.column("values").to_pylist(), strict=True))
    return [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b in pairs]


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` distinct rows, chosen by a hash of the whole row: many rows of one id are sampled like others, equal rows once."""
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) < F.lit(share * (1 << 20))).distinct()


def fit(documents: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> ToxicModel:
    """Model from ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic); pass only rows that may be learned from.

    At most about ``positives`` and ``unlabelled`` distinct rows (doc_id, text) are learned from, whatever ids they have; repeated
    rows count once.  Rows with a null id or text are left out; an id labelled more than once is toxic if any of its labels is.  Without a toxic
    example, or a feature that toxic texts have more of, every text scores 0.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known.select("doc_id", (F.col("toxic") > 0).alias("toxic")), "labels")
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text"))
    toxic = _sampled(known.where("toxic"), positives).select("doc_id")
    # ids of a sample of bounded size: the texts are not shuffled for them; an id may have many texts, so they are sampled again
    toxic_texts = _sampled(materialize(texts.join(F.broadcast(toxic), "doc_id", "left_semi").distinct(), "toxic-texts"), positives)
    toxic_texts, other_texts = materialize(toxic_texts, "toxic-sample"), materialize(_sampled(texts, unlabelled), "other-sample")
    (p, n_toxic), (u, n_other) = _summed(toxic_texts, "toxic-features"), _summed(other_texts, "other-features")
    if not n_toxic or not n_other or prior <= 0:
        return NOTHING_TOXIC
    numbers, ratio = telling(p, n_toxic, u, n_other)
    if not len(numbers):
        return NOTHING_TOXIC
    # only the selected features of each text come to the driver
    return train(_collected(toxic_texts, _described(numbers)), _collected(other_texts, _described(numbers)), numbers, ratio, prior)


def telling(toxic: DataFrame, n_toxic: int, other: DataFrame, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers and log ratios of the features that toxic texts have clearly more of.

    ``LEAST_TEXTS`` toxic texts are enough, however many there are, so a rare kind of toxic text has its own.
    """
    p, u = F.col("share") / F.lit(ONE * n_toxic), F.coalesce("other", F.lit(0)) / F.lit(ONE * n_other)
    both = toxic.where(F.col("texts") >= LEAST_TEXTS).join(other.select("number", F.col("share").alias("other")), "number", "left")
    found = both.select("number", F.log((p + SMOOTHING) / (u + SMOOTHING)).alias("ratio")).where(F.col("ratio") >= LEAST_RATIO)
    rows = sorted(found.select("number", "ratio").collect())
    return np.array([r.number for r in rows], np.int32), np.array([r.ratio for r in rows], np.float64)


def _joined(rows: list):
    cuts = np.cumsum([0, *(len(r[0]) for r in rows)])
    return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.repeat(np.arange(len(rows)), np.diff(cuts))


def _reduced(rows: list, numbers: np.ndarray) -> list:
    """Rows with places in ``numbers`` (sorted) instead of feature numbers; other features go."""
    out = []
    for number, share in rows:
        at = np.minimum(np.searchsorted(numbers, number), len(numbers) - 1)
        keep = numbers[at] == number
        out.append((at[keep], share[keep].astype(np.float64)))
    return out


def train(toxic: list, other: list, numbers: np.ndarray, ratio: np.ndarray, prior: float, steps: int = STEPS) -> ToxicModel:
    """Weights of the features ``numbers`` that minimise the non-negative risk with the sigmoid loss, over all examples at once."""
    toxic, other = ([(n, SCALE * s * ratio[n]) for n, s in _reduced(rows, numbers)] for rows in (toxic, other))
    k = len(numbers)
    size = k + 2  # a factor for all log ratios, free of the pull towards them, and the bias
    w, m, v = np.concatenate([np.zeros(k), [1.0, -2.0]]), np.zeros(size), np.zeros(size)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    (pn, pv, pt), (un, uv, ut) = _joined(toxic), _joined(other)
    for step in range(1, steps + 1):
        p = sigmoid(np.bincount(pt, (w[k] + w[pn]) * pv, len(toxic)) + w[-1])
        u = sigmoid(np.bincount(ut, (w[k] + w[un]) * uv, len(other)) + w[-1])
        as_clean = u.mean() - prior * p.mean()  # what the unlabelled texts cost as clean, less the toxic among them
        gp = -prior * p * (1 - p) / len(toxic)
        gu = u * (1 - u) / len(other) if as_clean > 0 else np.zeros(len(other))
        gp = 2 * gp if as_clean > 0 else gp
        g = (np.bincount(pn, gp[pt] * pv, size) + np.bincount(un, gu[ut] * uv, size)).astype(np.float64)
        g[k] = g[:k].sum()
        g[:k] += PULL * w[:k]
        g[-1] = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = RATE * (1 - step / (steps + 1))
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return ToxicModel(numbers, (SCALE * (w[k] + w[:k]) * ratio).astype(np.float32), float(w[-1]))


def _chunk_scores(texts: pa.Array, weights: np.ndarray, bias: float):
    for lo, hi, data, offsets in text_chunks(texts):
        total, z = np.zeros(hi - lo), np.zeros(hi - lo)
        for number, text in _occurrences(data, offsets):
            total += np.bincount(text, minlength=hi - lo)
            z += np.bincount(text, weights[number], hi - lo)
        yield lo, hi, 1 / (1 + np.exp(-np.clip(z / np.maximum(total, 1) + bias, -30, 30)))


def _scores(sent, keep: list[str]):
    def run(batches):
        model: ToxicModel = received(sent)
        weights = model.dense()
        for batch in batches:
            for lo, hi, found in _chunk_scores(batch.column("text"), weights, model.bias):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(found)], [*keep, "score"])
    return run


def score(docs: DataFrame, model: ToxicModel, keep: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held (``keep`` or null), score in 0 to 1.

    Null, empty and wordless texts get the score of no evidence (the bias alone).  Only the text is an input; other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None).cast("boolean") if keep is None else keep).alias("held"),
                      F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_scores(send(docs.sparkSession, model), ["doc_id", "held"]), "doc_id long, held boolean, score double")


def drop_toxic(docs: DataFrame, model: ToxicModel, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score is ``least`` or more; all columns are returned as they are."""
    sent = send(docs.sparkSession, model)

    @F.pandas_udf("double")
    def toxic(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = received(sent)
        weights = found.dense()
        for texts in parts:
            scores = [s for _, _, s in _chunk_scores(pa.array(texts, pa.large_binary(), from_pandas=True), weights, found.bias)]
            yield pd.Series(np.concatenate(scores) if scores else np.empty(0))

    return docs.where(toxic(F.col("text").cast("binary")) < least)
