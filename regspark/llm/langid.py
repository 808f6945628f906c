"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for every bit a binary n-gram classifier
tells the languages with a one from those with a zero (naive Bayes log ratios
over hashed byte 2- and 3-grams, counted by Spark over all labelled rows).
A text's real-valued bit margins are decoded to the codeword with the smallest
weighted logistic loss; the weight of a bit for a language is the margin that
language's own profile reaches on it. Texts whose two best languages lie close
together are flagged as ambiguous.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, map_rows, mix64, pick

FEATURES = 1 << 14
MAX_LANGUAGES = 512
CHUNK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.zeros(256, np.uint8)
_KEEP[:] = 32
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(x * U64(0x9E3779B97F4A7C15)) & U64(FEATURES - 1)).astype(np.uint16)


_PAIR = _mixed(np.arange(1 << 16, dtype=np.uint64))  # feature of each byte pair
_NEXT = _mixed(np.arange(1 << 8, dtype=np.uint64) + U64(1 << 20))  # added for the third byte


def grams(text: str) -> np.ndarray:
    """Hashed 2- and 3-grams of the lower-cased bytes; anything but letters is a blank.

    Grams of blanks only say nothing about the language and are left out.
    """
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)
    b = _KEEP[raw]
    space = b == 32
    b = b[~(space & np.r_[False, space[:-1]])]  # runs of blanks count once
    two = b[:-1].astype(np.uint16) << 8 | b[1:]
    pairs = _PAIR[two]
    threes = (pairs[:-1] ^ _NEXT[b[2:]]) & np.uint16(FEATURES - 1)
    return np.concatenate([pairs, threes])


def _count(batches):
    """Feature counts by language, one row per language and feature seen in this partition."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            if lang not in total:
                total[lang] = np.zeros(FEATURES, np.int64)
            total[lang] += np.bincount(grams(text.as_py()), minlength=FEATURES)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "f", "n"])


def codewords(n: int) -> np.ndarray:
    """One row of +1/-1 bits per class: the exhaustive code up to 6 classes, else a spread random code.

    No bit is constant and no two bits are equal or complementary in the
    exhaustive code; the random one is the best of 64 seeded draws by its
    smallest distance between two rows.
    """
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 6:
        cols = [[1] + [1 if (m >> i) & 1 else -1 for i in range(n - 1)] for m in range(2 ** (n - 1) - 1)]
        return np.array(cols, np.int8).T
    rng, best, best_d = np.random.default_rng(7), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        gram = code.astype(np.int64) @ code.T
        d = int((code.shape[1] - (gram - np.diag(np.diag(gram)) - np.diag([n * bits] * n)).max()) // 2)
        if d > best_d:
            best, best_d = code, d
    return best


class Model:
    """Codebook, bit classifiers and decoding weights of the learned languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, sharpness: float = 40.0):
        self.langs, self.sharpness = langs, sharpness
        p = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True) if len(langs) else counts
        self.code = codewords(len(langs)).astype(np.float64)
        bits = self.code.shape[1]
        self.w = np.zeros((FEATURES, bits), np.float32)
        for b in range(bits):
            one, zero = self.code[:, b] > 0, self.code[:, b] < 0
            self.w[:, b] = np.log(p[one].mean(axis=0) / p[zero].mean(axis=0))
        own = np.maximum(self.code * (p @ self.w), 1e-6)
        self.weight = own / own.sum(axis=1, keepdims=True) if bits else own

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean log ratio of each bit over the grams of each text."""
        out = np.zeros((len(texts), self.code.shape[1]))
        for i, text in enumerate(texts):
            g = grams(text)
            for at in range(0, len(g), CHUNK):
                part = g[at : at + CHUNK]
                if len(part) >= FEATURES:
                    out[i] += np.bincount(part, minlength=FEATURES) @ self.w.astype(np.float64)
                else:
                    out[i] += self.w[part].sum(axis=0, dtype=np.float64)
            out[i] /= max(1, len(g))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and gap between the two best codewords, for each text."""
        lang, score, gap = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not rows or not self.langs:
            return lang, score, gap
        m = self.margins([texts[i] for i in rows])
        z = self.code[None] * m[:, None, :] * self.sharpness
        loss = (self.weight[None] * np.logaddexp(0, -z)).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        soft = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        top = soft[np.arange(len(rows)), best] / soft.sum(axis=1)
        for k, i in enumerate(rows):
            lang[i], score[i] = self.langs[best[k]], float(min(1.0, top[k]))
            gap[i] = float(loss[k, order[k, 1]] - loss[k, best[k]]) if len(self.langs) > 1 else 1.0
        return lang, score, gap


def held_out() -> F.Column:
    """crc32 of the doc_id's text, modulo 4, is 2; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Model:
    """Learn from every labelled row that is not held out; only sums per language and feature are collected."""
    rows = pick(docs, doc_id="long", text="string", lang="string")
    rows = rows.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sums = (
        rows.mapInArrow(_count, "lang string, f int, n long").groupBy("lang", "f").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("f", "n")).alias("v")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    )
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the labels")
    counts = np.zeros((len(sums), FEATURES))
    for i, row in enumerate(sums):
        for f, n in row.v:
            counts[i, f] = n
    return Model([r.lang for r in sums], counts)


def _predict(model: Model, min_gap: float):
    def run(batches):
        for batch in batches:
            lang, score, gap = model.predict([t.as_py() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                pa.array([x < min_gap for x in gap], pa.bool_()),
            ], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return run


def identify(docs: DataFrame, model: Model | None = None, min_gap: float = 0.01) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, ambiguous``.

    ``score`` (0 to 1) is the share of the chosen codeword in the softmax of
    negative losses; ``ambiguous`` marks texts whose second codeword is within
    ``min_gap`` of the first.

    Defined cases: a null text or one without a letter is ``und`` with score 0
    and ambiguous; without labelled rows every text is ``und``; with a single
    language every text with a letter is that language; a null doc_id is never
    held out nor learned from (its remainder is unknown); repeated rows are
    judged once each. Other columns are ignored.
    """
    model = model or train(docs)
    rows = pick(docs, doc_id="long", text="string").withColumn("held_out", held_out())
    return rows.mapInArrow(
        _predict(model, min_gap), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def _accepted(model: Model, min_gap: float, column: int):
    def run(batches):
        for batch in batches:
            lang, _, gap = model.predict([t.as_py() for t in batch.column(column)])
            yield batch.filter(pa.array([a != "und" and g >= min_gap for a, g in zip(lang, gap)], pa.bool_()))
    return run


def unknown_dropped(docs: DataFrame, min_gap: float = 0.01) -> DataFrame:
    """The rows of ``docs`` with a clear language; columns and kept rows unchanged."""
    return map_rows(docs, _accepted(train(docs), min_gap, docs.columns.index("text")))
