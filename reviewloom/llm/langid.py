"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, every run of other characters than letters counts as one
blank, and n-grams of 1 to 3 characters are hashed into buckets. Document
frequencies cover all training documents. The regression is fitted by
follow-the-regularised-leader with an elastic net (L1 makes it sparse, L2 keeps
weights small) on a bounded sample, then a temperature is fitted on a part of the
sample that the regression has not seen.

Null texts, and texts without a letter, are `und` with score 0. Without training
documents every text is `und`. Null languages are not learned. Ids, nulls and
repeated rows of doc_id pass through as they are; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common

BITS = 14
BUCKETS = 1 << BITS
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """per_lang: about so many documents of each language are fitted on, chosen by a hash of doc_id.

    A tenth of them, at least, goes to the temperature. Languages are labels: there are few.
    """

    per_lang: int = 500
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; each run of others than letters is one 0; empty without letters."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(raw):
        return raw
    if int(raw.max()) < len(IS_LETTER):
        letter = IS_LETTER[raw]
    else:
        values, at = np.unique(raw, return_inverse=True)
        letter = np.array([chr(v).isalpha() for v in values])[at]
    if not letter.any():
        return raw[:0]
    out = np.where(letter, raw, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of others
    return np.concatenate([np.zeros(1, np.uint32), out[keep], np.zeros(1 if letter[-1] else 0, np.uint32)])


IS_LETTER = np.array([chr(i).isalpha() for i in range(0x3000)])


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the text's n-grams; empty without letters."""
    c = letters(text)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0)
    key = c.astype(np.uint32)
    hashed = [spread(key, 1)]
    for n in (2, 3):
        if len(c) >= n:
            key = key[:-1] * np.uint32(0x01000193) ^ c[n - 1 :]
            hashed.append(spread(key, n))
    total = np.bincount(np.concatenate(hashed), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at].astype(np.float64)


def spread(key: np.ndarray, n: int) -> np.ndarray:
    mixed = (key + np.uint32(n)) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)


def tf_idf(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length weights (1 + log count) * idf."""
    w = (1 + np.log(n)) * idf[at]
    norm = np.sqrt((w * w).sum())
    return w / norm if norm else w


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x langs
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        return w @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        at, n = counts(text or "")
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, tf_idf(at, n, self.idf)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_langs: int, s: Settings, seed: int = 1):
    """FTRL-proximal over rows of (buckets, weights). Returns weights and bias."""
    z, n = np.zeros((BUCKETS, n_langs)), np.zeros((BUCKETS, n_langs))
    zb, nb = np.zeros(n_langs), np.zeros(n_langs)
    rng = np.random.default_rng(seed)

    def solve(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        shrunk = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            za, na = z[at], n[at]
            w, b = solve(za, na, s.l1), solve(zb, nb, 0.0)
            d = softmax(x @ w + b)
            d[labels[i]] -= 1
            for g, w_, z_, n_ in ((x[:, None] * d, w, za, na), (d, b, zb, nb)):
                step = (np.sqrt(n_ + g * g) - np.sqrt(n_)) / s.alpha
                z_ += g - step * w_
                n_ += g * g
            z[at], n[at] = za, na
    return solve(z, n, s.l1), solve(zb, nb, 0.0)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log-loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    a, b, ratio = np.log(0.05), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and documents with letters, over all of `texts` (column text).

    Each task adds up its own documents; Spark adds up the tasks by bucket.
    """

    def make() -> Callable[..., list[tuple]]:
        def rows(column: list) -> list[tuple]:
            df, n = np.zeros(BUCKETS, np.int64), 0
            for t in column:
                at, _ = counts(t or "")
                df[at] += 1
                n += len(at) > 0
            at = np.flatnonzero(df)
            return [*zip(at.tolist(), df[at].tolist()), (-1, n)]

        return rows

    sums = common.map_batches(texts, make, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, total = np.zeros(BUCKETS, np.int64), 0
    for r in sums.collect():  # at most BUCKETS + 1 rows
        if r["bucket"] < 0:
            total = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, total


def sample_rows(docs: DataFrame, label: str, per_label: int) -> DataFrame:
    """About per_label rows of each label (all, if fewer), by a hash of doc_id: the same on any cluster.

    Adds `_part`, an even number from 0 to 9 for splitting the sample.
    """
    sizes = {r[label]: r["n"] for r in docs.groupBy(label).agg(F.count("*").alias("n")).collect()}
    parts = 1_000_003
    cut: Column = F.lit(0)
    for value, n in sorted(sizes.items(), key=str):
        cut = F.when(F.col(label) == F.lit(value), F.lit(min(parts, -(-parts * per_label // n)))).otherwise(cut)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(parts))
    return docs.filter(place < cut).withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)))


def train(docs: DataFrame, s: Settings = Settings()) -> Model:
    """docs: doc_id, text, lang; rows without a language are not used."""
    docs = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull())
    df, total = document_frequencies(docs.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1

    def make() -> Callable[..., tuple]:
        def row(doc_id: int | None, lang: str, part: int, text: str | None) -> tuple:
            at, n = counts(text or "")
            return doc_id, lang, part, at.astype("<u2").tobytes(), n.astype("<f4").tobytes()

        return row

    part = sample_rows(docs, "lang", s.per_lang).select("doc_id", "lang", "_part", "text")
    schema = "doc_id bigint, lang string, part int, buckets binary, counts binary"
    found = common.map_rows(part.withColumn("_part", F.col("_part").cast("int")), make, schema).collect()
    found = sorted((r for r in found if r["buckets"]), key=lambda r: (str(r["doc_id"]), r["lang"], r["buckets"]))
    langs = sorted({r["lang"] for r in found})
    if not langs:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))
    rows = []
    for r in found:
        at = np.frombuffer(r["buckets"], "<u2").astype(np.int64)
        rows.append((at, tf_idf(at, np.frombuffer(r["counts"], "<f4").astype(np.float64), idf)))
    labels = np.array([langs.index(r["lang"]) for r in found])
    unseen = np.array([r["part"] == 0 for r in found])
    if unseen.all() or not unseen.any():
        unseen[:] = False
    weights, bias = fit([x for x, u in zip(rows, unseen) if not u], labels[~unseen], len(langs), s)
    model = Model(langs, idf, weights, bias)
    if unseen.any():
        logits = np.array([model.logits(*x) for x, u in zip(rows, unseen) if u])
        model.temperature = fit_temperature(logits, labels[unseen])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[..., tuple]:
        m = sent.value
        return lambda doc_id, text: (doc_id, *m.predict(text))

    return common.map_rows(docs.select("doc_id", "text"), make, "doc_id bigint, lang_pred string, score double")


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    model = train(docs.filter(fold(3) != 1))
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
