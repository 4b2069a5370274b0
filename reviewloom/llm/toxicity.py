"""Toxicity: a convolutional text classifier on hashed word embeddings.

The embedding of a word is the sum of the embeddings of its hash and of the
hashes of its beginnings, so words of one stem share weights. Filters of widths 1
to 3 run over the whole text, each is pooled by its maximum, and a linear layer
gives the logit. All of it is trained in numpy on the driver, on a bounded sample
of labelled rows; embeddings start from how far the label deviates from chance
where their hash occurs. A decision threshold is then calibrated for each
language on all labelled rows that training has not seen, and moved to score 0.5:
texts are read once for their logits and languages, Spark counts labelled rows by
language and binned logit, and these histograms are added up. A language's
threshold is drawn to that of all languages the more, the fewer toxic rows it has.
The language is predicted from the text (`langid`), so neither the score nor the
prediction reads the lang column; its values are used in training only.

Null text counts as empty; a text without words gets the score of a lone blank; a
very long one is read whole. Rows without a label are scored, not learned. Without
labels of both kinds every score is 0. Ids, nulls and repeated rows of doc_id pass
through as they are, and equal texts get equal scores up to rounding of 32-bit
numbers; an empty table gives no rows. A label counts once for each row of its id
in either table. Other columns, whatever their names, are ignored by `scores` and
kept by `filter_documents`.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common, langid

BUCKETS = 1 << 18
STEMS = (4, 5, 6, 7, 8)
FEATURES = 1 + len(STEMS)
EDGES = ".,;:!?\"'()[]{}#*$%&|<>-_/\\~`+=@^"
WIDTHS = (1, 2, 3)
#: Rows of zeros behind each text, so that filters do not reach into the next one.
PAD = max(WIDTHS) - 1
#: Bins of logits between two whole numbers, and the largest logit that has a bin.
BINS, FAR = 64, 30


@dataclass(frozen=True)
class Settings:
    """per_label: about so many rows of either label are drawn by a hash of doc_id; training sees seven tenths of them.

    Where an id repeats in either table, `rows` bounds what training reads. Thresholds come from
    all other labelled rows; a language's own one weighs as much as its toxic rows there, the one
    of all languages as `borrow` of them.
    """

    per_label: int = 2500
    size: int = 8
    filters: int = 8
    epochs: int = 6
    batch: int = 64
    rate: float = 0.02
    rows: int = 20_000
    borrow: int = 10
    seed: int = 3


def word_features(word: str) -> list[int]:
    """Buckets of a word and its beginnings; a missing beginning is bucket 0, which stays zero."""
    w = word.strip(EDGES)
    own = [w] + [w[:n] + "\n" if len(w) >= n else None for n in STEMS]
    return [0 if x is None else 1 + zlib.crc32(x.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) for x in own]


class Words(dict):
    """Word to its number, counted from 1; 0 is the padding."""

    def __init__(self) -> None:
        self.fresh: list[list[int]] = [[0] * FEATURES]

    def __missing__(self, word: str) -> int:
        self.fresh.append(word_features(word))
        self[word] = at = len(self) + 1
        return at

    def of(self, text: str) -> list[int]:
        return [self[w] for w in text.lower().split()]

    def take(self) -> np.ndarray:
        """Features of the words numbered since the last call, in order; they are not kept here."""
        out, self.fresh = np.array(self.fresh, np.int32).reshape(-1, FEATURES), []
        return out


@dataclass
class Net:
    embed: np.ndarray  # buckets x size
    kernels: list[np.ndarray]  # per width: width x size x filters
    bias: list[np.ndarray]  # per width: filters
    out: np.ndarray  # widths * filters
    out_bias: float

    def pooled(self, x: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """Filter outputs of each width over concatenated, padded embeddings."""
        made = []
        for w, k, b in zip(WIDTHS, self.kernels, self.bias):
            y = np.zeros((len(x), k.shape[2]), np.float32)
            for j in range(w):
                y[: len(x) - j] += x[j:] @ k[j]
            made.append(y + b)
        return made


@dataclass
class Model:
    net: Net | None
    languages: langid.Model
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.0


def joined(docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, a lone blank if there are none, each with its padding; the place where each begins."""
    flat: list[int] = []
    starts = []
    for d in docs:
        starts.append(len(flat))
        flat += d or [0]
        flat += [0] * PAD
    return np.array(flat, np.int64), np.array(starts, np.int64)


def first_embedding(
    docs: list[np.ndarray], features: np.ndarray, labels: np.ndarray, size: int, rng: np.random.Generator
) -> np.ndarray:
    """Small random numbers; in the first place how surprising a bucket's share of toxic rows is."""
    n, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, labels):
        at = np.unique(features[d])
        n[at] += 1
        toxic[at] += y
    share = labels.mean()
    z = (toxic - n * share) / np.sqrt(n * share * (1 - share) + 2)
    embed = rng.standard_normal((BUCKETS, size), np.float32) * np.float32(0.02)
    embed[:, 0] = np.clip(z, -4, 12) / 6
    embed[0] = 0
    return embed


def fit(docs: list[np.ndarray], features: np.ndarray, labels: np.ndarray, s: Settings) -> Net:
    """docs: word numbers; features: the buckets of each number. Adagrad on the log-loss, labels weighed alike."""
    rng = np.random.default_rng(s.seed)
    kernels = [rng.normal(0, 0.2, (w, s.size, s.filters)).astype(np.float32) for w in WIDTHS]
    for k in kernels:
        k[0, 0, 0] = 1.0  # one filter of each width begins as a detector of surprising words
    net = Net(
        first_embedding(docs, features, labels, s.size, rng), kernels,
        [np.zeros(s.filters, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, len(WIDTHS) * s.filters).astype(np.float32), -1.0,
    )
    net.out[:: s.filters] = 0.5
    seen = {id(a): np.full_like(a, 0.1) for a in (net.embed, net.out, *net.kernels, *net.bias)}
    seen_out_bias = 0.1
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))

    def step(a: np.ndarray, g: np.ndarray) -> None:
        h = seen[id(a)]
        h += g * g
        a -= s.rate * g / np.sqrt(h)

    for _ in range(s.epochs):
        order = rng.permutation(len(docs))
        for i in range(0, len(order), s.batch):
            own = order[i : i + s.batch]
            flat, starts = joined([docs[d].tolist() for d in own])
            sizes = np.diff(np.append(starts, len(flat))) - PAD
            used, place_of = np.unique(flat, return_inverse=True)
            x = net.embed[features[used]].sum(axis=1)[place_of]
            # where each filter is largest in each text
            peaks, values = [], []
            for y in net.pooled(x, starts):
                at = np.array([a + y[a : a + n].argmax(axis=0) for a, n in zip(starts, sizes)])
                peaks.append(at)
                values.append(np.take_along_axis(y, at, axis=0))
            v = np.concatenate(values, axis=1)
            active = v > 0
            r = np.where(active, v, 0)
            p = 1 / (1 + np.exp(-(r @ net.out + net.out_bias)))
            d = ((p - labels[own]) * weight[own] / len(own)).astype(np.float32)
            dv = d[:, None] * net.out * active
            g_out = r.T @ d + 1e-4 * net.out
            places, grads = [], []
            for n, (w, at, kernel, bias) in enumerate(zip(WIDTHS, peaks, net.kernels, net.bias)):
                dy = dv[:, n * s.filters : (n + 1) * s.filters]
                g = np.zeros_like(kernel)
                for j in range(w):
                    to = np.minimum(at + j, len(x) - 1)
                    g[j] = np.einsum("bfs,bf->sf", x[to], dy)
                    places.append(to.ravel())
                    grads.append((dy[:, :, None] * kernel[j].T[None]).reshape(-1, s.size))
                step(kernel, g + 1e-4 * kernel)
                step(bias, dy.sum(axis=0))
            step(net.out, g_out)
            gb = float(d.sum())
            seen_out_bias += gb * gb
            net.out_bias -= s.rate * gb / np.sqrt(seen_out_bias)
            place, grad = np.concatenate(places), np.concatenate(grads)
            hit = np.abs(grad).sum(axis=1) > 0
            buckets, at = np.unique(features[flat[place[hit]]], return_inverse=True)
            g = np.zeros((len(buckets), s.size), np.float32)
            np.add.at(g, at.reshape(-1, FEATURES), grad[hit][:, None, :])
            g[buckets == 0] = 0
            h = seen[id(net.embed)]
            h[buckets] += g * g
            net.embed[buckets] -= s.rate * g / np.sqrt(h[buckets])
    return net


class Scorer:
    """Logits of texts; keeps what each filter says of each word seen so far."""

    def __init__(self, net: Net, max_words: int = 50_000):
        self.net, self.max_words = net, max_words
        self.clear()

    def clear(self) -> None:
        self.words = Words()
        width = sum(k.shape[0] * k.shape[2] for k in self.net.kernels)
        self.said = np.zeros((0, width), np.float32)

    def grow(self) -> None:
        fresh = self.words.take()
        if len(fresh):
            x = self.net.embed[fresh].sum(axis=1)
            said = np.concatenate([x @ k[j] for k in self.net.kernels for j in range(len(k))], axis=1)
            self.said = np.concatenate([self.said, said])

    def logits(self, texts: list[str]) -> np.ndarray:
        if len(self.words) > self.max_words:
            self.clear()
        flat, starts = joined([self.words.of(t) for t in texts])
        self.grow()
        ends = np.append(starts[1:], len(flat))
        padding = np.concatenate([ends - 1 - j for j in range(PAD)])
        pooled, column = [], 0
        for k, b in zip(self.net.kernels, self.net.bias):
            w, _, f = k.shape
            y = np.zeros((len(flat), f), np.float32)
            for j in range(w):
                y[: len(flat) - j] += self.said[flat[j:], column : column + f]
                column += f
            y[padding] = -np.inf  # a filter that begins there reaches into the next text
            pooled.append(np.maximum.reduceat(y, starts, axis=0) + b)
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.out + self.net.out_bias


def best_threshold(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The middle of the range of thresholds with the highest F1, from the weights of toxic and clean rows per bin.

    bins: ascending numbers of bins of width 1 / BINS; all rows of a bin are on one side.
    """
    z, hit, said = bins[::-1], np.cumsum(toxic[::-1]), np.cumsum((toxic + clean)[::-1])
    k = int((2 * hit / (said + toxic.sum())).argmax())
    return float(z[k] + z[k + 1] + 1) / (2 * BINS) if k + 1 < len(z) else float(z[k]) / BINS - 1


def language_model(rows: list[tuple[str, str]]) -> langid.Model:
    """From (text, lang) of sample rows; their own document frequencies."""
    counted = [(langid.counts(t), lang) for t, lang in rows if lang is not None]
    counted = [(c, lang) for c, lang in counted if len(c[0])]
    langs = sorted({lang for _, lang in counted})
    df = np.zeros(langid.BUCKETS)
    for (at, _), _ in counted:
        df[at] += 1
    idf = np.log((1 + len(counted)) / (1 + df)) + 1
    if not langs:
        return langid.Model([], idf, np.zeros((langid.BUCKETS, 0)), np.zeros(0))
    x = [(at, langid.tf_idf(at, n, idf)) for (at, n), _ in counted]
    weights, bias = langid.fit(x, np.array([langs.index(lang) for _, lang in counted]), len(langs), langid.Settings())
    return langid.Model(langs, idf, weights, bias)


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0 or 1)."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1) AND doc_id IS NOT NULL")


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[Model, DataFrame | None]:
    """A model without thresholds, from a bounded sample, and the ids it learned from (None: too few to set any aside)."""
    sample = langid.sample_rows(known_labels(labels), "toxic", s.per_label)  # bounded, so it may be broadcast
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(sample), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(s.rows).collect()
    rows = sorted(((r["doc_id"], r["text"] or "", r["lang"], r["toxic"], r["_part"]) for r in rows), key=str)
    y = np.array([r[3] for r in rows], np.float64)
    languages = language_model([(t, lang) for _, t, lang, _, part in rows if part >= 7])
    if not len(rows) or y.min() == y.max():
        return Model(None, languages), None
    learned = np.array([r[4] >= 3 for r in rows])
    enough = len(set(y[learned])) == 2 and len(set(y[~learned])) == 2
    if not enough:
        learned[:] = True
    words = Words()
    numbers = [np.array(words.of(r[1]), np.int32) for r in rows]
    net = fit([n for n, u in zip(numbers, learned) if u], words.take(), y[learned], s)
    return Model(net, languages), sample.filter("_part >= 3").select("doc_id") if enough else None


def marks_udf(spark: SparkSession, model: Model) -> Callable:
    """A Spark function from text to its logit (null without a net) and predicted language."""
    sent = spark.sparkContext.broadcast(model)

    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.give_back()
        own = sent.value
        scorer = Scorer(own.net) if own.net is not None else None

        def run(part: pa.Array) -> list[dict]:
            texts = [t or "" for t in part.to_pylist()]
            if scorer is None:
                return [{"logit": None, "lang": langid.UNKNOWN}] * len(texts)
            return [{"logit": float(z), "lang": own.languages.predict(t)[0]} for z, t in zip(scorer.logits(texts), texts)]

        try:
            for batch in batches:
                parts = [pa.array(run(part), kind) for part in common.array_slices(batch, 100)]
                yield pa.concat_arrays(parts) if parts else pa.array([], kind)
        finally:
            scorer = None
            common.give_back()

    kind = pa.struct([("logit", pa.float64()), ("lang", pa.string())])
    mark.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(mark, "logit double, lang string")


def calibrate(model: Model, marked: DataFrame, labels: DataFrame, learned: DataFrame | None, s: Settings) -> None:
    """Set the thresholds. marked: doc_id, mark (logit, lang); learned: ids that training has seen.

    The driver gets one row for each language, label and bin. Rows of a label weigh as if
    training had taken none of them.
    """
    if model.net is None:
        return
    known = known_labels(labels)
    held = known if learned is None else known.join(F.broadcast(learned.distinct()), "doc_id", "left_anti")
    logit = F.greatest(F.least(F.col("mark.logit"), F.lit(float(FAR))), F.lit(-float(FAR)))
    counts = (
        marked.select("doc_id", F.col("mark.lang").alias("lang"), F.floor(logit * BINS).alias("bin")).join(held, "doc_id")
        .groupBy("lang", "toxic", "bin").agg(F.count("*").alias("n")).toPandas()
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = counts.groupby("toxic")["n"].sum()
    if len(rows) < 2:
        return

    def threshold(part: pd.DataFrame) -> float:
        table = part.pivot_table(index="bin", columns="toxic", values="n", aggfunc="sum", fill_value=0).sort_index()
        weight = [table[y].to_numpy() * (sizes[y] / rows[y]) for y in (1, 0)]
        return best_threshold(table.index.to_numpy(), *weight)

    model.default = threshold(counts)
    for lang, part in counts.groupby("lang"):
        n = part.loc[part.toxic == 1, "n"].sum()
        if n and (part.toxic == 0).any():
            model.thresholds[lang] = (n * threshold(part) + s.borrow * model.default) / (n + s.borrow)


def score_column(model: Model, mark: Column) -> Column:
    """From a mark: the logit less the threshold of its language, as a probability."""
    if model.net is None:
        return F.lit(0.0)
    line = F.lit(model.default)
    for lang, at in sorted(model.thresholds.items()):
        line = F.when(mark["lang"] == lang, F.lit(at)).otherwise(line)
    moved = mark["logit"] - line
    return 1 / (1 + F.exp(-F.greatest(F.least(moved, F.lit(float(FAR))), F.lit(-float(FAR)))))


def marked_rows(docs: DataFrame, model: Model, *columns: str | Column) -> DataFrame:
    """The columns and mark, written once to the shared folder: texts are read once and never shuffled."""
    return common.kept_table(docs.select(*columns, marks_udf(docs.sparkSession, model)("text").alias("mark")))


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """docs: doc_id, text, lang; labels: doc_id, toxic (0, 1 or null)."""
    model, learned = learn(docs, labels, s)
    if model.net is not None:
        calibrate(model, marked_rows(docs, model, "doc_id"), labels, learned, s)
    return model


def scored(marked: DataFrame, model: Model) -> DataFrame:
    rows = marked.select("doc_id", score_column(model, F.col("mark")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of a trained model."""
    return scored(docs.select("doc_id", marks_udf(docs.sparkSession, model)("text").alias("mark")), model)


def learn_and_score(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """As scores(docs, train(docs, labels)), with one pass over the texts for thresholds and scores."""
    model, learned = learn(docs, labels, s)
    marked = marked_rows(docs, model, "doc_id")
    calibrate(model, marked, labels, learned, s)
    return scored(marked, model)


def filter_documents(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents below score 0.5, learned from the labelled ones among them; columns unchanged."""
    model, learned = learn(docs, labels, s)
    marked = marked_rows(docs, model, common.whole_row(docs), "doc_id")
    calibrate(model, marked, labels, learned, s)
    return marked.filter(score_column(model, F.col("mark")) < 0.5).select("_row.*")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    held_out = F.coalesce(langid.fold(5) == 0, F.lit(False))
    rows = learn_and_score(docs, labels.filter(langid.fold(5) != 0))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")
