"""Secret scans: fixed shapes, and character Markov models for other random strings.

Two models of character pairs are trained from labelled samples: random strings
(secrets that the fixed shapes found, and strings drawn from common alphabets by
seed) and ordinary identifiers (long words of the documents outside such finds,
such words joined as paths and names in code by seed, and plain numbers). Both are
mixed with models of classes of characters (small and capital letters, digits,
separators), so a pair that no sample has, as words of other documents do, is no
evidence as such; that digits and capitals alternate is.
A candidate, a long run of identifier characters outside base finds, is reported
as kind `markov` when the log-likelihood ratio of the two models, per character,
exceeds the margin and the whole ratio exceeds the least evidence. Of a run that
does not, the parts between two of + / _ - = that do are reported, so ordinary
words beside a random string do not hide it. A UUID is a random string and is
reported: keys have that form, too.

Base finds are never dropped. Null text counts as empty and has no spans; a very
long one is read whole, in time linear in its length but for runs without a blank
that are cut in many places. Ids, nulls and repeated rows of doc_id pass through as
they are, rows with equal texts get equal spans (ties need no order), and an empty
table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common

#: The base kinds, their patterns (pattern, group that is measured, least length).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 8, "access": 16, "hex": 32}

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
Span = tuple[int, int, str]


@dataclass(frozen=True)
class Settings:
    """margin: nats per character; evidence: nats in all.

    At most about `sample_docs` documents (chosen by a hash of doc_id) give training
    samples, and each gives at most `per_doc` of either label, spread over its text;
    a sample longer than 256 characters counts with its first 256. drawn: random strings,
    numbers and joined words each. mix: the weight of the models of classes.
    """

    margin: float = 0.5
    evidence: float = 12.0
    sample_docs: int = 4000
    per_doc: int = 20
    drawn: int = 3000
    mix: float = 0.2
    seed: int = 7


class Base:
    """The fixed shapes, compiled once per task."""

    def __init__(self) -> None:
        self.assign = re.compile(ASSIGN, re.I | re.A)
        self.access = re.compile(ACCESS)
        # a maximal run of 32 or more is what the greedy leftmost pattern finds
        self.hex = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])

    def spans(self, text: str) -> list[Span]:
        found = [(m.start(), m.end(), "assign") for m in self.assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
        if "AKIA" in text:
            found += [(m.start(), m.end(), "access") for m in self.access.finditer(text) if len(m[0]) >= LEAST["access"]]
        found += [(m.start(), m.end(), "hex") for m in self.hex.finditer(text)]
        return ordered(found)


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def class_model(counts: np.ndarray) -> np.ndarray:
    """Probabilities from pair counts with all characters of a class taken as one; a row for each character and the start."""
    own = CLASS[:-1]
    rows, columns = np.eye(CLASS.max() + 1)[CLASS], np.eye(own.max() + 1)[own]
    pairs = rows.T @ counts @ columns + 0.5
    return (pairs / pairs.sum(axis=1, keepdims=True))[CLASS][:, own] / columns.sum(axis=0)[own]


class PairModel:
    """Log-probabilities of each character after the one before; other characters share a place."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = log_p

    @staticmethod
    def codes(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
        return CODE[raw]

    @classmethod
    def train(cls, samples: Iterable[str], mix: float = 0.2) -> PairModel:
        n = len(ALPHABET) + 1
        counts = np.zeros((n + 1, n))
        for s in samples:
            c = cls.codes(s)
            if len(c):
                np.add.at(counts, (np.concatenate([[n], c[:-1]]), c), 1)
        classes = class_model(counts)
        seen = (counts + classes) / (counts.sum(axis=1, keepdims=True) + 1)
        return cls(np.log((1 - mix) * seen + mix * classes))

    def each(self, text: str) -> np.ndarray:
        c = self.codes(text)
        return self.log_p[np.concatenate([[len(ALPHABET) + 1], c[:-1]]), c] if len(c) else np.zeros(0)

    def score(self, text: str) -> float:
        return float(self.each(text).sum())


def code_table() -> np.ndarray:
    table = np.full(256, len(ALPHABET), np.int64)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = i
    return table


CODE = code_table()
#: Small letters, capitals, digits, separators, other characters, the start of a string.
CLASS = np.repeat(np.arange(6), [26, 26, 10, len(ALPHABET) - 62, 1, 1])


@dataclass
class Ratio:
    """Random strings against ordinary identifiers."""

    log_ratio: np.ndarray

    @classmethod
    def train(cls, samples: Iterable[tuple[str, int]], mix: float = 0.2) -> Ratio:
        """samples: (string, 1 if random, else 0)."""
        samples = list(samples)
        models = [PairModel.train((s for s, label in samples if label == k), mix) for k in (0, 1)]
        return cls(models[1].log_p - models[0].log_p)

    def each(self, text: str) -> np.ndarray:
        return PairModel(self.log_ratio).each(text)

    def __call__(self, text: str) -> float:
        return PairModel(self.log_ratio).score(text)


def drawn_strings(n: int, seed: int) -> list[tuple[str, int]]:
    """Random strings (1) over common alphabets, and numbers (0), which are account or order ids rather than secrets."""
    rng = np.random.default_rng(seed)
    letters = ALPHABET[:62]
    alphabets = (letters, letters[:26] + letters[52:], letters[26:], "0123456789abcdef", ALPHABET[:64])

    def draw(alphabet: str) -> str:
        return "".join(rng.choice(list(alphabet), size=int(rng.integers(16, 48))))

    return [(draw(alphabets[k % len(alphabets)]), 1) for k in range(n)] + [(draw("0123456789"), 0) for _ in range(n)]


def joined_words(samples: Iterable[tuple[str, int]], n: int, seed: int) -> list[tuple[str, int]]:
    """Ordinary identifiers (0): words of ordinary samples, cut short, as paths, with _ or -, and with capitals; some numbered."""
    words = sorted({w.lower() for s, label in samples if label == 0 for w in re.findall(r"[A-Za-z]{3,}", s)})
    if not words:
        return []
    rng = np.random.default_rng(seed + 1)

    def word() -> str:
        short = words[int(rng.integers(len(words)))][: int(rng.integers(3, 11))]
        return short + (str(rng.integers(100)) if rng.random() < 0.1 else "")

    def draw(style: int) -> str:
        parts = [word() for _ in range(int(rng.integers(2, 9)))]
        return "".join(p.title() for p in parts) if style == 3 else "/_-"[style].join(parts)

    return [(draw(k % 4), 0) for k in range(n)]


def candidates(text: str, base: list[Span], find: Callable) -> list[tuple[int, int]]:
    """Long runs of identifier characters that overlap no base span."""
    out, k = [], 0
    for m in find(text):
        start, end = m.span()
        while k < len(base) and base[k][1] <= start:
            k += 1
        j = k
        while j < len(base) and base[j][0] < end and base[j][1] <= start:
            j += 1
        if j == len(base) or base[j][0] >= end:
            out.append((start, end))
    return out


def outside(text: str, base: list[Span], find: Callable) -> list[tuple[int, int]]:
    """Long runs of identifier characters, without the parts that base spans cover."""
    out, k, least = [], 0, 16
    for m in find(text):
        start, end = m.span()
        while k < len(base) and base[k][1] <= start:
            k += 1
        j = k
        while j < len(base) and base[j][0] < end:
            if base[j][0] - start >= least:
                out.append((start, base[j][0]))
            start = max(start, base[j][1])
            j += 1
        if end - start >= least:
            out.append((start, end))
    return out


def labelled_samples(docs: DataFrame, s: Settings) -> DataFrame:
    """(string, label): base finds are random (1), other long words ordinary (0)."""
    rows = docs.count()
    share = min(1.0, s.sample_docs / max(rows, 1))
    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + (share >= 1))

    def make() -> Callable[..., list[tuple]]:
        base, word = Base(), re.compile(r"[A-Za-z0-9+/_=-]{8,}")
        value = re.compile(r"[A-Za-z0-9+/_=-]{8,}$")

        def spread(items: list[str]) -> list[str]:
            return items[:: max(1, -(-len(items) // s.per_doc))]

        def rows_of(texts: list) -> list[tuple]:
            out = []
            for text in texts:
                text = text or ""
                spans = base.spans(text)
                tails = (value.search(text[a:b]) for a, b, _ in spans)
                out += [(t[0][:256], 1) for t in spread([t for t in tails if t])]
                plain = [text[a:b] for a, b in candidates(text, spans, word.finditer)]
                out += [(w[:256], 0) for w in spread(plain)]
            return out

        return rows_of

    return common.map_batches(part.select("text"), make, "string string, label int")


def train(docs: DataFrame, s: Settings = Settings()) -> Ratio:
    # the sample is drawn by doc_id; where many rows share one, this bound holds
    most = 4 * s.sample_docs * s.per_doc
    sample = labelled_samples(docs, s).orderBy(F.xxhash64("string"), "string", "label").limit(most)
    found = [(r["string"], r["label"]) for r in sample.collect()]
    found.sort()  # the same model in whatever order tasks end
    return Ratio.train(found + drawn_strings(s.drawn, s.seed) + joined_words(found, s.drawn, s.seed), s.mix)


class Scanner:
    def __init__(self, ratio: Ratio, s: Settings):
        self.base, self.ratio, self.s = Base(), ratio, s
        self.find = re.compile(CANDIDATE).finditer
        self.cut = re.compile(r"[+/_=-]").finditer

    def __call__(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans)."""
        base = self.base.spans(text)
        more = []
        for start, end in outside(text, base, self.find):
            more += [(start + a, start + b, "markov") for a, b in self.random_parts(text[start:end])]
        return base, ordered(base + more) if more else base

    def random_parts(self, run: str) -> list[tuple[int, int]]:
        """The whole run if it is random enough, else the parts between separators that exceed the margin most."""
        each = self.ratio.each(run)
        r = each.sum()
        if r > self.s.evidence and r > self.s.margin * len(run):
            return [(0, len(run))]
        cuts = np.array([m.start() for m in self.cut(run)], np.int64)
        if not len(cuts):
            return []
        begins, ends = np.append(0, cuts + 1), np.append(cuts, len(run))  # of the pieces
        total = np.append(0.0, np.cumsum(each))
        beyond = np.append(0.0, np.cumsum(each - self.s.margin))
        out, left = [], [(0, len(begins))]
        while left:
            i, j = left.pop()
            low = np.minimum.accumulate(beyond[begins[i:j]])
            last = i + int((beyond[ends[i:j]] - low).argmax())
            first = i + int(beyond[begins[i : last + 1]].argmin())
            a, b = int(begins[first]), int(ends[last])
            if beyond[b] <= beyond[a] or total[b] - total[a] <= self.s.evidence:
                continue  # no other part has more evidence beyond its margin
            if b - a >= 16:
                out.append((a, b))
            left += [(x, y) for x, y in ((i, first), (last + 1, j)) if x < y]
        return sorted(out)


def scan(docs: DataFrame, ratio: Ratio, s: Settings = Settings()) -> DataFrame:
    """doc_id, spans (array of start, end, kind; code points, end exclusive)."""

    def make() -> Callable[..., tuple]:
        scanner = Scanner(ratio, s)
        return lambda doc_id, text: (doc_id, [{"start": a, "end": b, "kind": k} for a, b, k in scanner(text or "")[1]])

    spans = "array<struct<start: bigint, end: bigint, kind: string>>"
    return common.map_rows(docs.select("doc_id", "text"), make, f"doc_id bigint, spans {spans}")


def digests(docs: DataFrame, ratio: Ratio, s: Settings = Settings()) -> DataFrame:
    """doc_id, counts of base kinds, SHA-256 of base spans, all spans as a string."""

    def make() -> Callable[..., tuple]:
        scanner = Scanner(ratio, s)

        def row(doc_id: int | None, text: str | None) -> tuple:
            base, every = scanner(text or "")
            kinds = [k for _, _, k in base]
            counts = [kinds.count(k) for k in KINDS[:3]]
            return doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)

        return row

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return common.map_rows(docs.select("doc_id", "text"), make, schema)


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return digests(docs, train(docs))
