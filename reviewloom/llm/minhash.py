"""Near-duplicates: universal hash minima, banding, signature verification, exact confirmation, components.

Two documents are linked when the Jaccard similarity of their sets of word
shingles reaches a given percentage. No group of similar documents is ever
gathered in one task, and no list of all pairs in a group is made:

1. Documents with equal sets are one class, represented by the smallest doc_id.
2. Each representative gets many hash minima; bands of them are bucket keys.
3. Every bucket has a centre, the member that shares most buckets with others.
   Members are checked against it: by signature, then on the full sets.
4. Components of these links settle most buckets. What is left in a bucket, the
   members outside the centre's component, is compared with all its members, in
   blocks of bounded size. Members whose signatures may reach the similarity of
   a member of another component bring their full sets there, and a block reports
   a spanning forest of the components it links: as many rows as members at most,
   however many pairs are near.
5. Components of all links give each document the smallest doc_id it can reach.

A link is found unless all bands miss it or its signature deviates by 4.5 standard
deviations: at exactly 85 % and the default settings 2e-8 and 3.4e-6, above it less.

Null texts and texts without words have an empty set and are linked with nothing.
Rows of equal doc_id are one document that has all their sets. Rows without
doc_id are never linked: component_id is null, kept is true. Other columns are
ignored by `near_duplicates` and kept by `filter_documents`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common
from reviewloom.llm.components import components


@dataclass(frozen=True)
class Settings:
    """words: words of a shingle; percent: least similarity; block: members compared in one task."""

    words: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 4
    hashes: int = 640
    block: int = 512
    seed: int = 11

    @property
    def least_equal(self) -> int:
        """Equal places of two signatures below which the similarity is out of reach."""
        p = self.percent / 100
        return int(self.hashes * (p - 4.5 * (p * (1 - p) / self.hashes) ** 0.5))


class Hashes(dict):
    """Word to a 64-bit hash; forgets all when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


MAX_BANDS = 64
#: Bits of the filter in front of a join: 1 MB.
FILTER_BITS = 1 << 23
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, n: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles.

    Only A-Z are lower-cased, and words end at \\x20 and \\x09-\\x0D; both hold for bytes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))  # fewer words: all of them are one shingle
    key = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        key = (key ^ h[k : len(h) - n + 1 + k]) * MIX
        key ^= key >> np.uint64(32)
    return np.unique(key)


class Signer:
    """Minima of universal hashes a * x + b modulo 2^32."""

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        self.s = s
        self.a = (rng.integers(0, 1 << 31, s.hashes, np.uint32) * 2 + 1).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, s.hashes, np.uint32)[:, None]

    def minima(self, x: np.ndarray, step: int = 512) -> np.ndarray:
        x = (x >> np.uint64(32)).astype(np.uint32)
        out = np.full(self.s.hashes, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), step):
            np.minimum(out, (self.a * x[i : i + step] + self.b).min(axis=1), out=out)
        return out

    def bands(self, minima: np.ndarray) -> list[int]:
        """Hashes of the bands' minima; the lowest bits say which band it is."""
        r = self.s.rows
        hashed = (xxhash.xxh64_intdigest(minima[r * k : r * k + r].tobytes()) for k in range(self.s.bands))
        return [(h // MAX_BANDS * MAX_BANDS + k) - (1 << 63) for k, h in enumerate(hashed)]

    @staticmethod
    def signature(minima: np.ndarray) -> bytes:
        """One byte of each minimum."""
        return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n (set size), digest (of the set; null if empty), keys (of bands), sig, row (unique)."""

    def make() -> Callable[..., tuple]:
        signer, hashes = Signer(s), Hashes()

        def row(doc_id: int | None, text: str | None) -> tuple:
            x = shingles(text, s.words, hashes)
            if not len(x):
                return doc_id, 0, None, [], b""
            m = signer.minima(x)
            return doc_id, len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(), signer.bands(m), signer.signature(m)

        return row

    schema = "doc_id bigint, n bigint, digest binary, keys array<bigint>, sig binary"
    made = common.map_rows(docs.select("doc_id", "text"), make, schema)
    return common.kept_table(made.withColumn("row", F.monotonically_increasing_id()))


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1, dtype=np.int16)


def matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, width)


def may_be_among(ids: DataFrame, column: str) -> Callable[[str], Column]:
    """A test that is true for all ids of a table and for few others: a Bloom filter of bounded size.

    Bits are set by two hashes and merged by Spark; at most FILTER_BITS / 64 words come to the driver.
    """
    bits = F.explode(F.array(*(F.pmod(F.xxhash64(column, F.lit(k)), F.lit(FILTER_BITS)) for k in (1, 2))))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("bit", F.lit(64)).cast("int"))
    words = ids.select(bits.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(bit).alias("set"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    found = words.toPandas()
    table[found["word"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)

    @F.pandas_udf("boolean")
    def is_set(one: pd.Series, two: pd.Series) -> pd.Series:
        hits = [table[x // 64] >> (x % 64) & 1 for x in (one.to_numpy(), two.to_numpy())]
        return pd.Series((hits[0] & hits[1]).astype(bool))

    return lambda c: is_set(*(F.pmod(F.xxhash64(c, F.lit(k)), F.lit(FILTER_BITS)) for k in (1, 2)))


def having(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of df whose column is among ids, or with how="left_anti" is not.

    Only rows that a Bloom filter of the ids lets through are shuffled, at any number of ids.
    """
    ids = common.kept_table(ids.toDF(column).distinct())
    maybe = may_be_among(ids, column)(column)
    if how == "left_semi":
        return df.filter(maybe).join(ids, column, how)
    return df.filter(~maybe).unionAll(df.filter(maybe).join(ids, column, how).select(*df.columns))


def promising(pairs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures do not rule the similarity out. pairs is a written table."""
    reps = having(reps, "id", pairs.select(F.explode(F.array("a", "b"))))
    side = lambda c: reps.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"sig{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    near = 100 * F.least("na", "nb") >= s.percent * F.greatest("na", "nb")

    @F.pandas_udf("int")
    def equal(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(alike(matrix(x, s.hashes), matrix(y, s.hashes)) if len(x) else [], dtype="int32")

    return both.filter(near).filter(equal("siga", "sigb") >= s.least_equal).select("a", "b")


def sets_of(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """(id, x) of these documents: their distinct sets."""

    def make() -> Callable[..., tuple]:
        hashes = Hashes()
        return lambda doc_id, text: (doc_id, shingles(text, s.words, hashes).view(np.int64).tolist())

    texts = having(docs.select("doc_id", "text"), "doc_id", ids)
    sets = common.kept_table(common.map_rows(texts, make, "id bigint, x array<bigint>"))
    again = sets.groupBy("id").count().filter("count > 1")
    return sets if again.isEmpty() else common.kept_table(sets.dropDuplicates(["id", "x"]))


def confirmed(pairs: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets reach the similarity. pairs is a written table."""
    sets = sets_of(docs, pairs.select(F.explode(F.array("a", "b"))), s)
    side = lambda c: sets.select(F.col("id").alias(c), F.col("x").alias(f"x{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    shared = F.size(F.array_intersect("xa", "xb"))
    return both.filter(100 * shared >= s.percent * (F.size("xa") + F.size("xb") - shared)).select("a", "b")


def unsettled(members: DataFrame, centres: DataFrame, found: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """Members that may be linked to one of another component in their bucket, in the blocks where both are.

    A block has a share of a bucket's open members, the probes, and a share of all its members.
    """
    comp = found.select(F.col("node").alias("id"), "component")
    large = members.filter("cnt > 2").join(centres, "key").join(comp, "id", "left")
    large = large.withColumn("component", F.coalesce("component", "id"))
    home = found.select(F.col("node").alias("centre"), F.col("component").alias("home"))
    placed = large.join(home, "centre", "left").withColumn(
        "open", F.col("component") != F.coalesce("home", "centre")
    )
    placed = common.kept_table(placed.select("key", "id", "component", "cnt", "open"))
    left = placed.filter("open").groupBy("key").agg(F.count("*").alias("left"))
    rows = common.kept_table(placed.join(left, "key"))
    rows = rows.join(having(reps.select("id", "n", "sig", "keys"), "id", rows.select("id")), "id")
    blocks = F.ceil(F.col("cnt") / s.block).cast("int")
    chunks = F.ceil(F.col("left") / s.block).cast("int")
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), n).cast("int")
    columns = ["key", "id", "component", "n", "sig", "keys"]
    every = rows.select(*columns, F.lit(False).alias("probe"), place(blocks, 1).alias("block"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    probes = rows.filter("open").select(*columns, F.lit(True).alias("probe"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), place(chunks, 2).alias("chunk"))

    layout = f"{BLOCK}, {', '.join(f'{c} {reps.schema[c].dataType.simpleString()}' for c in ('n', 'sig', 'keys'))}"
    in_blocks = common.kept_table(every.unionByName(probes))

    def near_members(group: pd.DataFrame) -> pd.DataFrame:
        """The members that have a near one, once each as probe and as member."""
        a, b = group[group.probe], group[~group.probe]
        hits = [(i, j) for i, j in enumerate(near_rows(a, b, s)) if len(j)] if len(a) and len(b) else []
        used = [a.iloc[[i for i, _ in hits]], b.iloc[np.unique(np.concatenate([j for _, j in hits])) if hits else []]]
        return pd.concat(used)[group.columns]

    near = in_blocks.groupBy("key", "block", "chunk").applyInPandas(near_members, layout)
    return common.kept_table(near)


BLOCK = "key bigint, id bigint, component bigint, probe boolean, block int, chunk int"


def near_rows(a: pd.DataFrame, b: pd.DataFrame, s: Settings) -> list[np.ndarray]:
    """For each probe of a, the rows of b in other components whose sizes and signatures do not rule the similarity out."""
    sa, sb = matrix(a.sig, s.hashes), matrix(b.sig, s.hashes)
    ka, kb = np.stack(a["keys"].to_list()), np.stack(b["keys"].to_list())
    band = int(a.key.iloc[0]) % MAX_BANDS
    comps, sizes = b.component.to_numpy(), b.n.to_numpy()
    out = []
    for k, (c, n) in enumerate(zip(a.component, a.n)):
        near = np.flatnonzero((comps != c) & (100 * np.minimum(sizes, n) >= s.percent * np.maximum(sizes, n)))
        near = near[alike(sb[near], sa[k]) >= s.least_equal]
        # a pair counts in the first bucket that it shares: by the keys, as bytes of unequal minima may be equal
        out.append(near[~(kb[near, :band] == ka[k, :band]).any(axis=1)])
    return out


def linked(a: pd.DataFrame, b: pd.DataFrame, s: Settings) -> list[tuple[int, int]]:
    """A spanning forest, over components, of the near pairs whose full sets (x) reach the similarity."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    rows = [np.asarray(x, np.int64) for x in b.x]
    flat, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    ends = np.cumsum([len(x) for x in rows])
    places = np.split(inverse, ends[:-1])
    ids, comps = b.id.to_numpy(), b.component.to_numpy()
    sizes, out = np.diff(ends, prepend=0), []
    for probe, component, x, near in zip(a.id, a.component, a.x, near_rows(a, b, s)):
        x = np.asarray(x, np.int64)
        mark = np.zeros(len(flat), bool)
        mark[np.searchsorted(flat, x[np.isin(x, flat)])] = True
        for j in near.tolist():
            if root(comps[j]) == root(component):
                continue
            shared = int(mark[places[j]].sum())
            if 100 * shared >= s.percent * (len(x) + int(sizes[j]) - shared):
                parent[root(comps[j])] = root(component)
                out.append((min(probe, ids[j]), max(probe, ids[j])))
    return out


def links_of_blocks(near: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) between components that the blocks of `near` members hold, no more than a forest each."""
    sets = sets_of(docs, near.select("id"), s)
    rows = near.join(sets, "id")

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        a, b = group[group.probe], group[~group.probe]
        out = linked(a, b, s) if len(a) and len(b) else []
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("key", "block", "chunk").applyInPandas(confirm, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each row of docs."""
    signed = signatures(docs, s)
    known = signed.filter("doc_id IS NOT NULL AND n > 0")
    repeated = bool(signed.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").take(1))
    classes = known.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    classes = common.kept_table(classes.select("digest", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("row")))
    # rows of one class differ in nothing but their ids: all but the first leave
    copies = known.select("digest", "row").join(classes.select("digest", F.col("row").alias("first")), "digest")
    reps = having(known, "row", copies.filter("row != first").select("row"), "left_anti")
    reps = common.kept_table(reps.select(F.col("doc_id").alias("id"), "n", "keys", "sig"))

    banded = reps.select("id", F.explode("keys").alias("key"))
    counts = banded.groupBy("key").agg(F.count("*").alias("cnt")).filter("cnt > 1")
    members = common.kept_table(banded.join(counts, "key"))
    popular = members.groupBy("id").agg(F.sum("cnt").alias("shared"))
    best = F.max(F.struct("shared", (-F.col("id")).alias("minus"))).alias("best")
    centres = members.join(popular, "id").groupBy("key").agg(best).select("key", (-F.col("best.minus")).alias("centre"))
    centres = common.kept_table(centres)
    star = members.join(centres, "key").filter("id != centre").select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")
    )
    star = common.kept_table(star.distinct())
    links = confirmed(common.kept_table(promising(star, reps, s)), docs, s)
    # rows of one doc_id with several sets are one node already; their classes meet in it
    equal = known.join(classes.select("digest", "rep"), "digest").filter("doc_id != rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    ) if repeated else None
    links = common.kept_table(links.unionByName(equal) if repeated else links)
    found = components(links)
    near = unsettled(members, centres, found, reps, s)
    links = links.unionByName(common.kept_table(links_of_blocks(near, docs, s)))
    found = components(links)

    # rows without a set have no class; a key of their own keeps them from meeting in one task
    own = F.coalesce("digest", F.col("row").cast("string").cast("binary")).alias("digest")
    out = signed.select("doc_id", "n", own).join(classes.select("digest", "rep"), "digest", "left")
    rep = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("doc_id") if repeated else F.col("rep"), "doc_id"))
    out = out.withColumn("node", rep).join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def filter_documents(docs: DataFrame, s: Settings = Settings(words=5, percent=80)) -> DataFrame:
    """One document of each component, with all columns; of repeated ids one row, of rows without id all."""
    verdict = common.kept_table(near_duplicates(docs, s))
    left = having(docs, "doc_id", verdict.filter("NOT kept").select("doc_id"), "left_anti")
    again = common.kept_table(verdict.filter("kept").groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"))
    if not again.take(1):
        return left
    once = left.join(common.small(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(common.small(again), "doc_id", "left_anti").unionByName(once.select(*left.columns)).select(*docs.columns)


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(common.table(spark, folder, "documents"))
