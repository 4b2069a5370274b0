"""Cut passages out of texts that stood earlier in the corpus, to the byte, by suffix sorting.

A window is a string of `length` bytes. It goes with the least hash of the grams it holds, so
equal windows go with equal hashes wherever they stand, and neighbouring windows mostly with
the same one: such a run is a stretch. Stretches, not windows, are compared first:

1. Each run of texts lists its stretches as (gram, digest of the stretch, place), packed into
   one row per bucket of grams. A stretch whose digest stands earlier is a repeat as a whole.
   Of stretches with a gram in common but different bytes, windows may be equal: these are left.
2. The bytes of what is left are sorted by gram, and the suffixes at its windows are put in
   order by multikey quicksort and blind tries. The first of equal windows stays.
3. A gram of too many different stretches (a line that stands in a third of all texts) is not
   sorted in one place: its windows go on to longer grams, in the end to themselves.

Texts move once, into a table bucketed by document, which all steps join without moving them
again. Copies meet in their run of texts first, so a passage that all texts share sends one
row for each run.

Null texts are empty. Documents are ordered by id, null first; ones of the same id, or without
one, by a hash of their text, and rows with equal id and text count as one document, so they
have the same result. An id of -2^63 counts as null. Empty and short texts and an empty table
have no windows. Long texts are cut into windows like any others. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common
from reviewloom.llm.common import slices
from reviewloom.llm.suffix_sort import deep_shallow

NO_ID = -(2**63)
REPEAT, LEFT, CROWDED = 1, 2, 3  # states of a stretch
MANY, SPREAD = 2, 3  # marks of stretches of a gram with too many in a run: one that says so, the others
FOUND = "id bigint, tie bigint, start int, n int, state tinyint, gram bigint"
SPAN = "array<struct<start:int,n:int>>"
_RANDOM = np.random.default_rng(13).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Settings:
    length: int = 100
    grams: tuple[int, ...] = (32, 64)  # then the window itself
    crowd: int = 16  # different stretches of a gram in one run of texts
    group: int = 4096  # different stretches of a gram sorted together
    text_bytes: int = 1 << 20  # texts hashed at a time
    run: int = 400_000  # stretches of one run of texts
    bucket_bytes: int = 64 << 20  # bytes of text behind a bucket
    sort_bytes: int = 2 << 20  # bytes of stretches sorted at a time


# --- windows, grams, stretches ----------------------------------------------------


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k bytes from every position on: polynomials, doubled in length, then mixed."""
    part, size, power = _RANDOM[data], 1, np.uint64(0x9E3779B97F4A7C15)
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if out is None:
                    out = part
                else:
                    n = len(data) - done - size + 1
                    out = out[:n] * power + part[done : done + n]
                done += size
            if size * 2 > k:
                break
            part = part[:-size] * power + part[size:]
            power, size = power * power, size * 2
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))


def sliding(a: np.ndarray, w: int, better: np.ufunc) -> np.ndarray:
    """Least or largest of every w neighbours."""
    size = 1
    while size * 2 <= w:
        a, size = better(a[:-size], a[size:]), size * 2
    return better(a[: len(a) - (w - size)], a[w - size :]) if w > size else a


def stretches(data: np.ndarray, first: np.ndarray, last: np.ndarray, k: int, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with the same least gram hash; windows begin in [first, last) of the bytes."""
    if len(data) < length:
        data, first, last = np.zeros(length, np.uint8), first[:0], last[:0]
    w = length - k + 1
    hashes = gram_hashes(data, k)
    least = sliding(hashes, w, np.minimum)
    step = np.zeros(len(least) + 1, np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, last, -1)
    valid = np.cumsum(step[:-1]) > 0
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    bound = np.append(np.flatnonzero(change), len(least))
    use = valid[bound[:-1]]
    start, n = bound[:-1][use], np.diff(bound)[use]
    gram = least[start]
    # a gram that stands twice in a stretch may make two of its windows equal; more than 8 minima count as twice
    zero = np.zeros(w - 1, np.uint64)
    minima = np.flatnonzero(sliding(np.concatenate([zero, np.where(valid, least, 0), zero]), w, np.maximum) == hashes)
    low, high = np.searchsorted(minima, start), np.searchsorted(minima, start + n + w - 1)
    seen = np.zeros(len(start), np.int64)
    for i in range(8):
        at = np.minimum(low + i, len(minima) - 1)
        seen += (low + i < high) & (hashes[minima[at]] == gram) if len(minima) else 0
    text = data.tobytes()
    digest = [xxhash.xxh3_64_intdigest(text[a : a + b]) for a, b in zip(start.tolist(), (n + length - 1).tolist())]
    return {
        "gram": gram, "digest": np.array(digest, np.uint64), "at": start, "n": n, "twice": (seen > 1) | (high - low > 8),
    }


def texts_of(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most so many bytes of text, or one row: (rows, bytes, offsets of texts)."""
    text = batch["text"]
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def spans_of(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, n) of a column of spans."""
    spans = batch[name]
    rows = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
    start, n = spans.flatten().flatten()[:2]
    return rows, start.to_numpy().astype(np.int64), n.to_numpy().astype(np.int64)


# --- stretches of the corpus ------------------------------------------------------


def joined(runs: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([r[c] for r in runs]) for c in runs[0]}


def chosen(rows: dict[str, np.ndarray], use: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[use] for c, v in rows.items()}


def sorted_stretches(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """By gram, digest and place, a place once; also where a (gram, digest) begins, and the number of the gram."""
    rows = chosen(rows, np.lexsort([rows[c] for c in ("at", "tie", "id", "digest", "gram")]))
    change = {c: np.append(True, rows[c][1:] != rows[c][:-1])[: len(rows[c])] for c in ("gram", "digest", "id", "tie", "at")}
    new = change["gram"] | change["digest"]
    use = new | change["id"] | change["tie"] | change["at"]
    return chosen(rows, use), new[use], np.cumsum(change["gram"][use]) - 1


def packed(rows: dict[str, np.ndarray]) -> bytes:
    """Six bytes of the hashes as they are, all else as differences, compressed."""
    rows = chosen(rows, np.lexsort([rows[c] for c in ("at", "tie", "id")]))
    hashes = [rows[c].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for c in ("gram", "digest")]
    small = [np.diff(rows[c], prepend=np.int64(0)).tobytes() for c in ("id", "tie")]
    small += [rows[c].astype("<i4").tobytes() for c in ("at", "n")] + [(rows["mark"] * 2 + rows["twice"]).astype(np.uint8).tobytes()]
    return b"".join(hashes) + zlib.compress(b"".join(small), 1)


def unpacked(blob: bytes, n: int) -> dict[str, np.ndarray]:
    out, small = {}, zlib.decompress(blob[12 * n :])
    for i, c in enumerate(("gram", "digest")):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 6 * n * i).reshape(n, 6)
        out[c] = wide.reshape(-1).view("<u8")
    for i, c in enumerate(("id", "tie")):
        out[c] = np.cumsum(np.frombuffer(small, np.int64, n, 8 * n * i))
    for i, c in enumerate(("at", "n")):
        out[c] = np.frombuffer(small, "<i4", n, 16 * n + 4 * n * i).astype(np.int64)
    flags = np.frombuffer(small, np.uint8, n, 24 * n)
    return out | {"mark": flags // 2, "twice": flags % 2 == 1}


def bucket_rows(rows: dict[str, np.ndarray], buckets: int, crowd: int | None) -> Iterator[tuple[int, int, bytes]]:
    """The stretches of a run of texts, dealt over buckets by gram; of a crowded gram all but one by digest."""
    rows, new, number = sorted_stretches(rows)
    mark = np.where(new, 0, REPEAT)
    if crowd:
        many = np.bincount(number, weights=new)[number] > crowd
        leads = np.append(True, number[1:] != number[:-1])[: len(number)]
        mark = np.where(many & new, np.where(leads, MANY, SPREAD), mark)
    rows["mark"] = mark.astype(np.uint8)
    by = np.where(mark == SPREAD, rows["digest"], rows["gram"]) & np.uint64(0xFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        bucket = ((by * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(buckets)))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(bucket[order[a]]), int(b - a), packed(chosen(rows, order[a:b]))


def resolved(rows: dict[str, np.ndarray], group: int | None) -> dict[str, np.ndarray]:
    """States of the stretches of a bucket; those with nothing to do are left out."""
    before, rest = rows["mark"] == REPEAT, rows["mark"] != REPEAT
    out = [chosen(rows, before) | {"state": np.full(before.sum(), REPEAT)}]
    for spread in (False, True):
        some, new, number = sorted_stretches(chosen(rows, rest & ((rows["mark"] == SPREAD) == spread)))
        if not len(number):
            continue
        different = np.bincount(number, weights=new)[number]
        crowded = np.bincount(number, weights=some["mark"] >= MANY)[number] > 0
        if group:
            crowded |= different > group
        state = np.where(~new, REPEAT, np.where(crowded, CROWDED, np.where((different > 1) | some["twice"], LEFT, 0)))
        out.append(chosen(some | {"state": state}, state > 0))
    return joined(out)


def stretch_states(texts: DataFrame, k: int, buckets: int, s: Settings) -> DataFrame:
    """Repeats, stretches left for sorting and crowded ones among all windows, or those in column spans."""
    last_level, some = k == s.length, "spans" in texts.columns

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows = list(bucket_rows(joined(held), buckets, None if last_level else s.crowd))
            held.clear()
            columns = list(zip(*rows)) or [()] * 3
            types = (pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["bucket", "n", "rows"])

        for batch in batches:
            for part, data, offsets in texts_of(batch, s.text_bytes):
                if some:
                    row, start, n = spans_of(part, "spans")
                    first, last = offsets[row] + start, offsets[row] + start + n
                else:
                    long = np.diff(offsets) >= s.length
                    first, last = offsets[:-1][long], offsets[1:][long] - s.length + 1
                found = stretches(data, first, last, k, s.length)
                row = np.searchsorted(offsets, found["at"], side="right") - 1
                found |= {c: part[c].to_numpy()[row] for c in ("id", "tie")}
                held.append(found | {"at": found["at"] - offsets[row]})
                if sum(len(h["at"]) for h in held) >= s.run:
                    yield flush()
        if held:
            yield flush()

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def flush() -> pa.RecordBatch:
            rows = resolved(joined(held), None if last_level else s.group)
            held.clear()
            names = {"start": "at", "gram": "gram"}
            types = {"start": np.int32, "n": np.int32, "state": np.int8, "gram": np.int64}
            columns = [f.split()[0] for f in FOUND.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[names.get(c, c)].astype(types.get(c, np.int64))) for c in columns], names=columns
            )

        for batch in batches:
            for b, n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and held:
                    yield flush()
                bucket = b
                held.append(unpacked(blob, n))
        if held:
            yield flush()

    rows = texts.mapInArrow(listed, "bucket int, n int, rows binary")
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(decided, FOUND)


# --- suffixes of what is left -----------------------------------------------------


def sorted_repeats(left: DataFrame, parts: int, s: Settings) -> DataFrame:
    """Windows of stretches (level, gram, id, tie, start, text) that stand earlier in a stretch of their gram."""
    columns = ["level", "gram", "id", "tie", "start", "text"]

    def repeats(rows: pa.RecordBatch) -> pa.RecordBatch:
        keys = np.stack([rows[c].to_numpy().astype(np.int64) for c in columns[:5]])
        once = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
        rows, keys = rows.filter(pa.array(once)), keys[:, once]
        _, data, offsets = next(texts_of(rows, 1 << 31))
        n = np.diff(offsets) - s.length + 1
        row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        new_group = np.append(True, (keys[:2, 1:] != keys[:2, :-1]).any(axis=0))
        start = (np.cumsum(n) - n)[new_group]
        at = offsets[row] + inside
        order, new = deep_shallow(data, at, start, np.diff(np.append(start, len(at))), s.length)
        first = np.minimum.reduceat(order, np.flatnonzero(new))
        again = np.ones(len(order), bool)
        again[first] = False
        begin = np.flatnonzero(again & ~np.append(False, again[:-1] & (row[1:] == row[:-1])))
        end = np.flatnonzero(again & ~np.append(again[1:] & (row[1:] == row[:-1]), False))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[2][row[begin]]), pa.array(keys[3][row[begin]]),
             pa.array((keys[4][row[begin]] + inside[begin]).astype(np.int32)), pa.array((end - begin + 1).astype(np.int32))],
            names=["id", "tie", "start", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in slices(batch, 2000):
                held = pa.concat_batches([held, part]) if held is not None and held.num_rows else part
                if held.nbytes < s.sort_bytes:
                    continue
                level, gram = held["level"].to_numpy(), held["gram"].to_numpy()
                cuts = np.flatnonzero((level[1:] != level[:-1]) | (gram[1:] != gram[:-1]))
                if len(cuts):
                    yield repeats(held.slice(0, int(cuts[-1]) + 1))
                    held = held.slice(int(cuts[-1]) + 1)
        if held is not None and held.num_rows:
            yield repeats(held)

    dealt = left.select(columns).repartition(parts, "level", "gram").sortWithinPartitions(*columns[:5])
    return dealt.mapInArrow(run, "id bigint, tie bigint, start int, n int")


def bytes_of(texts: DataFrame, s: Settings) -> DataFrame:
    """The stretches in column spans (start, n, level, gram) with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in texts_of(whole, s.text_bytes):
                row, start, n = spans_of(batch, "spans")
                level, gram = batch["spans"].flatten().flatten()[2:]
                text = data.tobytes()
                at = (offsets[row] + start).tolist()
                cut = [text[a : a + b + s.length - 1] for a, b in zip(at, n.tolist())]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [level, gram, batch["id"].take(take), batch["tie"].take(take), pa.array(start.astype(np.int32)), pa.array(cut, pa.binary())],
                    names=["level", "gram", "id", "tie", "start", "text"],
                )

    return texts.mapInArrow(run, "level int, gram bigint, id bigint, tie bigint, start int, text binary")


def cut_out(texts: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): maximal removed runs of bytes (start, n), and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in texts_of(whole, s.text_bytes):
                row, start, n = spans_of(batch, "windows")
                spans: list[list[dict]] = [[] for _ in range(len(batch))]
                gone = np.zeros(len(data) + 1, np.int32)
                np.add.at(gone, offsets[row] + start, 1)
                np.add.at(gone, offsets[row] + start + n + s.length - 1, -1)
                inside = np.cumsum(gone[:-1]) > 0
                # a run ends where the text ends, so that one text's last run and the next one's first stay apart
                text_of = np.repeat(np.arange(len(batch)), np.diff(offsets))
                edge = np.append(True, (inside[1:] != inside[:-1]) | (text_of[1:] != text_of[:-1]))[: len(data)]
                begin = np.flatnonzero(edge & inside)
                end = np.append(np.flatnonzero(edge), len(data))
                end = end[np.searchsorted(end, begin, side="right")]
                for r, a, b in zip(text_of[begin].tolist(), begin.tolist(), end.tolist()):
                    spans[r].append({"start": a - int(offsets[r]), "n": b - a})
                kept = [data[a:b][~inside[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(np.diff(offsets)), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))),
                     pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    return texts.mapInArrow(run, f"doc_id bigint, n_bytes bigint, spans {SPAN}, kept binary")


# --- the operator -----------------------------------------------------------------


def bucketed(docs: DataFrame, s: Settings) -> tuple[DataFrame, int]:
    """Texts as a table bucketed by document, and the number of its buckets."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    again = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").limit(1).count()
    by_text = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    tie = by_text if again else F.when(F.col("doc_id").isNull(), by_text).otherwise(F.lit(0).cast("bigint"))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), tie.alias("tie"), text.alias("text"))
    # fewer buckets than shuffle partitions, and Spark would rather move the texts again
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / s.bucket_bytes))
    name = f"repeats_{uuid.uuid4().hex}"
    writer = rows.repartition(n, "id", "tie").write.format("parquet").option("compression", "zstd")
    writer.bucketBy(n, "id", "tie").option("path", common.shared_folder(spark)).saveAsTable(name)
    return spark.table(name), n


def with_spans(texts: DataFrame, spans: DataFrame, name: str, how: str) -> DataFrame:
    """Texts with the spans of their document as one array; only the spans move."""
    columns = [c for c in spans.columns if c not in ("id", "tie")]
    lists = spans.groupBy("id", "tie").agg(F.collect_list(F.struct(*columns)).alias(name))
    return texts.join(lists.hint("shuffle_hash"), ["id", "tie"], how)


def repeated_passages(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of documents (doc_id, text), one row for each."""
    texts, n = bucketed(docs, s)
    repeats, left, todo = [], [], texts.select("id", "tie", "text")
    for level, k in enumerate((*s.grams, s.length)):
        states = common.kept_table(stretch_states(todo, k, n, s))
        repeats.append(states.filter(F.col("state") == REPEAT).select("id", "tie", "start", "n"))
        left.append(states.filter(F.col("state") == LEFT).select("id", "tie", "start", "n", F.lit(level).alias("level"), "gram"))
        crowded = states.filter(F.col("state") == CROWDED).select("id", "tie", "start", "n")
        if crowded.isEmpty():
            break
        todo = with_spans(texts, crowded, "spans", "inner").select("id", "tie", "text", "spans")
    unsorted = left[0]
    for more in left[1:]:
        unsorted = unsorted.unionByName(more)
    pieces = bytes_of(with_spans(texts, unsorted, "spans", "inner").select("id", "tie", "text", "spans"), s)
    all_repeats = common.kept_table(sorted_repeats(pieces, n, s))
    for more in repeats:
        all_repeats = all_repeats.unionByName(more)
    marked = with_spans(texts, all_repeats, "windows", "left")
    none = F.array().cast(SPAN)
    return cut_out(marked.select("doc_id", "text", F.coalesce("windows", none).alias("windows")), s)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 100-byte string of an earlier place covers, removed."""
    found = repeated_passages(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["n"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
