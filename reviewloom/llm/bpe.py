"""Byte-level BPE from a public vocabulary file: whole texts to ids and back.

Every short word (a match of the pre-tokenizer's pattern) is encoded on a
contiguous rank array: the parts between its boundaries, and the rank of joining
each part with the next. The smallest rank is looked for again and again, its
boundary is deleted, and the ranks beside it are refreshed; words of one length
go through these steps together, as rows of arrays. Words of over LONG bytes keep
the same ranks in a heap, because a scan for each of their joins would take time
with the square of the length; the result is equal.

Null text counts as empty and gives no ids. Ids, nulls and repeated rows of
doc_id pass through as they are; other columns are ignored. Special strings of
the vocabulary become their ids, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable
from functools import cached_property
from itertools import accumulate, compress
from operator import not_

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import common

#: Fixed values of the public byte-level format: the pattern that cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for the standard library's engine, right only for characters that NOT_PLAIN does not find. Their letters
#: and digits are plain ranges, and words of letters come first: no other alternative begins like them.
LETTERS = "A-Za-zªµÀ-ÖØ-öø-ɏ"
PLAIN_PATTERN = rf" ?[{LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\t\n\r 0-9{LETTERS}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
NOT_PLAIN = r"[^\t\n\r -~¡-±´-¸»¿-ɏ‐-‧‰-⁞]"
LONG = 64
#: Short words go through the rank array in blocks of these widths.
BLOCKS = (3, 5, 7, 9, 11, 14, 18, 24, 36, LONG)
#: Words of one generation of a task's dictionary, which keeps two: about 80 MB each.
MAX_WORDS = 400_000
#: Documents encoded together, within the bytes of a run.
ROWS = 2000
NONE = np.int32(2**31 - 1)


def byte_alphabet() -> dict[str, int]:
    """The public format writes each byte as a visible character: itself, or the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Ranks:
    """Pairs of adjacent part ids to the rank of their join, as a hashed array for whole arrays of pairs."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (len(pairs) * 16).bit_length())
        size = 1 << self.bits
        self.keys, self.rank = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        self.joined = np.array([new for _, new in sorted(pairs.values())], np.int32)  # by rank
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        rank = np.array([r for r, _ in pairs.values()], np.int32)
        at = self.slot(keys)
        while len(keys):  # one key of each free place is put there, the others go on to the next place
            first = np.zeros(len(keys), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = first & (self.keys[at] < 0)
            self.keys[at[put]], self.rank[at[put]] = keys[put], rank[put]
            keys, rank, at = keys[~put], rank[~put], (at[~put] + 1) % size

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; NONE where the two do not join or one is missing (-1)."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = left.astype(np.int64) << 32 | right
        at = self.slot(keys)
        while len(open_ := np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))):
            at[open_] = (at[open_] + 1) % len(self.keys)
        hit = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NONE).reshape(shape)


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        import regex

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        letters, vocab = byte_alphabet(), content["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.path = path
        self.of_byte = np.zeros(256, np.int32)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.pairs = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(merges)}
        self.ranks = Ranks(self.pairs)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.max_words = max_words
        self.not_plain = re.compile(NOT_PLAIN)
        self.plain, self.full = re.compile(PLAIN_PATTERN).findall, regex.compile(PATTERN).findall
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else None

    @cached_property
    def spell(self) -> list[bytes]:
        """The bytes of every id, read when they are needed."""
        with open(self.path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        out, letters = [b""] * (max([*vocab.values(), *self.special.values()]) + 1), byte_alphabet()
        for k, v in vocab.items():
            out[v] = bytes(letters[c] for c in k) if all(c in letters for c in k) else k.encode()
        for k, v in self.special.items():
            out[v] = k.encode()
        return out

    def merge_short(self, words: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the parts of many words at a time.

        words: a row of bytes each, of which the first `left` count. Returns the ids
        left, -1 behind the last one, and their number.
        """
        n, width = words.shape
        columns = np.arange(width)
        # a row is the ids of the parts; a boundary lies between any two
        parts = np.where(columns < left[:, None], self.of_byte[words], np.int32(-1))
        done, counts = np.full((n, width), -1, np.int32), np.ones(n, np.int64)
        if width == 1:
            return parts, counts
        rank = self.ranks.find(parts[:, :-1], parts[:, 1:])
        rows = np.arange(n)
        while len(rows):
            at = rank.argmin(axis=1)
            every = np.arange(len(rows))
            ended = rank[every, at] == NONE
            if ended.any():
                done[rows[ended]], counts[rows[ended]] = parts[ended], left[ended]
                go = ~ended
                rows, parts, rank, left, at = (x[go] for x in (rows, parts, rank, left, at))
                every = np.arange(len(rows))
                if not len(rows):
                    break
            parts[every, at] = self.ranks.joined[rank[every, at]]
            # delete the boundary behind `at`: what lies right of it moves one place to the left
            parts = np.where(columns <= at[:, None], parts, np.pad(parts[:, 1:], ((0, 0), (0, 1)), constant_values=-1))
            shift = columns[:-1] <= at[:, None]
            rank = np.where(shift, rank, np.pad(rank[:, 1:], ((0, 0), (0, 1)), constant_values=NONE))
            left -= 1
            for beside in (at - 1, at):
                near = np.flatnonzero((beside >= 0) & (beside < width - 1))
                k = beside[near]
                rank[near, k] = self.ranks.find(parts[near, k], parts[near, k + 1])
        return done, counts

    def merge_long(self, word: bytes) -> list[int]:
        """The same joins in the same order (smallest rank, then leftmost), from a heap."""
        n, ids = len(word), self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := following[i]) < n:
                joins = self.pairs.get((ids[i], ids[j]))
                if joins is not None:
                    heapq.heappush(heap, (joins[0], i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = following[i]
            if gone[i] or ids[i] != left or j >= n or ids[j] != right:
                continue
            gone[j], ids[i], following[i] = 1, self.pairs[left, right][1], following[j]
            if following[j] < n:
                previous[following[j]] = i
            offer(i)
            offer(previous[i])
        return [ids[i] for i in range(n) if not gone[i]]

    def learn(self, fresh: list[str]) -> None:
        """Encode words that the dictionary lacks."""
        encoded = [w.encode() for w in fresh]
        sizes = np.fromiter(map(len, encoded), np.int64, len(fresh))
        for least, most in zip((0, *BLOCKS), BLOCKS):
            group = np.flatnonzero((sizes > least) & (sizes <= most)).tolist()
            for i in range(0, len(group), 50_000):
                some = group[i : i + 50_000]
                left = sizes[some]
                padded = np.zeros((len(some), most), np.uint8)
                padded[np.arange(most) < left[:, None]] = np.frombuffer(b"".join(map(encoded.__getitem__, some)), np.uint8)
                ids, counts = self.merge_short(padded, left)
                flat, ends = ids[ids >= 0].astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                self.words.update(zip(map(fresh.__getitem__, some), map(flat.__getitem__, map(slice, [0, *ends], ends))))
        for k in np.flatnonzero(sizes > LONG).tolist():
            self.words[fresh[k]] = np.array(self.merge_long(encoded[k]), "<u4").tobytes()

    def find(self, text: str) -> list[str]:
        return self.full(text) if self.not_plain.search(text) else self.plain(text)

    def look(self, found: list[list[str]]) -> tuple[list[list[bytes | None]], list[list[int]]]:
        """Ids of the words of each part, and the places of words that the dictionary lacks."""
        ids = [list(map(self.words.get, words)) for words in found]
        return ids, [list(compress(range(len(some)), map(not_, some))) for some in ids]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        for s, i in self.special.items():
            self.words[s] = np.uint32(i).tobytes()
        cuts = [self.cut(t) if self.cut and any(s in t for s in self.special) else [t] for t in texts]
        found = [[p] if p in self.special else self.find(p) for parts in cuts for p in parts]
        ids, open_ = self.look(found)
        fresh = {words[k] for words, places in zip(found, open_) for k in places}
        if len(self.words) + len(fresh) > self.max_words:  # a new generation; words in use move on to it
            self.older, self.words = self.words, {}
            fresh = set().union(*found)
        known = fresh.intersection(self.older)
        self.words.update((w, self.older[w]) for w in known)
        self.learn(list(fresh - known))
        get, parts = self.words.__getitem__, []
        for words, some, places in zip(found, ids, open_):
            for k in places:
                some[k] = get(words[k])
            parts.append(b"".join(some))
        ends = list(accumulate(map(len, cuts)))
        return [parts[b - 1] if b - a == 1 else b"".join(parts[a:b]) for a, b in zip([0, *ends], ends)]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        spell = self.spell
        return b"".join([spell[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int): the encoded texts."""

    def make() -> Callable[..., tuple]:
        c = Codec(path or public_path())

        def rows(doc_ids: list, texts: list) -> list[tuple]:
            encoded = c.encode_batch([t or "" for t in texts])
            return [(d, np.frombuffer(i, "<u4").tolist()) for d, i in zip(doc_ids, encoded)]

        return rows

    return common.map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, ids array<int>", ROWS)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give empty text."""

    def make() -> Callable[..., tuple]:
        c = Codec(path or public_path())
        return lambda doc_id, ids: (doc_id, c.decode(np.array(ids or [], "<u4").tobytes()))

    return common.map_rows(encoded.select("doc_id", "ids"), make, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of what they decode to, in one pass."""

    def make() -> Callable[..., tuple]:
        c = Codec(path or public_path())

        def row(doc_id: int | None, ids: bytes) -> tuple:
            back = c.decode(ids).encode()
            return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

        return lambda doc_ids, texts: [
            row(d, ids) for d, ids in zip(doc_ids, c.encode_batch([t or "" for t in texts]))
        ]

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return common.map_batches(docs.select("doc_id", "text"), make, schema, ROWS)


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(common.table(spark, folder, "documents"))
