"""Merkle manifest, vector codes and suffix-sorted dedup against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import database, differences
from reviewloom.llm import merkle, repeats, vector_codes
from reviewloom.llm.queries import ORACLES, QUERIES
from reviewloom.llm.suffix_sort import blind_trie, deep_shallow

from .conftest import EDGES

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_merkle", "op12_vector_codes", "op13_suffix_dedup"])
def test_queries_equal_sql(spark, name):
    want = database(TINY).sql(ORACLES[name]).df()
    assert len(want) and differences(QUERIES[name](spark, TINY).toPandas(), want) == ""


# --- Merkle manifest --------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves, fan_out):
    """Root, and the siblings (left, right) of every leaf on its way up."""
    paths, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            first = i // fan_out * fan_out
            path.append(("".join(level[first:i]), "".join(level[i + 1 : first + fan_out])))
        level = [sha(*level[i : i + fan_out]) for i in range(0, len(level), fan_out)]
        at = [i // fan_out for i in at]
    return level[0], paths


@pytest.mark.parametrize("fan_out, levels, sizes", [(2, 8, (1, 2, 5)), (2, 2, (1, 4, 17, 64, 65)), (3, 1, (7, 9, 28, 1))])
def test_manifest_equals_a_plain_tree(spark, fan_out, levels, sizes):
    groups = {f"={chr(97 + g)}" if g else "": [sha(str(g), str(i)) for i in range(n)] for g, n in enumerate(sizes)}
    rows = [(g, leaf, i) for g, leaves in groups.items() for i, leaf in enumerate(leaves)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "grp string, node string, n int")
    got = merkle.manifest(df, ["n"], [], merkle.Shape(fan_out, levels), partitions=3)
    got = got.withColumns({"f": merkle.fold(F.col("node"), F.col("path")), "p": merkle.proof(F.col("path"))}).collect()
    built = {g: tree(leaves, fan_out) for g, leaves in groups.items()}
    root, tops = tree([built[g][0] for g in sorted(groups)], fan_out)
    top = dict(zip(sorted(groups), tops))
    assert len(got) == len(rows)
    for r in got:
        subroot, paths = built[r.grp]
        path = paths[r.n] + top[r.grp]
        assert (r.subroot, r.root, r.f) == (subroot, root, root)
        assert [tuple(s) for s in r.path] == path and r.p == "".join(a + b for a, b in path)


def test_manifest_of_edge_rows(spark, edges, nothing, tmp_path):
    edges.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle.op11_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(EDGES)
    n_chars = {r.doc_id: r.n_chars for r in edges.collect()}
    for r in got:
        tampered = r.doc_id is not None and n_chars[r.doc_id] is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified == (not tampered) == (r.folded_root == r.root)
    two = [r for r in got if r.doc_id == 5]  # equal rows are leaves of their own
    assert len(two) == 2 and two[0].leaf == two[1].leaf
    nothing.coalesce(1).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert merkle.op11_merkle(spark, str(tmp_path / "none")).count() == 0


# --- vector codes -----------------------------------------------------------------


def plain_lloyd(rows, s):
    """Codes, errors and codebooks by comparing every part with every entry in every round."""
    width = -(-max((len(v) for _, v in rows), default=0) // s.parts) * s.parts
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [v + [0] * (width - len(v)) for _, v in rows]
    k = width // s.parts
    cut = [[v[p * k : (p + 1) * k] for p in range(s.parts)] for v in vectors]
    books = [[c[p] for c in cut[: s.entries]] for p in range(s.parts)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(s.rounds):
        codes = [[nearest(c[p], books[p])[0] for p in range(s.parts)] for c in cut]
        for p in range(s.parts):
            for e in range(len(books[p])):
                own = [c[p] for c, code in zip(cut, codes) if code[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    final = [[nearest(c[p], books[p]) for p in range(s.parts)] for c in cut]
    return [(r[0], bytes(e for e, _ in f).hex(), sum(d for _, d in f)) for r, f in zip(rows, final)], books


@pytest.mark.parametrize("seed, width, n", [(1, 8, 60), (2, 4, 200), (3, 6, 7), (4, 0, 3)])
def test_codes_equal_plain_lloyd(spark, seed, width, n):
    rng = random.Random(seed)
    s = vector_codes.Settings(scale=1, parts=4, entries=8, rounds=5, batch=16)
    rows = [(rng.choice([None, i, i, 3]), [float(rng.randrange(-4, 5)) for _ in range(rng.choice([width, width // 2]))]) for i in range(n)]
    bad = [(900, None), (901, [1.0, None]), (902, [float("nan")]), (903, [float("inf"), 1.0])]
    schema = "vec_id bigint, embedding array<float>, label int, code string"
    df = spark.createDataFrame([(i, v, rng.choice([None, 1, 2]), "x") for i, v in rows + bad], schema).repartition(5)
    found, books = vector_codes.fit(df, s)
    got = [(r.vec_id, r.code, r.error) for r in vector_codes.unpacked(found).collect()]
    want, want_books = plain_lloyd([(i, [int(x) for x in v]) for i, v in rows], s)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert books.tolist() == want_books


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (300, 2, 2))
    books = rng.integers(-3, 4, (2, 6, 2))
    code, error = vector_codes.assign(x, books, np.ones((2, 6), bool), None, None)
    for _ in range(20):
        new = books.copy()
        new[rng.integers(2), rng.integers(6)] = rng.integers(-3, 4, 2)
        moved, books = (new != books).any(axis=2), new
        code, error = vector_codes.assign(x, books, moved, code, error)
        full = vector_codes.assign(x, books, np.ones((2, 6), bool), None, None)
        assert (code == full[0]).all() and (error == full[1]).all()


def test_label_errors_put_nulls_together(spark, monkeypatch):
    rows = spark.createDataFrame([(1, None, 2, "a"), (2, None, 3, "b"), (3, 7, 5, "c")], "vec_id bigint, label int, e int, code string")
    for limit in (100, 0):
        monkeypatch.setattr(vector_codes.common, "SMALL_ROWS", limit)
        got = {r.vec_id: r.label_error for r in vector_codes.with_label_errors(rows, F.col("e")).collect()}
        assert got == {1: 5, 2: 5, 3: 5}


def test_codes_of_no_vectors_and_of_too_large_ones(spark):
    none = spark.createDataFrame([(1, None, 1)], "vec_id bigint, embedding array<float>, label int")
    assert vector_codes.unpacked(vector_codes.fit(none)[0]).count() == 0
    large = spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(ValueError, match="whole numbers"):
        vector_codes.fit(large)


# --- suffixes ---------------------------------------------------------------------


def test_deep_shallow_sorts_suffixes():
    rng = random.Random(2)
    for _ in range(25):
        alphabet = rng.choice([b"ab", b"abc", bytes(range(256))])
        base = bytes(rng.choice(alphabet) for _ in range(rng.randrange(50, 300)))
        pieces = [base, base[:150], b"a" * 140, bytes(rng.choice(alphabet) for _ in range(90))]
        data, depth = b"".join(rng.choice(pieces) for _ in range(12)), rng.choice([5, 40, 100])
        at = np.arange(len(data) - depth + 1)
        start = np.array(sorted({0, *rng.sample(range(1, len(at)), 4)}))
        size = np.diff(np.append(start, len(at)))
        order, new = deep_shallow(np.frombuffer(data, np.uint8), at, start, size, depth)
        for a, n in zip(start.tolist(), size.tolist()):
            got = [data[i : i + depth] for i in order[a : a + n]]
            assert got == sorted(data[i : i + depth] for i in range(a, a + n))
            assert new[a : a + n].tolist() == [True] + [x != y for x, y in zip(got, got[1:])]


def test_blind_trie_orders_and_joins_equal_strings():
    strings = [b"abcd", b"abce", b"abcd", b"zbcd", b"aaaa", b"abce"]
    assert blind_trie(strings) == [[4], [0, 2], [1, 5], [3]]


def plain_cut(rows, length):
    """(doc_id, kept, spans) by looking every window up among all before it; a repeated row counts once."""
    texts = {(i, (t or "").encode()) for i, t in rows}
    tie = {t: 0 for _, t in texts}
    seen, out = set(), {}
    assert all(i is None or sum(i == j for j, _ in texts) == 1 for i, _ in texts), "needs the hash of the tie"
    for i, b in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]])):
        covered = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                covered[p : p + length] = True
            seen.add(b[p : p + length])
        edges = np.flatnonzero(np.diff(covered, prepend=False)).tolist()
        out[i, b] = (bytes(np.frombuffer(b, np.uint8)[~covered[:-1]]), [(a, z - a) for a, z in zip(edges[::2], edges[1::2])])
    return sorted((i, *out[i, (t or "").encode()]) for i, t in rows)


def passages(seed):
    """Texts with shared passages, common lines in different company, copies, periods and non-ASCII."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    line = " ".join(word() for _ in range(6))
    shared = [" ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(5)]
    out = []
    for i in range(70):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 12))) for _ in range(3)]
        parts.insert(rng.randrange(3), line)
        if rng.random() < 0.5:
            parts.insert(rng.randrange(3), rng.choice(shared))
        if rng.random() < 0.15:
            parts.append(rng.choice(["x", "ab", "abc"]) * rng.randrange(10, 60))
        out.append((i * 3, "".join(parts)))
    return out + [(1000 + i, out[i][1]) for i in range(8)] + [(2000, None), (2001, ""), (2002, "short")]


@pytest.mark.parametrize("seed, crowd, group", [(1, 16, 4096), (2, 1, 2), (3, 2, 1), (4, 3, 5)])
def test_repeated_passages_equal_brute_force(spark, seed, crowd, group):
    s = repeats.Settings(length=24, grams=(8, 16), crowd=crowd, group=group, text_bytes=700, run=60, sort_bytes=500)
    rows = passages(seed) + [(5000, "twice " * 20), (5000, "twice " * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"spans": F.lit(1), "id": F.lit("x"), "gram": F.lit(2)})
    got = sorted((r.doc_id, bytes(r.kept), [tuple(x) for x in r.spans]) for r in repeats.repeated_passages(df.repartition(4), s).collect())
    assert got == plain_cut(rows, 24)


def test_repeated_passages_of_edge_rows(spark, edges, nothing):
    got = repeats.repeated_passages(edges).collect()
    assert len(got) == len(EDGES)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].n_bytes == 0 and bytes(by_id[2].kept) == b"" and by_id[5].spans == []
    assert bytes(by_id[7].kept) == b"x" and bytes(by_id[6].kept) == b"word "  # later windows equal the first ones
    assert repeats.repeated_passages(nothing).count() == 0


def test_documents_of_one_id_are_ordered_by_text(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    rows = [(1, text + " a"), (1, text + " b"), (None, text + " c"), (None, text + " d")]
    got = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    whole = [r for r in got if not r.spans]
    assert len(whole) == 1 and whole[0].doc_id is None  # ids that are null come first
