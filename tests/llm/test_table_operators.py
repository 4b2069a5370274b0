"""Near-duplicates, search, packing, chat, pseudonyms and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewloom.llm import bpe, chat, common, minhash, packing, pii, pivots
from reviewloom.llm.components import components
from reviewloom.llm.queries import ORACLES, QUERIES

from .conftest import EDGES, documents

TINY, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- components and near-duplicates ----------------------------------------------


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, x) for x in range(501, 600)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, 7), (501, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = smallest_reachable({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingle_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_brute_force(rows, n, percent):
    """(doc_id, set size, component, kept) of every row."""
    sets = defaultdict(list)
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id].append(shingle_set(text, n))
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[:i]
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    comp = smallest_reachable(ids, links)
    return Counter((d, len(shingle_set(t, n)), comp.get(d), d is None or comp[d] == d) for d, t in rows)


def family(rng, base, sizes, first):
    """Copies of a text, each with its own share of words replaced."""
    out = []
    for k, share in enumerate(sizes):
        words = [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in base]
        out.append((first + k, " ".join(words)))
    return out


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, words, percent):
    rng = random.Random(words)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = family(rng, base, [rng.choice((0, 0.005, 0.01, 0.02, 0.03, 0.05)) for _ in range(130)], 100)
    chain = [f"c{i}" for i in range(200)]  # neighbours are alike, the ends are not
    rows += [(1000 + k, " ".join(chain[3 * k : 3 * k + 140])) for k in range(15)]
    rows += [(2000 + k, "The SAME text\tevery\ntime é É") for k in range(40)] + [(2100, "the same TEXT every time é É")]
    rows += [(3000, "two words"), (3001, "Two  words"), (3002, "two"), (3003, "É"), (3004, "é")]
    # one id with two texts joins their groups; repeated rows; rows without id
    rows += [(5, rows[0][1]), (5, rows[130][1]), (6, None), (6, None), (None, rows[0][1]), (None, None)]
    docs = documents(spark, rows)
    s = minhash.Settings(words=words, percent=percent, block=16)
    got = Counter(tuple(r) for r in minhash.near_duplicates(docs, s).collect())
    assert got == near_brute_force(rows, words, percent)
    left = minhash.filter_documents(docs, s)
    assert left.columns == docs.columns
    want = Counter(r[0] for r in got.elements() if r[3] and r[0] is not None)
    assert Counter(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == Counter(set(want))
    assert left.filter("doc_id IS NULL").count() == 2


def test_near_duplicates_of_the_test_table_and_edges(spark, edges, nothing):
    docs = common.table(spark, TINY, "documents")
    got = Counter(tuple(r) for r in QUERIES["op3_minhash"](spark, TINY).collect())
    assert got == near_brute_force([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    rows = minhash.near_duplicates(edges).collect()
    assert Counter(tuple(r) for r in rows) == near_brute_force([r[:2] for r in EDGES], 3, 85)
    assert minhash.near_duplicates(nothing).count() == 0 == minhash.filter_documents(nothing).count()


def test_pairs_that_no_centre_takes_part_in(spark):
    """Bytes of the first band are equal by chance, its keys are not: the pairs meet in the crowded bucket of band 3 only."""
    s = minhash.Settings(block=16)
    rng = np.random.default_rng(2)

    def key(band, value):
        return value * minhash.MAX_BANDS + band

    rows = [(0, 100, [key(k, 10**6 + k) if k != 3 else key(3, 7) for k in range(s.bands)], rng.bytes(s.hashes))]
    want = set()
    for i in range(1, 120, 2):
        sig = rng.bytes(s.hashes)
        for doc_id in (i, i + 1):
            keys = [key(k, doc_id * 100 + k) for k in range(s.bands)]
            keys[3] = key(3, 7)
            rows.append((doc_id, 100, keys, sig))
        want.add((i, i + 1))
    # these share an earlier bucket of more than two as well, and are reported once
    for r in rows[1:5]:
        r[2][1] = key(1, 8)
    reps = spark.createDataFrame(rows, "id bigint, n bigint, keys array<bigint>, sig binary")
    banded = reps.select("id", F.explode("keys").alias("key"))
    members = banded.join(banded.groupBy("key").agg(F.count("*").alias("cnt")).filter("cnt > 1"), "key")
    centres = spark.createDataFrame([(key(3, 7), 0), (key(1, 8), 1)], "key bigint, centre bigint")
    found = spark.createDataFrame([], "node bigint, component bigint")
    text = lambda i: " ".join(f"w{(i + 1) // 2}x{k}" for k in range(30))
    docs = spark.createDataFrame([(r[0], text(r[0])) for r in rows], "doc_id bigint, text string")
    near = minhash.unsettled(members, centres, found, reps, s)
    assert near.count() <= 2 * near.select("id").distinct().count()  # as a probe and as a member, at most
    got = [tuple(r) for r in minhash.links_of_blocks(near, docs, s).collect()]
    assert sorted(got) == sorted(want)


def crowd(spark, text_of, n):
    """Documents of one crowded bucket, all with the same signature, whose centre is linked to none."""
    sig = np.random.default_rng(3).bytes(640)
    rows = [(i, 100, [k if k == 0 else i * 6400 + k for k in range(24)], sig) for i in range(n)]
    reps = spark.createDataFrame(rows, "id bigint, n bigint, keys array<bigint>, sig binary")
    members = reps.select("id", F.lit(0).cast("bigint").alias("key"), F.lit(n).cast("bigint").alias("cnt"))
    centres = spark.createDataFrame([(0, 0)], "key bigint, centre bigint")
    docs = spark.createDataFrame([(i, text_of(i)) for i in range(n)], "doc_id bigint, text string")
    return members, centres, spark.createDataFrame([], "node bigint, component bigint"), reps, docs


def test_a_crowded_bucket_reports_a_forest(spark):
    """All pairs look near: rows grow with the members, whether the sets are linked or not."""
    s, n = minhash.Settings(block=16), 60
    *tables, docs = crowd(spark, lambda i: " ".join(f"g{i % 4}w{k}" for k in range(20)), n)
    near = minhash.unsettled(*tables, s)
    assert near.count() <= 2 * n * -(-n // s.block)
    links = minhash.links_of_blocks(near, docs, s).collect()
    assert len(links) <= near.count()  # each block reports fewer links than it has members
    assert set(smallest_reachable(range(n), [tuple(r) for r in links]).values()) == {0, 1, 2, 3}
    *tables, docs = crowd(spark, lambda i: " ".join(f"d{i}w{k}" for k in range(20)), n)
    assert minhash.links_of_blocks(minhash.unsettled(*tables, s), docs, s).count() == 0


def test_id_filter_lets_all_ids_and_few_others_through(spark):
    ids = spark.range(0, 20_000, 10).select(F.col("id").alias("x"))
    test = minhash.may_be_among(ids, "x")
    rows = spark.range(20_000).withColumn("maybe", test("id"))
    assert rows.filter("maybe AND id % 10 = 0").count() == 2000 and rows.filter("maybe AND id % 10 <> 0").count() < 40
    df = spark.range(100).select(F.when(F.col("id") > 2, F.col("id")).alias("k"), F.lit("wide").alias("text"))
    some = df.select("k").filter("k % 3 = 0")
    assert minhash.having(df, "k", some).count() == 33 and minhash.having(df, "k", some, "left_anti").count() == 67
    assert minhash.having(df, "k", some.limit(0)).count() == 0 and minhash.having(df, "k", some.limit(0), "left_anti").count() == 100


# --- search ------------------------------------------------------------------------


def search_brute_force(rows, k, is_query):
    valid = {(i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, v in (r for r in valid if is_query(r[0])):
        scored = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q})[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("clustered", [True, False])
def test_search_equals_brute_force(spark, clustered):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] * 3 * clustered + rng.normal(size=6) * (0.2 if clustered else 1)).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.25] * 6) for i in range(300)]  # one very common vector: ties
    rows += [(2000, None), (2001, [1.0, None, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [1.0] * 6),
             (2004, []), (2005, [1.0, 2.0]), (7, rows[7][1]), (2100, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "v", "score", "rank")})
    s = pivots.Settings(pivots=8, annuli=4, part=64, block=16, sample=200)
    got = pivots.top_k(df, F.col("id") % 20 == 0, s)
    assert sorted(tuple(r) for r in got.collect()) == search_brute_force(rows, 10, lambda i: i % 20 == 0)


def test_search_small_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(0, [1.0, 0.0])], [(0, [1.0, 0.0]), (1, [0.5, 0.5])], [(0, None)]):
        got = pivots.top_k(spark.createDataFrame(rows, schema), F.col("id") % 100 == 0)
        assert sorted(tuple(r) for r in got.collect()) == search_brute_force(rows, 10, lambda i: i % 100 == 0)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-900, 900, (400, 8)), rng.integers(-900, 900, (30, 8))
    p = pivots.choose_pivots(x, 5)
    d = pivots.distances(x, p)
    near, one = d.argmin(axis=1), np.ones(1)
    for k in range(len(p)):
        own = x[near == k]
        r = d[near == k, k]
        known = pivots.Directory(p, np.array([k]), np.array([r.min()]), np.array([r.max()]), np.array([(own**2).sum(axis=1).max()]), one, one, one)
        assert (known.bounds(q)[:, 0] >= (q @ own.T).max(axis=1)).all()


# --- packing -----------------------------------------------------------------------


def check_packing(pieces, docs, capacity):
    """Every piece once, cut as stated, gapless in its sequence."""
    places = defaultdict(list)
    for r in pieces:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    codec = bpe.Codec(bpe.public_path())
    want = Counter()
    for doc_id, text in docs:
        ids = np.append(np.frombuffer(codec.encode(text or ""), "<u4"), 2).astype("<u4")
        first = len(ids) % capacity or capacity
        edges_ = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges_, edges_[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    return len(places)


def test_packing_of_the_test_table(spark):
    docs = [(r.doc_id, r.text) for r in common.table(spark, TINY, "documents").collect()]
    rows = QUERIES["op7_packing"](spark, TINY).collect()
    used = check_packing(rows, docs, 1024)
    assert used <= 1.01 * sum(r.length for r in rows) / 1024 + 1


def test_packing_edges(spark, edges, nothing):
    rows = packing.pack_documents(edges, capacity=16).collect()
    check_packing(rows, [r[:2] for r in EDGES], 16)
    assert packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_follows_the_method(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 64, 1024))
    counts = {n: rng.randrange(1, 10 ** rng.randrange(1, 7)) for n in rng.sample(range(1, capacity + 1), min(capacity, 200))}
    patterns = packing.plan(dict(counts), capacity)
    held = Counter()
    for p in patterns:
        assert sum(p.lengths) <= capacity and sum(3 * n > capacity for n in p.lengths) <= 2
        for n in p.lengths:
            held[n] += p.number
    assert held == Counter(counts)
    used = sum(p.number for p in patterns)
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    least = max(-(-sum(n * c for n, c in counts.items()) // capacity), large)
    assert used <= 1.23 * least + 1


def test_ranks_are_dense_within_lengths(spark):
    rows = [(i, 0, 0, 7 if i % 3 else 5, i) for i in range(2000)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    got = defaultdict(list)
    for r in packing.ranked(pieces, 50 * packing.BLOCK).collect():
        got[r.length].append(r.at)
    assert {n: sorted(a) for n, a in got.items()} == {n: list(range(len(a))) for n, a in got.items()}


# --- chat ----------------------------------------------------------------------------


def test_chat_reads_back_what_went_in(spark, duck):
    strings = ["", "\\", "<|", "<\\|", "\\<|", "<|end|>", "</s>[INST] ok [/INST]", "\\\\</s>", "<<SYS>>x<</SYS>>", "<<|", "|>", "é😀\n",
               "<|turn|>assistant<|text|>", None, "x" * 50_000, "<", "|more|>", "[", "INST]"]
    rng = random.Random(6)
    rows = [(c, rng.choice((0, 1, 2, 3, None)), rng.choice(("user", "assistant", "system", "<|x", "", None)), rng.choice(strings))
            for c in (1, 2, 3, 4, None) for _ in range(25)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    t = chat.Template()
    made = chat.format_conversations(turns, t)
    out = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted"), t).alias("t"), chat.loss_spans(F.col("formatted"), t).alias("s")).collect()
    digests = {r.conv_id: r for r in chat.digest(made, t).collect()}
    for r in out:
        own = [((x[1] is not None, x[1] or 0), x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id]
        want = [(role, text) for _, role, text in sorted(own)]
        assert [(x.role, x.text) for x in r.t] == want
        said = [text for role, text in want if role == "assistant"]
        assert len(r.s) == len(said)
        d = digests[r.conv_id]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(want), len("".join(said)), len(r.formatted))
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
        # adjacent turns of one role are one block
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert r.formatted.count(t.start) == r.formatted.count(t.end) == blocks
    assert chat.digest(chat.format_conversations(turns.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.Template(start="turn:")


# --- pseudonyms ------------------------------------------------------------------------


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def renamed(spark, values, key="k"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id bigint, text string")
    return [r.text for r in pii.pseudonymize(df, key).orderBy("doc_id").collect()]


def test_turns_of_one_place_are_sorted_by_their_plain_text(spark):
    rows = [(1, 0, "user", t) for t in ("<a", "<|", "<|im_end|>", "\\x", "</s>", "<b")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    formatted = chat.format_conversations(turns, chat.Template()).first().formatted
    t = chat.Template()
    body = formatted[len(t.start) + len("user") + len(t.text) : -len(t.end)]
    plain = spark.createDataFrame([(x,) for x in body.split(t.more)], "x string").select(chat.unescape(F.col("x"), t)).collect()
    assert [r[0] for r in plain] == sorted(r[3] for r in rows)


def test_pseudonyms_keep_format_and_validity(spark):
    texts = [
        "4111111111111111", "4111 1111 1111 1111", "4111111111111112", "3782-822463-10005", "233.254.104.120", "999.1.1.1", "1.2.3.4.5",
        "1987-03-09", "2023-02-30", "31.12.1999", "25/12/2020", "123-45-6789", "666-45-6789", "000-45-6789", "DE89370400440532013000",
        "GB82 WEST 1234 5698 7654 32", "DE89370400440532013001", "+1 (017) 555-7713", "+4915112345678", "(212) 555-0100", "ab.12@mail7.example.com",
    ]
    new = dict(zip(texts, renamed(spark, texts)))
    same = {t for t in texts if new[t] == t}
    assert same == {"4111111111111112", "999.1.1.1", "1.2.3.4.5", "2023-02-30", "666-45-6789", "000-45-6789", "DE89370400440532013001"}
    for t in set(texts) - same - {"233.254.104.120"}:
        assert re.sub("[0-9]", "9", new[t]) == re.sub("[0-9]", "9", t) or "@" in t
    for t in ("4111111111111111", "4111 1111 1111 1111", "3782-822463-10005"):
        assert luhn(re.sub(r"\D", "", new[t]))
    assert re.sub(" ", "", new["4111 1111 1111 1111"]) == new["4111111111111111"]
    for t in ("DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"):
        s = new[t].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert all(int(o) < 256 for o in new["233.254.104.120"].split("."))
    assert re.fullmatch(r"[a-z]{2}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", new["ab.12@mail7.example.com"])
    assert new["+1 (017) 555-7713"].startswith("+1 (")
    assert dict(zip(texts, renamed(spark, texts, "another")))["4111111111111111"] != new["4111111111111111"]


def test_pseudonyms_are_permutations(spark):
    cards = [d for d in (f"4{i:011d}" + "0" for i in range(3000)) if luhn(d)]
    dates = [f"20{y:02d}-{m:02d}-{d:02d}" for y in range(4) for m in range(1, 13) for d in range(1, 29)]
    ssns = [f"{a:03d}-{g:02d}-{n:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for n in (1, 77, 9999)]
    for values in (cards, dates, ssns):
        assert len(values) > 30 and len(set(renamed(spark, values))) == len(values)
    wide = [f"{n:012d}" for n in range(2)]
    pairs = spark.range(100).select(pii.permuted_digits(F.lpad(F.col("id").cast("string"), 2, "0"), "k", "x").alias("p")).collect()
    assert wide and sorted(r.p for r in pairs) == [f"{n:02d}" for n in range(100)]


def test_slash_dates_of_ten_years_keep_apart(spark):
    """Day first and month first are written alike; no two dates get one pseudonym, and each is read as it was."""
    days = [(y, m, d) for y in range(2001, 2011) for m in range(1, 13) for d in range(1, 32) if d < 29 or (d < 31 and m != 2) or m in (1, 3, 5, 7, 8, 10, 12)]
    texts = sorted({f"{d:02d}/{m:02d}/{y}" for y, m, d in days} | {f"{m:02d}/{d:02d}/{y}" for y, m, d in days})
    new = dict(zip(texts, renamed(spark, texts)))
    assert len(set(new.values())) == len(texts) > 5500
    assert new["07/29/2006"] != new["29/07/2006"]
    for t in texts:
        assert (int(t[3:5]) > 12) == (int(new[t][3:5]) > 12)  # month first stays month first


def test_pseudonyms_in_texts_and_edges(spark, edges, nothing):
    texts = ["Mail a.b@c.org, a.b@c.org; (4111111111111111) v3.0. 4785380592391130 and 192.168.1.7.", "tel +1 (017) 555-7713 190.137.223.204 x"]
    one, two = renamed(spark, texts)
    first, second = re.findall(r"\S+@[a-z]+\.org", one)
    assert first == second != "a.b@c.org" and "v3.0. 4785380592391130 and" in one and "4111111111111111" not in one
    assert two.startswith("tel +1 (") and two.endswith(" x") and "190.137.223.204" not in two and "555-7713" not in two
    rows = Counter((r.doc_id, r.text) for r in pii.pseudonymize(edges, "k").collect())
    assert rows == Counter((r[0], r[1]) for r in EDGES)
    docs = documents(spark, [(1, texts[0]), (2, None), (3, "ip 1.1.1.1")])
    made = pii.pseudonymize_documents(docs, "k")
    assert made.columns == docs.columns and made.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert all(r.n_chars == len(r.text or "") for r in made.collect())
    assert pii.pseudonymize_documents(nothing, "k").count() == 0


def test_words_behind_grouped_ibans_are_left_alone(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00",
             "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32"]
    tails = [" BIC CAIXESBB", " USD 50", " 50 EUR", "", " A", ". END", " 4111 1111 1111 1111"]
    texts = [f"IBAN {i}{t}" for i in ibans for t in tails]
    alone = dict(zip(ibans, renamed(spark, ibans)))
    card = renamed(spark, ["4111 1111 1111 1111"])[0]
    assert all(alone[i] != i for i in ibans)
    assert renamed(spark, texts) == [f"IBAN {alone[i]}{card.rjust(20) if len(t) == 20 else t}" for i in ibans for t in tails]


def test_native_operators_run_no_python(spark):
    for name in ("op6_chat_format", "op9_pii"):
        plan = QUERIES[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD.*documents", plan)


# --- queries ---------------------------------------------------------------------------


def test_oracles_agree(spark, duck):
    from check import differences

    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, TINY).toPandas(), duck.sql(sql).df()) == ""


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Each stage's decisions take effect on what the one before kept."""
    docs = common.table(spark, TINY, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.kept_table(stage(spark, docs, TINY))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
            kept.append((name, before, docs, ids))
    (_, raw, _, good), (_, _, _, clean), (_, mixed, _, single), (_, _, last, same) = kept
    from .test_text_operators import measures

    assert not any(m[0] < 20 or 100 * m[4] > 30 * m[0] for m in (measures(r.text) for r in raw.collect() if r.doc_id in good))
    near = near_brute_force([(r.doc_id, r.text) for r in mixed.collect()], 5, 80)
    assert single == {r[0] for r in near if r[3]} and same == single and clean >= single
    check_packing(docs.collect(), [(r.doc_id, r.text) for r in last.collect()], 1024)
    assert sorted(tuple(r)[:5] for r in QUERIES["pipeline"](spark, TINY).collect()) == sorted(tuple(r)[:5] for r in docs.collect())
