"""Cleaning, deduplication and chunking against plain Python."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions import text as T
from reviewloom.operators.chunk import chunk, review_chunks
from reviewloom.operators.clean import clean_dedup, clean_text, dedup_text
from reviewloom.params import WHITESPACE, Params

SOME = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "ordinal bigint, text string")


def cleaned(spark, texts, **kw):
    rows = clean_text(frame(spark, texts), **kw).orderBy("ordinal").collect()
    return {r.ordinal: r.text for r in rows}


def expected_clean(text, min_chars=30):
    """Plain Python: strip, length, replacements, blanks, strip, NFKC."""
    if text is None:
        return None
    text = text.strip()
    if len(text) < min_chars:
        return None
    for old, new in [("\xa0", " "), ("+", ""), ("\x0b", " "), ("“", '"'), ("’", "'")]:
        text = text.replace(old, new)
    return unicodedata.normalize("NFKC", re.sub(r"\s+", " ", text).strip())


def expected_chunks(text, size=1000, overlap=200, min_size=230):
    """The sliding window written as positions."""
    if not text:
        return []
    if len(text) <= size:
        return [(0, text)]
    step, out = size - overlap, []
    for i, at in enumerate(range(0, len(text), step)):
        if i == 0:
            out.append((0, text[:size]))
        elif len(text) - at + overlap > min_size:
            out.append((i, text[max(0, at - overlap) : at - overlap + size]))
    return out


def test_whitespace_list_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_stable_characters_need_no_nfkc(spark):
    java = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: "\\u" + m[1], T._NFKC_STABLE))
    stable = [c for c in map(chr, range(0x110000)) if java.match(c)]
    for c in stable:
        assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c), hex(ord(c))
        # no character of the class may join with an earlier one
        assert unicodedata.normalize("NFKC", "e" + c) == "e" + c
    df = spark.createDataFrame([(c,) for c in stable] + [("\xa0",), ("ﬁ",), ("a\u0301",)], "c string")
    assert df.filter(~F.col("c").rlike(T._NFKC_STABLE)).count() == 3


def test_null_and_short_text_goes(spark):
    texts = [None, "x" * 29, "x" * 30, "  " + "y" * 29 + "  "]
    assert cleaned(spark, texts) == {2: "x" * 30}


def test_length_is_tested_before_blanks_are_squeezed(spark):
    text = "abcde" + " " * 20 + "fghij"
    assert cleaned(spark, [text]) == {0: "abcde fghij"}


def test_replacements(spark):
    assert cleaned(spark, ["a+b \x0b \xa0 “x” ‘y’"], min_chars=1) == {0: "ab \"x” ‘y'"}


def test_unicode_blanks(spark):
    assert cleaned(spark, ["\u2003\u3000a\x1c\x85\u2003b\u3000"], min_chars=1) == {0: "a b"}


def test_nfkc(spark):
    assert cleaned(spark, ["ﬁ Ａ ① e\u0301"], min_chars=1) == {0: "fi A 1 é"}


def test_only_plus_signs_leave_empty_text_without_chunk(spark):
    df = clean_text(frame(spark, ["+" * 30]))
    assert df.count() == 1
    assert chunk(df).count() == 0


@SOME
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0")), max_size=20))
def test_cleaning_equals_python(spark, texts):
    want = {i: expected_clean(t, 3) for i, t in enumerate(texts)}
    assert cleaned(spark, texts, min_chars=3) == {i: t for i, t in want.items() if t is not None}


def test_first_row_of_a_text_stays(spark):
    df = spark.createDataFrame(
        [(5, "a", "same"), (2, "b", "same"), (3, "b", "other")], "ordinal int, business string, text string"
    )
    kept = {(r.ordinal, r.business) for r in dedup_text(df).collect()}
    assert kept == {(2, "b"), (3, "b")}


def test_dedup_without_order_uses_the_review_id(spark):
    df = spark.createDataFrame([("r2", "t" * 40), ("r1", "t" * 40)], "review_id string, text string")
    assert [r.review_id for r in clean_dedup(df).collect()] == ["r1"]


LENGTHS = [1, 799, 800, 801, 999, 1000, 1001, 1600, 1601, 1630, 1631, 2400, 2430, 2431, 5000, 70_000]


def test_chunks_at_the_boundaries(spark):
    texts = ["".join(chr(97 + i % 26) for i in range(n)) for n in LENGTHS]
    rows = chunk(frame(spark, texts)).collect()
    got = {i: sorted((r.chunk_index, r.chunk) for r in rows if r.ordinal == i) for i in range(len(texts))}
    assert got == {i: expected_chunks(t) for i, t in enumerate(texts)}
    counts = {n: len(got[LENGTHS.index(n)]) for n in (1000, 1001, 1600, 1601, 1630, 1631)}
    assert counts == {1000: 1, 1001: 2, 1600: 2, 1601: 2, 1630: 2, 1631: 3}


def test_first_mode_is_the_leading_chunk(spark):
    texts = ["x" * n for n in (1000, 1001, 1631)]
    rows = chunk(frame(spark, texts), mode="first").collect()
    assert [(r.chunk_index, len(r.chunk)) for r in rows] == [(0, 1000)] * 3


def test_chunks_count_code_points(spark):
    rows = chunk(frame(spark, ["😀" * 1001])).orderBy("chunk_index").collect()
    assert [len(r.chunk) for r in rows] == [1000, 401]


@SOME
@given(
    st.lists(st.text(alphabet="ab \n😀é", max_size=80), max_size=10),
    st.sampled_from([(10, 2, 3), (10, 5, 4), (7, 0, 1), (20, 4, 6), (10, 7, 8), (9, 8, 8)]),
)
def test_chunks_equal_python(spark, texts, sizes):
    size, overlap, least = sizes
    rows = chunk(frame(spark, texts), size=size, overlap=overlap, min_size=least).collect()
    for i, text in enumerate(texts):
        got = sorted((r.chunk_index, r.chunk) for r in rows if r.ordinal == i)
        assert got == expected_chunks(text, size, overlap, least)


def test_chunk_ids_are_unique_per_review_and_columns_can_be_renamed(spark):
    df = spark.createDataFrame(
        [("r", "b", "n", 4.0, "d", "x" * 2000)],
        "rid string, bid string, nm string, st double, dt string, body string",
    )
    p = Params(col_review="rid", col_entity="bid", col_name="nm", col_stars="st", col_date="dt", col_text="body")
    rows = review_chunks(df, p).orderBy("chunk_index").collect()
    assert [r.chunk_id for r in rows] == ["r_0", "r_1", "r_2"]
    assert [r.n_chars for r in rows] == [1000, 1000, 600]


def test_first_sentence_and_one_line(spark):
    row = spark.range(1).select(
        T.first_sentence(F.lit("Good. Bad!")).alias("a"),
        T.first_sentence(F.lit("no end")).alias("b"),
        T.one_line(F.lit(" x\ny\n")).alias("c"),
    ).first()
    assert tuple(row) == ("Good.", "no end", "x y")
