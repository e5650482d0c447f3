import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.functions import cast, edits, encode, similarity, text, wordsets

ABBREVIATIONS = {"STR": "STREET", "STREET": "ST", "AVENUE": "AVE", "PO BOX": "POB", "B/O": "$BO"}


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_address_forms(spark):
    rows = [None, "", "   ", "(C/O X) 12 north main Street", "1..2 Main. str", "a-street", "po box 7", "X b/o y", "CAFÉ NORTHÉ street"]
    got = values(spark, rows, lambda c: text.standardize_street(c, ABBREVIATIONS))
    assert got == [None, "", "", "12 N MAIN ST", "1 2 MAIN ST", "A- ST", "POB 7", "X $BO Y", "CAFÉ NORTHÉ ST"]


def test_street_without_numbers(spark):
    rows = ["10-12 MAIN", "5 MAIN STE 4", "MAIN # 12", "UNIT 3B MAIN", "MAIN FL. 2A REAR", "MAIN FLOOR 2", "1ST MAIN"]
    got = values(spark, rows, lambda c: text.standardize_street_no_numbers(c, ABBREVIATIONS))
    assert got == ["MAIN", "MAIN", "MAIN", "MAIN", "MAIN REAR", "MAIN", "1ST MAIN"]


def test_full_address_skips_nulls(spark):
    df = spark.createDataFrame([("1 Main Street", None, "PA", None), (None, "Erie", None, None)], "a string, b string, c string, d string")
    whole = text.full_address(*[F.col(c) for c in "abcd"])
    got = [r[0] for r in df.select(text.standardize_full_address(whole, ABBREVIATIONS)).collect()]
    assert got == ["1 MAIN ST  PA", "ERIE"]  # the comma goes after spaces were squeezed
    kept = df.select(text.standardize_full_address(whole, ABBREVIATIONS, preserve_commas=True)).first()[0]
    assert kept == "1 MAIN ST , PA"


def test_business_names(spark):
    rows = [None, "AcmeInc", "Zinc", "1st & 3rd Bank", "76 Lube", "The House of X LLC", "A & B, North 11th", "X ltdinc", "Café in"]
    got = values(spark, rows, lambda c: text.standardize_business_name(c, ABBREVIATIONS))
    assert got == [None, "ACME", "Z", "FIRST THIRD BANK", "76 LUBE", "HOUSE X", "A B N 11TH", "X", "CAF"]
    assert values(spark, ["The A B"], lambda c: text.standardize_business_name(c, {}, remove_spaces=True)) == ["AB"]


def test_replacement_chain_is_followed_in_order(spark):
    steps = [("A", "B", False), ("B", "C", True), ("C D", "E", False), ("E", "F", False)]
    assert values(spark, ["A", "x-B", "A D"], lambda c: text.replace_words(c, steps)) == [" C ", "x- C ", " C  D"]
    assert values(spark, ["C D", "A"], lambda c: text.replace_words(c, steps)) == ["F", " C "]


def test_preprocess(spark):
    assert values(spark, [None, " a\t", "b"], text.preprocess) == ["", "a", "b"]


def test_integers(spark):
    rows = ["12", " 12 ", "12.0", "1e3", "", "  ", None, "abc", "12d", "-7", "9007199254740993"]
    got = values(spark, rows, lambda c: cast.as_integer(cast.blank_to_null(c)))
    assert got == [12, 12, 12, 1000, None, None, None, None, None, -7, 9007199254740993]
    assert values(spark, ["1.5"], lambda c: cast.as_integer(c, strict=False)) == [None]
    with pytest.raises(Exception, match="not a whole number"):
        values(spark, ["1.5"], cast.as_integer)


def test_tax_ids(spark):
    rows = [None, " ", "12-3456789", "12 345 6789", "-"]
    assert values(spark, rows, cast.tax_id) == [0, 0, 123456789, 123456789, 0]
    assert values(spark, ["A1"], lambda c: cast.tax_id(c, strict=False)) == [None]
    with pytest.raises(Exception, match="not a tax id"):
        values(spark, ["A1"], cast.tax_id)


def test_zip_defaults_and_placeholders(spark):
    assert values(spark, ["19104-1234", "1910", None, "x123456"], cast.zip5) == ["19104", None, None, "12345"]
    assert values(spark, [None, "", " ", "X"], lambda c: cast.fill_default(c, "M")) == ["M", "M", " ", "X"]
    assert values(spark, ["PA", "pa", "PA ", None], cast.replace_placeholder) == ["MISSING", "pa", "PA ", None]


def test_soundex_keeps_a_first_character_that_is_no_letter(spark):
    rows = ["Robert", "Ashcraft", "Tymczak", "76 LUBE", "", None, "MISSING", "MACUNGIE"]
    assert values(spark, rows, similarity.soundex) == ["R163", "A261", "T522", "7410", "", None, "M252", "M252"]


def lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("AB é😀", max_size=80), st.text("AB é😀", max_size=80)), min_size=1, max_size=30))
def test_lcs_equals_the_table(pairs):
    a, b = zip(*pairs)
    assert edits.lcs_lengths(a, b).tolist() == [lcs_by_table(x, y) for x, y in pairs]


def test_lcs_of_long_texts():
    rng = random.Random(8)
    pairs = [("", "AB"), ("A" * 200, "A" * 130), ("AB" * 63, "BA" * 64)]
    for size in (1, 62, 63, 64, 126, 127, 190, 400):
        one = "".join(rng.choices("AB é😀", k=size))
        pairs += [(one, "".join(rng.choices("AB xé", k=rng.randint(1, 300)))), (one, one[::-1]), (one, one[1:] + "Z")]
    a, b = zip(*pairs)
    assert edits.lcs_lengths(a, b).tolist() == [lcs_by_table(x, y) for x, y in pairs]
    long = "".join(rng.choices("ABCDEFGH", k=5000))
    assert edits.lcs_lengths([long, long], [long[:2000] + "Z" + long[2500:], "Q" + long]).tolist() == [4500, 5000]


def test_indel_scores():
    got = edits.indel_scores(["", "abc", None, "abcd", "abc"], ["", "abc", "x", "abxd", ""])
    assert got.tolist() == [100.0, 100.0, 0.0, 75.0, 0.0]


def test_token_set_scores():
    a = ["mets new york", "abc def", "", "a b", "fuzzy was a bear"]
    b = ["york mets", "abc xyz", "x", "c d", "fuzzy fuzzy was a bear"]
    assert np.allclose(wordsets.token_set_scores(a, b), [100.0, 60.0, 0.0, 100 / 3, 100.0])


def word_set_by_hand(x, y):
    one, two = set(x.split()), set(y.split())
    if not one or not two:
        return 0.0
    both = " ".join(sorted(one & two))
    rests = [" ".join(sorted(w)) for w in (one - two, two - one)]
    if both and not all(rests):
        return 100.0
    full = [f"{both} {r}".strip() for r in rests]
    sides = [full, *([both, f] for f in full if both)]
    return max(100.0 * 2 * lcs_by_table(p, q) / max(len(p) + len(q), 1) for p, q in sides)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("AB é", max_size=30), st.text("AB é", max_size=30)), min_size=1, max_size=30))
def test_word_sets_equal_the_definition(pairs):
    a, b = zip(*pairs)
    got, want = wordsets.token_set_scores(a, b), [word_set_by_hand(x, y) for x, y in pairs]
    # a longer common subsequence may cross the shared part, which the score does not look at
    assert np.all(got <= np.array(want) + 1e-9)
    plain = [k for k, (x, y) in enumerate(pairs) if not set(x.split()) & set(y.split())]
    assert np.allclose(got[plain], np.array(want)[plain])
    assert len(wordsets.token_set_scores([], [])) == 0


def test_native_ratio_agrees(spark):
    random.seed(3)
    rows = [("".join(random.choices("ABC ", k=random.randint(0, 12))), "".join(random.choices("ABC ", k=random.randint(0, 12)))) for _ in range(60)]
    df = spark.createDataFrame(rows + [(None, "x"), ("x", None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    both = df.select(similarity.indel_ratio(a, b).alias("x"), similarity.indel_ratio_native(a, b).alias("y")).collect()
    assert all(abs(r["x"] - r["y"]) < 1e-9 for r in both)


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.5**0.5) and got[1] == 0.0 and got[2] is None


def test_encoder_is_pluggable(spark):
    df = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "t string")
    made = encode.encode_distinct(df, "t", lambda: lambda texts: np.array([[len(t), 1.0] for t in texts])).collect()
    assert sorted((r["t"], r["vector"]) for r in made) == [("a", [1.0, 1.0]), ("bb", [2.0, 1.0])]
    hashed = encode.hashed_trigrams(["ACME", "ACME", ""])
    assert np.allclose(hashed[0], hashed[1]) and np.allclose((hashed**2).sum(axis=1), 1.0)


def test_encoder_gets_bounded_batches(spark):
    def sizes():
        return lambda texts: np.full((len(texts), 1), len(texts), dtype=np.float32)

    df = spark.range(0, 5000, 1, 1).selectExpr("CAST(id AS STRING) AS t").coalesce(1)
    fed = [r["vector"][0] for r in encode.encode_distinct(df, "t", sizes).collect()]
    assert len(fed) == 5000 and max(fed) <= 1024
