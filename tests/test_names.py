"""Names: golden scores, normal forms, awards, stems."""

import difflib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestone.functions import names, similarity


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("drop", [True, False])
def test_normalize(spark, drop):
    given = ["Data Science BSc (Hons)", "Equine Science 7G73 MSc", "Data Science (with integrated year in industry)", "Diploma of Leadership BSB50420", "Café & Bar Studies (BA, 3 years, full-time)", "", None]
    want = ["data science", "equine science", "data science integrated year industry", "diploma leadership", "cafe bar studies"]
    if not drop:
        want = ["data science bsc", "equine science msc", want[2], want[3], "cafe bar studies ba"]
    assert values(spark, [(x,) for x in given], names.normalize_name(F.col("x"), drop)) == [*want, "", ""]


def test_folding_is_that_of_unicode(spark):
    given = ["ﬁnance ½ №5 ™", "Ærøskøbing Łódź", "ⅷ ⑫ ㏎ ﷺ", "İstanbul ǆ ŀ", "naïve café Ａ１", "हिन्दी क़", "𝒜𝟙 🄰", "“q” ‘s’", "plain"]
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s.translate(str.maketrans("‘’“”", "\'\'\"\""))) if not unicodedata.combining(c))
    assert values(spark, [(x,) for x in given], names.ascii_fold(F.col("x"))) == [plain(x) for x in given]


def test_course_codes(spark):
    tokens = ["7g73", "q300", "bsb50420", "22627vic", "r1160520", "bsbb0120", "10299173", "3d", "year"]
    found = values(spark, [(t,) for t in tokens], names.is_course_code(F.col("x")))
    assert found == [True] * 4 + [False] * 5


def test_awards_and_levels(spark):
    given = ["Graduate Diploma of Law", "MAg Agriculture", "Bachelor of Arts", "BSc and MSc Physics", "Certificate III in Care", "Welding"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(given)], "k int, x string").select("k", names.award_classes(F.col("x")).alias("c"), names.award_tokens(F.col("x")).alias("t"), names.level_of(F.col("x")).alias("l"))
    got = [(r["c"], r["t"], r["l"]) for r in rows.orderBy("k").collect()]
    assert got == [
        (["diploma", "pgcert"], [], None),
        (["integrated_masters"], ["magr"], "ug"),
        (["bachelor"], [], "ug"),
        (["bachelor", "masters"], ["bsc", "msc"], None),
        (["vet_certificate"], [], "ug"),
        ([], [], None),
    ]


def test_stems_and_siblings(spark):
    a = ["Anthropology BA (Hons)", "Anthropology BA (Hons)", "Mathematics BSc", "Agriculture", "MBA"]
    b = ["Anthropology with Placement BA (Hons)", "Archaeology and Anthropology BA (Hons)", "Mathematics MSc", "Agriculture (Top-Up) BSc", "MBA"]
    df = spark.createDataFrame(list(zip(range(5), a, b)), "k int, a string, b string")
    sib = names.are_siblings(names.variant_stem(F.col("a")), names.award_classes(F.col("a")), names.variant_stem(F.col("b")), names.award_classes(F.col("b")))
    assert [r[0] for r in df.orderBy("k").select(sib).collect()] == [True, False, False, True, True]


def test_strip_institution(spark):
    rows = [("Aberystwyth University - Data Science BSc", "Aberystwyth University", "Data Science BSc"), ("Student Support | Webster University", "Webster University", "Student Support"), ("Webster University", "Webster University", ""), ("Law at Webster University today", "Webster University", "Law at today"), ("Plain", "", "Plain")]
    df = spark.createDataFrame(rows, "t string, i string, w string")
    assert all(r[0] == r[1] for r in df.select(names.strip_institution(F.col("t"), F.col("i")), "w").collect())


GOLDEN = [
    ("Data Science BSc (Hons)", "Data Science (with integrated year in industry) BSc", None, 0.3759),
    ("Equine Science BSc", "Environmental Science BSc", None, 0.5286),
    ("Equine Science BSc", "Equine Science MRes", "pg", 0.2250),
    ("Equine Science BSc", "Data Science BSc", None, 0.4857),
    ("Agriculture BSc", "Agriculture with Animal Science BSc", None, 0.7000),
    ("MBA", "MBA Master of Business Administration", None, 0.6625),
    ("Anthropology BA", "Anthropology with Placement BA", None, 0.7750),
    ("Anthropology BA", "Archaeology and Anthropology BA", None, 0.7750),
    ("Accounting and Finance BSc", "Accounting, Finance and Economics BSc", None, 0.6975),
    ("Diploma of Leadership and Management BSB50420", "Diploma of Leadership and Management", None, 1.0),
    ("", "x y", None, 0.0),
]


def test_golden_scores(spark):
    df = spark.createDataFrame([(k, a, b, lv) for k, (a, b, lv, _) in enumerate(GOLDEN)], "k int, a string, b string, lv string")
    got = [r["score"] for r in similarity.score_pairs(df, "a", "b", level="lv").orderBy("k").collect()]
    assert got == [g[3] for g in GOLDEN]


def test_sequence_ratio_is_difflibs(spark):
    random.seed(1)
    words = ["".join(random.choice("abcde ") for _ in range(random.choice([3, 20, 250]))) for _ in range(60)]
    pairs = list(zip(words, reversed(words)))
    got = [r[0] for r in spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string").orderBy("k").select(similarity.sequence_ratio("a", "b")).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
