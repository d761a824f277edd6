import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.functions import measures as M
from tabularium.functions import text as X

MEASURES = [
    ("Máx. 75 mgPt/L", False, ("max", None, 75.0, "mgPt/L")),
    ("2,00 - 12,00", False, (None, 2.0, 12.0, None)),
    ("< 20 %", True, ("<", 20.0, 20.0, "%")),
    ("75 a 125 %", False, (None, 75.0, 125.0, "%")),
    ("mín. 5,0 mg/L", False, ("min", 5.0, None, "mg/L")),
    (">= 3", False, (">=", 3.0, None, None)),
    ("1.234,5 µg/L", False, (None, 1234.5, 1234.5, "µg/L")),
    ("10 UFC/100 mL", False, (None, 10.0, 10.0, "UFC/100 mL")),
    ("NA", False, (None, None, None, None)),
    ("nd", False, (None, None, None, None)),
    (None, False, (None, None, None, None)),
    ("Ausente", False, (None, None, None, None)),
]


def test_measures(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(MEASURES)]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: (tuple(r.one), tuple(r.both)) for r in M.parse_measures(df, {"one": F.col("t"), "both": F.col("t")}, both=("both",)).collect()}
    for i, (text, both, want) in enumerate(MEASURES):
        assert got[i][both] == want, text


@pytest.mark.parametrize(
    "text,unit,want",
    [("1,2 x 10 3 UFC/mL", None, (1200.0, None, "UFC/mL")), ("< 0,5", "mg/L", (0.5, "<", "mg/L")), ("-19,5", None, (-19.5, None, None)), ("NA", "mg/L", (None, None, "mg/L")), ("7", "palmos", (7.0, None, None)), ("2 x 10 12", None, (2e12, None, None))],
)
def test_results(spark, text, unit, want):
    row = M.parse_results(spark.createDataFrame([(text, unit)], "t string, u string"), {"r": (F.col("t"), F.col("u"))}).first().r
    assert tuple(row) == want


def test_loose_units_and_notes(spark):
    df = spark.createDataFrame([("5 palmos", False), ("5 a 7", False), ("3,7 mg/L para pH <= 7,5; 2,0 mg/L para pH > 8", True)], "t string, note boolean")
    got = df.select(M.has_loose_unit(F.col("t")).alias("u"), (M.is_complex_note(F.col("t")) == F.col("note")).alias("n")).collect()
    assert [r.u for r in got][:2] == [True, False] and all(r.n for r in got)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_characters="\x1c\x1d\x1e\x1f", exclude_categories=("Cs", "Cc")), max_size=30), min_size=20, max_size=40))
def test_fold_equals_unicode(spark, texts):
    def spec(x):
        plain = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        return " ".join(plain.split()).casefold()

    # letters that decompose into several characters, or have none of their own, are beyond a table of single letters
    single = lambda x: all(len("".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))) == 1 and len(ch.casefold()) == len(ch.lower()) == 1 and ch.casefold() == ch.lower() for ch in x)
    texts = [t for t in texts if single(t)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.fold(F.col("t")).alias("f")).collect() if texts else []
    assert {r.i: r.f for r in got} == {i: spec(t) for i, t in enumerate(texts)}


def test_small_text_functions(spark):
    df = spark.createDataFrame([("  Água  Bruta ", "1.234,5", "3,5 x 10 2")], "a string, n string, s string")
    r = df.select(X.fold(F.col("a")).alias("f"), X.token(F.col("a")).alias("t"), X.pt_number(F.col("n")).alias("n"), X.scaled_number(F.col("s")).alias("s"), X.cell(F.array(F.lit(" x  y "), F.lit(None)), F.lit(0)).alias("c"), X.cell(F.array(F.lit("x")), F.lit(3)).alias("out")).first()
    assert (r.f, r.t, r.n, r.s, r.c, r.out) == ("agua bruta", "agua_bruta", 1234.5, 350.0, "x y", None)


def test_the_plan_does_not_grow_with_the_measures(spark):
    df = spark.createDataFrame([("< 1,5 mg/L",)], "t string")
    plans = [M.parse_measures(df, {f"m{i}": F.col("t") for i in range(n)})._jdf.queryExecution().optimizedPlan().toString() for n in (1, 7)]
    assert plans[0].count("regexp_extract(") == plans[1].count("regexp_extract(") > 0
