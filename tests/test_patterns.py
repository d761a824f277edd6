import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.functions import patterns as R
from tabularium.operators import classify as C
from tabularium.operators import sections as S


@pytest.mark.parametrize(
    "pattern,text",
    [(r"nota \(x\)", "uma NOTA (x) aqui"), (r"(?P<v>ab[c\]])d", "xabcd"), (r"nota(?:: (\w+))?", "nota: um nota"), (r"nota:\s*(\w*)", "nota: \nnota: b"), (r"a{,2}b{x}", "aab{x}"), (r"[a[&&]+z\Z", "q[&a&&z"), (r"(?P<q>['\"])(\w+)(?P=q)", "diz 'um' e \"dois\""),
     (r"x(?#comment)(y)?", "xy x"), (r"(a)|(b)", "ba"), (r"[]a]+(b)?", "]ab a"), (r"sem grupo", "Sem Grupo sem grupo")],
)
def test_values_are_what_python_finds(spark, pattern, text):
    r = R.rule(pattern)
    want = []
    for m in re.finditer(pattern, text, re.IGNORECASE | re.DOTALL):
        value = m.group(1) if m.lastindex else m.group(0)
        want.append(" ".join(value.split()) or None if value is not None else None)
    got = spark.createDataFrame([(text,)], "t string").select(r.values(F.col("t")), r.value(F.col("t")), r.count(F.col("t"))).first()
    if pattern != "(a)|(b)":  # of several groups that exclude each other, a match without the first counts whole
        assert got[0] == want and got[1] == want[0]
    assert got[2] == len(want) and r.groups == re.compile(pattern).groups


def test_faults(spark):
    assert R.faults("nota") is None and R.faults(r"(?P<a_b>x)") is None
    assert R.faults("(").startswith("python") and "hangs" in R.faults(r"(a)?(?(1)b|c)") and R.faults(r"(?<=a+)b").startswith("python")
    with pytest.raises(R.PatternFault):
        R.rule("[")


def test_sections_of_odd_rules(spark):
    pages = spark.createDataFrame([(1, 1, "nota (x)\nabc\nchave: K1")], "doc_id int, page_no int, text string")
    found = S.section_matches(pages, [("a", r"nota \(x\)"), ("b", "(?P<v>ab)c"), ("c", r"chave(?:_(\d))?")])
    assert {(r.campo, r.valor) for r in found.collect()} == {("a", "nota (x)"), ("b", "ab"), ("c", "chave")}
    audit = S.field_audit(pages, [("s", "a", r"(?P<v>nota)"), ("s", "b", "abc"), ("s", "c", "zzz")]).collect()
    assert {(r.campo, r.valor_extraido, r.pagina, r.status) for r in audit} == {("a", "nota", 1, "ok"), ("b", "abc", 1, "ok"), ("c", None, None, "nao_aplicavel")}


def test_literals():
    assert R.literals("licen[sc]e under") == ("e under",) and R.literals("token|password") == ("token", "password")
    assert R.literals(r"\bthe\b") == ("the",) and R.literals("abc?d{2}efg+h") == ("efg",) and R.literals(r"a\.b\.c") == ("a.b.c",)
    assert R.literals("[0-9]{20}") == () and R.literals("ab|token") == () and R.literals("(?x)a b c d") == () and R.literals("água") == ("gua",)


@settings(max_examples=300, deadline=None)
@given(st.text("ab(|)[c].*+?\\d", max_size=12), st.text("abcd. ", max_size=14))
def test_a_match_holds_a_literal(pattern, text):
    try:
        found = re.compile(pattern, re.IGNORECASE).search(text)
    except (re.error, RecursionError):
        return
    if found and (needed := R.literals(pattern)):
        assert any(x in text.lower() for x in needed)


def test_every_pattern_stands_once_in_the_plan(spark):
    rules = [C.DetectionRule("t" if i % 2 else "u", kind, f"word{i}[sz]", 9.0) for i, kind in enumerate(["required", "positive", "positive", "negative"] * 40)]
    docs = spark.createDataFrame([(1, "word0s word4z"), (2, "WORD1S word5z word9s"), (3, None)], "doc_id int, text string")
    done = C.classify(docs, [C.Template("t", 1), C.Template("u", 1)], rules)
    for df in (done, C.classification_audit(done, "doc_id"), C.classification_summary(done, "doc_id"), C.winners(done, [C.Template("t")])):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == len(rules)
    assert done.count() == 3
    odd = spark.createDataFrame([(1, "Kılo"), (2, "ſum"), (3, "kilo")], "doc_id int, text string")
    hit = C.classify(odd, [C.Template("k", 1)], [C.DetectionRule("k", "positive", "kilo", 5), C.DetectionRule("k", "positive", "sum", 5)])
    assert {r.doc_id for r in hit.where("template_id = 'k'").collect()} == {1, 2, 3}
