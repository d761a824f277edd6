"""Costly texts are worked out once a row: no filter of the plan holds a copy of how they are made."""

import re

from pyspark.sql import functions as F

from tabularium.functions.text import once
from tabularium.operators import audits as A
from tabularium.operators import rows as G

RULES = {"t": G.RuleSet(categories=(G.SectionRule("resultados", "Resultados"),), types=(G.SectionRule("brancos", "QAQC"),))}


def filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if re.match(r"[\s:+|-]*Filter ", line)]


def pages(spark):
    tables = "array<array<array<string>>>"
    rows = [(1, "t", 1, "Resultados", [[["Resultados"], ["a", "1"], ["b", "2"]]]), (2, "t", 1, None, [[["x  y", "1"], ["z", None], ["w", "3"]], None, []])]
    return spark.createDataFrame(rows, f"doc_id long, template_id string, page_no int, text string, tables {tables}").repartition(2)


def test_once_is_a_value_a_row(spark):
    df = once(spark.range(3), {"a": F.col("id") * 2, "b": F.when(F.col("id") > 0, "x")})
    assert sorted(map(tuple, df.collect())) == [(0, 0, None), (1, 2, "x"), (2, 4, "x")] and df.columns == ["id", "a", "b"]
    assert once(df, {"a": F.col("a") + 1}).where("id = 1").first()["a"] == 3


def test_filter_of_unmapped_tables_makes_no_texts(spark):
    own = pages(spark)
    found = A.unmapped_tables(own, own.limit(0).select("doc_id", "page_no", F.lit(1).alias("tabela_indice")), ["resultados"])
    assert [(r["doc_id"], r["titulo_detectado"]) for r in found.collect()] == [(2, "x y | 1")]
    assert not [f for f in filters(found) if "regexp_replace" in f]


def test_filter_of_events_makes_no_titles(spark):
    found = G.events(pages(spark), RULES)
    assert [r["secao"]["categoria"] for r in found.where("secao is not null").orderBy("tabela_indice").collect()] == ["Resultados"] * 2
    assert filters(found) and not [f for f in filters(found) if "regexp_replace" in f]
