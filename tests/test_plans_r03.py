"""What a stage computes once, told from its plan."""

from pyspark.sql import functions as F

from tabularium.operators import audits as A
from tabularium.operators import reconcile as R
from tabularium.operators import rows as G
from tabularium.queries import QUERIES
from tabularium.sources import sinks

RULES = {"t": G.RuleSet(categories=(G.SectionRule("^secao", "c"), G.SectionRule("^outra", "d")), subcategories=(G.SectionRule("^sub", "c", "s"),))}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def pages(spark, *texts):
    rows = [("d", "t", i, text, None) for i, text in enumerate(texts, 1)]
    return spark.createDataFrame(rows, "doc_id string, template_id string, page_no int, text string, tables array<array<array<string>>>")


def test_decimal_places_are_counted_once(spark):
    df = spark.createDataFrame([(7.1, "7,100"), (0.5, None)], "v double, s string")
    made = df.select(sinks.scaled(F.col("v"), F.col("s")).alias("t"))
    assert [r.t for r in made.collect()] == ["7.100", "0.5"]
    assert plan(made).count("regexp_extract_all") == 1


def test_each_form_of_a_date_is_named_once(spark):
    texts = ["2024-03-05T10:30:15", "2024-03-05t10:30:15", "2024-03-05 10:30:15", "2024-03-05", "05/03/2024 10:30:15", "05/03/2024 10:30", "05/03/2024", "2024-03-05 10:30", "05/03/24", "2024-13-05", "ontem", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r.d) if r.d else None for r in df.select(R.parse_date(F.col("t")).alias("d")).collect()]
    assert got == ["2024-03-05 10:30:15"] * 3 + ["2024-03-05 00:00:00", "2024-03-05 10:30:15", "2024-03-05 10:30:00", "2024-03-05 00:00:00"] + [None] * 6
    # a text is tried in one form at most: the forms stand behind conditions, none of which is the whole date's prefix alone
    shown = plan(df.select(R.parse_date(F.col("t")).alias("d")))
    assert shown.count("yyyy-MM-dd HH:mm:ss") >= 2 and ":" in shown


def test_pages_are_read_once(spark):
    df = pages(spark, "Secao", "x")
    for made in (G.events(df, RULES), G.left_to_next_page(df, RULES)):
        assert plan(made).count("LogicalRDD") == 1


def test_the_section_left_is_that_named_last(spark):
    left = lambda text: [(r.secao.categoria, r.secao.subcategoria) for r in G.left_to_next_page(pages(spark, text, ""), RULES).collect()]
    assert left("Sub\nSecao") == [("c", "s")] and left("Sub\nOutra\nSecao") == [("c", None)] and left("Secao\nSub\nx") == [("c", "s")] and left("x") == []


def test_sections_are_made_once_for_the_audit(spark):
    df = spark.createDataFrame([("d", "t", 1, "Parâmetro Resultado\nUnidade", [[["Secao"], ["a", "1"]]])], "doc_id string, template_id string, page_no int, text string, tables array<array<array<string>>>")
    shown = plan(A.table_audit(G.sections(df, RULES), RULES))
    assert shown.count("Join Inner") == 1 and shown.count("Join") == 1 and "Union" not in shown


def test_a_heading_in_two_spellings(spark, tmp_path):
    rows = [(1, "<p>MÉTODOS DE ANÁLISE</p>"), (3, "<p>Outro Texto</p><p>Straße Groß</p>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r.page_id, r.titulo): (r.uma_grafia, r.ocorrencias) for r in QUERIES["heading_discovery"](spark, str(tmp_path)).collect()}
    assert got == {(1, "metodos de analise"): (False, 2), (3, "metodos de analise"): (True, 1), (3, "outro texto"): (True, 1), (3, "straße groß"): (True, 1)}
