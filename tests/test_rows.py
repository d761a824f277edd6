from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tabularium.operators import rows as G

RULES = G.RuleSet(
    categories=(G.SectionRule("resultados analiticos", "Resultados"), G.SectionRule("fisico", "Fisico-quimico")),
    subcategories=(G.SectionRule("^metais dissolvidos", "Resultados", "Metais dissolvidos"),),
    types=(G.SectionRule("brancos? de", "QAQC", tipo_registro="BRANCO", extrair_subcategoria=True),),
    continuations=((r"^CQ-\d+", "BRANCO"), (r"^DUP-\d+", "DUPLICATA")),
    layouts={"AMOSTRA": {"resultado": 1, "unidade": 2, "lq": 3}},
)
HEADER = ["Análise", "Resultado", "Unidade", "LQ", "Data de início"]
METAL = lambda name, value: [name, value, "mg/L", "0,1", "02/02/2024"]


@pytest.fixture
def read(spark):
    def run(pages, rules=RULES):
        rows = [("d", "t", i, text, tables) for i, (text, tables) in enumerate(pages, 1)] + [("other", "u", 1, "Resultados analíticos", [[HEADER, METAL("x", "1")]])]
        df = spark.createDataFrame(rows, "doc_id string, template_id string, page_no int, text string, tables array<array<array<string>>>")
        return G.result_rows(G.sections(df, {"t": rules}), {"t": rules}).orderBy("seq").collect()

    return run


def test_sections_and_layouts_are_carried_over_pages(read):
    got = read(
        [
            ("Relatório Analítico 12/2024.5\nResultados analíticos", [[["Metais dissolvidos"], HEADER, ["Ferro", "< 0,5", "mg/L", "0,5", "01/02/2024"], ["Data coleta 1", "2"]]]),
            ("", [[METAL("Zinco", "0,7"), METAL("Cobre", "0,2")]]),
            ("", [[["CQ-1", "3", "mg/L"], ["CQ-2", "x", "mg/L"]]]),
        ]
    )
    # the general title at the foot of page 1 starts the next page afresh, so the subcategory is no longer there
    assert [(r.parametro, r.subcategoria, r.tipo_registro, r.resultado, r.codigo_laudo, r.pagina, r.tabela_indice) for r in got] == [
        ("Ferro", "Metais dissolvidos", "AMOSTRA", "< 0,5", "12/2024.5", 1, 1),
        ("Zinco", None, "AMOSTRA", "0,7", "12/2024.5", 2, 1),
        ("Cobre", None, "AMOSTRA", "0,2", "12/2024.5", 2, 1),
        ("CQ-1", "Resultados", "BRANCO", "3", "12/2024.5", 3, 1),
    ]
    assert got[0].data_inicio == "01/02/2024" and {r.doc_id for r in got} == {"d"}


def test_titles(read):
    tables = lambda *firsts: [("", [[[f], HEADER, METAL("p", "1")] for f in firsts])]
    state = lambda *firsts, rules=RULES: [(r.categoria, r.subcategoria, r.tipo_registro) for r in read(tables(*firsts), rules)]
    metals = ("Resultados", "Metais dissolvidos", "AMOSTRA")
    assert state("Metais dissolvidos", "Resultados Analíticos", "nada") == [metals, metals, metals]  # a general title keeps a subcategory
    assert state("Ensaio - Físico", "Físico") == [("Fisico-quimico", "Ensaio - Físico", "AMOSTRA")] * 2
    assert state("Lab X - Físico", rules=replace(RULES, outside_labs=("lab x",))) == [("Fisico-quimico", None, "AMOSTRA")]
    assert state("Branco de campo - x", "Metais dissolvidos") == [("QAQC", "Branco de campo - x", "BRANCO"), metals]
    assert state("Metais dissolvidos", "Físico", "Resultados analíticos") == [metals, ("Fisico-quimico", None, "AMOSTRA"), ("Resultados", None, "AMOSTRA")]
    assert state("nada") == []


def test_marks_inside_tables_count_only_where_the_table_is_read(read):
    inner = [["a", "b"], ["c", "d"], ["Metais dissolvidos"], HEADER, METAL("Ferro", "1")]
    # without a section the first table is not read, nor the title and header inside it; so the second has no section
    assert read([("", [inner, [METAL("Zinco", "1"), METAL("Cobre", "2")]])]) == []
    # with a section it is read where a header stands high enough, and its inner title then holds for the next table
    first = [HEADER, METAL("Ferro", "1"), ["Metais dissolvidos"], METAL("Zinco", "2")]
    got = read([("", [[["Resultados analíticos"], *first], [METAL("Cobre", "3"), METAL("Prata", "4")]])])
    assert [(r.parametro, r.subcategoria) for r in got] == [("Ferro", None), ("Zinco", "Metais dissolvidos"), ("Cobre", "Metais dissolvidos"), ("Prata", "Metais dissolvidos")]
    # a chain: each table's reading hangs on a title inside the one before
    chain = [[["Físico"], HEADER, METAL("A", "1"), ["Branco de x - y"]], [METAL("B", "1"), METAL("C", "1"), ["Metais dissolvidos"]], [["CQ-1", "5"], ["Metais dissolvidos"], METAL("D", "2")], [METAL("E", "1"), METAL("F", "1")]]
    assert [(r.parametro, r.tipo_registro) for r in read([("", chain)])] == [("A", "AMOSTRA"), ("CQ-1", "BRANCO"), ("D", "AMOSTRA"), ("E", "AMOSTRA"), ("F", "AMOSTRA")]


def test_quality_control_goes_on(read):
    got = read([("", [[["Físico"], HEADER, METAL("A", "1")], [["CQ-1", "1"]], [["DUP-1", "2"]], [["Físico"], HEADER, METAL("B", "3")]])])
    # the first quality-control type holds, with the category as subcategory, which a general title then keeps
    assert [(r.parametro, r.subcategoria, r.tipo_registro) for r in got] == [("A", None, "AMOSTRA"), ("CQ-1", "Fisico-quimico", "BRANCO"), ("DUP-1", "Fisico-quimico", "BRANCO"), ("B", "Fisico-quimico", "BRANCO")]


def test_headers(read):
    own = ["Análise", "Unidade", "Resultado"]
    got = read([("", [[["Físico"], own, ["A", "mg/L", "7"]], [["Físico"], ["Parâmetros", "Resultado (mg/L)", "x"], ["B", "8", "9"]], [["x", "y", "5", "z", "w"], ["x2", "y", "6", "z", "w"]]])])
    # a header's layout holds for the tables after it; "Resultado (mg/L)" makes no header
    assert [(r.parametro, r.resultado, r.unidade_resultado) for r in got] == [("A", "7", "mg/L"), ("x", "5", "y"), ("x2", "6", "y")]
    assert read([("", None), ("", [None, [], [[]], [None]])]) == []


def test_measured_cells_are_looked_at_once(spark):
    df = spark.createDataFrame([([["a", "1", "x", "2", "y"], ["  ", "1", "1", "1", "1"], ["ß", "<3", None, "", "4"], ["b", "1"]],), ([],)], "rows array<array<string>>")
    made = df.select(G._measured(F.col("rows")).alias("m"))
    assert [r.m for r in made.collect()] == [[0, 2, 0, 1, 1], []]
    assert made._jdf.queryExecution().optimizedPlan().toString().count(G.MEASURED) == 1
