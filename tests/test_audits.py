import pytest

from tabularium.operators import audits as A
from tabularium.operators import rows as G

RULES = {"t": G.RuleSet(categories=(G.SectionRule("^secao", "c"),), layouts={"AMOSTRA": {"resultado": 1, "unidade": 2, "lq": 3}})}
ROW = ["Ferro", "0,5", "mg/L", "0,1", "x"]
HEAD = ["Análise", "Resultado", "Unidade", "LQ"]


@pytest.fixture(scope="module")
def audited(spark):
    """Audit rows of tables, each in a document of its own, whose first row names the section."""

    def run(*cases):
        rows = [(i, "t", 1, text, [[["Seção"], *own] for own in tables]) for i, (text, *tables) in enumerate(cases)]
        df = spark.createDataFrame(rows, "doc_id int, template_id string, page_no int, text string, tables array<array<array<string>>>")
        return A.table_audit(G.sections(df, RULES), RULES).orderBy("doc_id", "tabela_indice").collect()

    return run


def test_table_statuses(audited):
    wide, bare = [ROW, ROW], ["x"]
    cases = {
        "ok": (None, [HEAD, ROW]),
        "ok_com_opcional_ausente": (None, [HEAD[:3], ROW]),
        "alerta_descoberta": (None, [[*HEAD, "Cor"], ROW]),
        "alerta_descoberta_com_opcional_ausente": (None, [[*HEAD[:2], "Cor"], ROW]),
        "fallback_layout_confiavel": (None, wide),
        "fallback": (None, [*wide, bare, bare]),
        "fallback_cabecalho_texto_layout_confiavel": ("Parâmetros Resultados\nUnidade LQ", wide),
        "fallback_cabecalho_texto_layout_incompleto": ("Parâmetros Resultados\nUnidade LQ", [*wide, bare]),
    }
    assert [r.status for r in audited(*cases.values())] == [*cases]


def test_header_details(audited):
    (got,) = audited((None, [[*HEAD[:2], "Cor"], ROW]))
    assert got.colunas_mapeadas == "Análise -> parameter; Resultado -> resultado" and got.colunas_sem_mapeamento == "Cor" and got.campos_opcionais_ausentes == "unidade; lq"
    assert got.campos_esperados == "parameter; resultado; unidade; lq" and got.cabecalho_detectado == "Análise | Resultado | Cor" and not got.usou_fallback


def test_page_headers(audited):
    # of windows that name as much the shortest counts, of those the first; fields stand as the text has them
    text = "LQ da unidade\nAnálise e unidade e resultado\nResultado e unidade e análise"
    (got,) = audited((text, [ROW, ROW]))
    assert got.cabecalho_detectado == "LQ da unidade Análise e unidade e resultado" and got.campos_esperados == "lq; unidade; parameter; resultado" and got.usou_fallback
    (got,) = audited(("Resultado e unidade e análise\nanálise e unidade e resultado", [ROW, ROW]))
    assert got.campos_esperados == "resultado; unidade; parameter"
    # a header read before gives the layout, whatever the page says
    got = audited((text, [["Análise", "Unidade", "Resultado"], ["p", "mg/L", "1"]], [["a", "b", "1", "d", "e"], ["a", "b", "2", "d", "e"]]))
    assert (got[1].cabecalho_detectado, got[1].campos_esperados, got[1].status) == (None, "parameter; unidade; resultado", "fallback_layout_confiavel")


def test_sections_and_tables(spark):
    docs = spark.createDataFrame([(1, "Notas\nx"), (2, "nada"), (3, "Notas\nsem notas")], "doc_id int, text string")
    extracted = spark.createDataFrame([(1, "notes", 2), (2, "notes", 1)], "doc_id int, secao string, registros int")
    got = {r.doc_id: r.status for r in A.known_sections(docs, {"notes": (["^notas"], ["sem notas"])}, extracted).collect()}
    assert got == {1: "ok", 2: "extraida_sem_titulo", 3: "nao_aplicavel"}
    pages = spark.createDataFrame([(1, 1, [[["a", "b"], ["c", "d"]], [["a", "b"], ["c", "d"]], [["licença", "b"], ["c", "d"]], [["so"], ["uma"]]])], "doc_id int, page_no int, tables array<array<array<string>>>")
    audited = spark.createDataFrame([(1, 1, 1)], "doc_id int, page_no int, tabela_indice int")
    assert [(r.tabela_indice, r.titulo_detectado) for r in A.unmapped_tables(pages, audited, ["licença"]).collect()] == [(2, "a | b")]
