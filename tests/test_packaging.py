import pytest

from tabularium.operators.packaging import COLUMNS, PackagingRules, extract_packaging
from tabularium.operators.sections import label_of

RULES = PackagingRules(("embalagens",), ("recipiente",), (r"amostra\s+(\d+ - \w+)",), ("pl[aá]stico|vidro",), (r"\d+\s*mL",))
TABLE = [["Recipiente", "Volume", "Preservação", "Métodos"], ["Plástico", "500 mL", "Gelo", "SM 1"], ["Vidro", "x", "Gelo", "SM 2"], ["Vidro", "1 mL", "", "SM 3"]]
ROW = {"id_amostra": "12", "identificacao_amostra": "12 - poço", "embalagem": "Plástico", "volume": "500 mL", "preservacao": "Gelo", "metodos": "SM 1"}


@pytest.fixture
def found(spark):
    def run(pages, rules=RULES):
        rows = [("d", "t", i, text, tables) for i, (text, tables) in enumerate(pages, 1)]
        df = spark.createDataFrame(rows, "doc_id string, template_id string, page_no int, text string, tables array<array<array<string>>>")
        return [{c: r[c] for c in COLUMNS} for r in extract_packaging(df, {"t": rules}).orderBy("pagina", "tabela_indice", "linha").collect()]

    return run


def test_section_on_the_page_before(found):
    assert found([("Embalagens da amostra 12 - poço", [[["Embalagens"]]]), ("", [TABLE]), ("", [TABLE])]) == [ROW]


def test_header_in_the_page_text_and_name_above_the_header(found):
    assert len(found([("Embalagens\nRecipiente Volume", [TABLE[1:]])])) == 1
    assert [r["id_amostra"] for r in found([("embalagens amostra 9 - x", [[["Amostra 7 - rio"], *TABLE]])])] == ["7"]
    assert [r["id_amostra"] for r in found([("embalagens amostra 9 - x", [[["Amostra 7 - rio"], ["Amostra 8 - mar"], ["x"], *TABLE]])])] == ["8"]
    assert not found([("outra", [TABLE])]) and not found([("embalagens", [TABLE])], PackagingRules())


def test_the_sample_is_carried_until_rows_are_found(found):
    pages = [("Embalagens amostra 12 - poço", None), ("Embalagens", [TABLE]), ("Embalagens", [TABLE, None]), (None, None)]
    assert [r["id_amostra"] for r in found(pages)] == ["12", None]
    # a table that names the section itself is read anywhere, but its page does not hand the section on
    assert [r["id_amostra"] for r in found([("x", [[["Embalagens"], *TABLE]]), ("y", [TABLE])])] == [None]


def test_labels():
    assert label_of(r"Cliente:\s*(.+)") == "Cliente:" and label_of("abc") is None


def test_pages_are_dealt_by_document_before_the_patterns_run(spark):
    df = spark.createDataFrame([(1, "t", 1, "embalagens", [[["x"]]])], "doc_id int, template_id string, page_no int, text string, tables array<array<array<string>>>")
    plan = extract_packaging(df, {"t": PackagingRules(("embalagens",), ("recipiente",), (), ("vidro",), ("ml",))})._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(doc_id" in line]
    # one exchange, which the windows keep, and below it (later in the text) no pattern
    assert len(dealt) == 1 and any("RLIKE" in line for line in plan[: dealt[0]]) and not any("RLIKE" in line for line in plan[dealt[0] :])
