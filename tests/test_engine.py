import json
import zipfile
from collections import Counter
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from tabularium import __main__ as command
from tabularium.functions.text import text_hash
from tabularium.operators import classify as C
from tabularium.operators import duplicates as D
from tabularium.operators.sections import section_matches, validation_keys
from tabularium.operators.validate import validate
from tabularium.plans import batch, store, taxonomy
from tabularium.plans.contracts import RESULTS, RESULTS_CONTRACT
from tabularium.sources import documents, sinks, workbook
from tabularium.streaming import incremental

def test_classification_statuses(spark):
    templates = [C.Template("agua", 50, 1), C.Template("solo", 50, 2)]
    rules = [C.DetectionRule("agua", "required", "água"), C.DetectionRule("agua", "positive", "rio", 60), C.DetectionRule("agua", "negative", "solo"), C.DetectionRule("solo", "positive", "solo", 60)]
    df = spark.createDataFrame([(1, "ÁGUA do rio"), (2, "água e solo"), (3, "rio"), (4, None)], "doc_id int, text string")
    done = C.classify(df, templates, rules)
    assert {r.doc_id: r.template_id for r in done.collect()} == {1: "agua", 2: "solo", 3: None, 4: None}
    audit = {(r.doc_id, r.template_id): (r.status, r.regras) for r in C.classification_audit(done, "doc_id").collect()}
    assert audit[1, "agua"] == ("winner", "required:água; positive:rio")
    assert audit[2, "agua"] == ("negative_matched:solo", "required:água; negative:solo")
    assert audit[3, "agua"][0] == "required_missing:água" and audit[3, "solo"][0] == "below_minimum"


def test_classification_needs_no_shuffle(spark):
    df = C.classify(spark.range(5).select("id", F.lit("x").alias("text")), [C.Template("a")], [C.DetectionRule("a", "positive", "x", 90)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_duplicates(spark):
    rows = [("a.pdf", "/x/a.pdf", "h1", "t1", "k", "1", "s1", False), ("b.pdf", "/x/b.pdf", "h1", "t1", "k", "1", "s1", False), ("c.pdf", "/x/c.pdf", "h3", "t3", "k", "1", "s2", True), ("d.pdf", "/x/d.pdf", "h4", "", "", "", "", False), ("e.pdf", "/x/e.pdf", "h5", "", "z", "9", "s", False)]
    df = spark.createDataFrame(rows, "nome_do_arquivo string, caminho_arquivo string, hash_arquivo string, hash_texto string, chave_laudo string, id_amostra string, assinatura_resultados string, possui_indicador_versao boolean")
    got = {r.nome_do_arquivo: (r.tipo_duplicidade, r.arquivo_referencia) for r in D.duplicate_audit(df).collect()}
    assert got == {"a.pdf": ("duplicado_exato_arquivo", "b.pdf"), "b.pdf": ("duplicado_exato_arquivo", "a.pdf"), "c.pdf": ("possivel_versao_substituta", "a.pdf"), "d.pdf": ("duplicado_textual", "e.pdf"), "e.pdf": ("duplicado_textual", "d.pdf")}
    assert [r[0] for r in D.paths_to_skip(df).collect()] == ["/x/b.pdf"]
    # files without text are labelled, but none is skipped
    empty = df.where("nome_do_arquivo in ('d.pdf', 'e.pdf')").withColumn("hash_texto", text_hash(F.lit(" ")))
    assert D.paths_to_skip(empty).count() == 0 and {r.tipo_duplicidade for r in D.duplicate_audit(empty).collect()} == {"duplicado_textual"}


def test_duplicate_candidates(spark):
    docs = spark.createDataFrame([("a.pdf", "/x/a.pdf", "Cancela e  substitui", "h1"), ("b.pdf", "/x/b.pdf", None, "h2"), ("c.pdf", "/x/c.pdf", "Relatório revisado", "h3")], "nome_do_arquivo string, caminho_arquivo string, text string, hash_arquivo string")
    results = spark.createDataFrame([("a.pdf", "1", "x", "5"), ("a.pdf", "1", "y", "6"), ("b.pdf", "2", "y", "6"), ("b.pdf", "2", "x", "5"), ("c.pdf", "1", "y", "6"), ("c.pdf", "1", "x", "5")], "nome_do_arquivo string, id_amostra string, parameter string, resultado string")
    sample = spark.createDataFrame([("a.pdf", "9", "poço"), ("b.pdf", None, None)], "nome_do_arquivo string, id_amostra string, identificacao_amostra string")
    got = {r.nome_do_arquivo: r for r in D.duplicate_candidates(docs, results, sample).collect()}
    assert [(got[f].id_amostra, got[f].chave_laudo, got[f].possui_indicador_versao) for f in sorted(got)] == [("9", "identificacao_amostra=poço", True), ("2", "id_amostra=2", False), ("1", "id_amostra=1", True)]
    assert got["a.pdf"].assinatura_resultados == got["c.pdf"].assinatura_resultados != got["b.pdf"].assinatura_resultados
    plan = spark.createDataFrame([("/x/a.pdf", "/x/a.pdf"), ("/y/z.pdf", "/x/a.pdf")], "caminho_arquivo string, canonico string")
    again = D.reattached(D.duplicate_candidates(docs, results, sample), plan).collect()
    assert [(r.nome_do_arquivo, r.caminho_arquivo, r.id_amostra) for r in again] == [("z.pdf", "/y/z.pdf", "9")]


def test_sections(spark):
    pages = spark.createDataFrame([(1, 1, "Nota: abc\nChave: FO-ANL-12"), (1, 2, "nota:  abc\nChave: K9")], "doc_id int, page_no int, text string")
    assert [tuple(r) for r in section_matches(pages, [("texto", r"nota:\s*(\w+)", 1)]).collect()] == [(1, "texto", "abc", 1)]
    assert [r.valor for r in validation_keys(pages, r"chave:\s*(\S+)").collect()] == ["K9"]


def valid_row(**changes):
    row = dict.fromkeys(RESULTS) | {"nome_do_arquivo": "a.pdf", "id_taxonomia": "1", "id_amostra": "10", "tipo": "Amostra", "categoria": "c", "parameter": "Ferro", "local": "campo", "resultado": "0,5 mg/L", "acm_resultado_tratado": "0.5", "acm_unidade": "mg/L"}
    return row | changes


@pytest.mark.parametrize(
    "changes,field,kind",
    [({}, None, None), ({"id_amostra": ""}, "id_amostra", "int_type"), ({"id_amostra": "x"}, "id_amostra", "int_parsing"), ({"id_amostra": "1.5"}, "id_amostra", "int_from_float"), ({"tipo": "Outro"}, "tipo", "literal_error"),
     ({"data_inicio": "2024-01-01"}, "data_inicio", "string_pattern_mismatch"), ({"acm_lq_minimo": "abc", "lq": "1"}, "acm_lq_minimo", "float_parsing"), ({"lq": "1 - 2", "acm_lq_minimo": "3", "acm_lq_maximo": "2"}, "__row__", "value_error"),
     ({"acm_ld_minimo": "1"}, "__row__", "value_error"), ({"acm_unidade": None}, "__row__", "value_error"), ({"recuperacao_percentual": "alto"}, "recuperacao_percentual", "value_error")],
)
def test_contract(spark, changes, field, kind):
    df = spark.createDataFrame([tuple(valid_row(**changes)[c] for c in RESULTS)], ", ".join(f"{c} string" for c in RESULTS))
    got = [(r.field, r.type) for r in validate(df, RESULTS_CONTRACT, "results_extract").collect()]
    assert got == ([(field, kind)] if field else [])


def test_contract_columns(spark):
    df = spark.createDataFrame([tuple(valid_row()[c] for c in RESULTS)], ", ".join(f"{c} string" for c in RESULTS))
    assert [(r.field, r.type) for r in validate(df.drop("lq"), RESULTS_CONTRACT, "r").collect()] == [("lq", "missing_column")]
    assert [(r.field, r.type) for r in validate(df.withColumn("sobra", F.lit(1)), RESULTS_CONTRACT, "r").collect()] == [("sobra", "extra_column")]


def tables(spark, **changes):
    data = {
        "item_taxonomia": [(1, 7, "Laudo de água")],
        "template": [(1, 1, "agua", "sim", "1", None, None, None, 1, 50.0)],
        "item_template": [
            (1, 1, "template_detection", "d", "água|agua", "rule_type=positive; peso=60", None),
            (2, 1, "category_alias", "Resultados", "resultados", None, None),
            (3, 1, "layout", "resultado_col", "x", "1", "Amostra"), (4, 1, "layout", "unidade_col", "x", "2", "Amostra"),
            (5, 1, "sample", "id_amostra", r"amostra:\s*(\d+)", None, None), (6, 1, "client", "id_amostra", r"amostra:\s*(\d+)", None, None),
            (7, 1, "client", "cliente", r"cliente:\s*(\w+)", None, None), (8, 1, "notes", "texto", r"nota:\s*(\w+)", None, None),
        ],
        "schema": [(1, 1, "results_extract", "nao")],
        "item_schema": [(1, 1, "results_extract", "nome_do_arquivo", "texto", "nao")],
    } | changes
    return {n: spark.createDataFrame(rows, taxonomy.SCHEMAS[n]) for n, rows in data.items()}


def test_taxonomy_checks(spark):
    taxonomy.check(spark, tables(spark))
    item = (9, 1, "notes", "texto", "(", None, None)
    for changes, said in [({"schema": [(1, 5, "results_extract", "nao")]}, "chave_desconhecida"), ({"item_template": [item]}, "regex invalida"), ({"item_schema": [(1, 1, "results_extract", "lq_minimo", "t", "nao")]}, "sem_prefixo_acm"), ({"template": [(1, 1, "a", "talvez", None, None, None, None, 1, 1.0)]}, "booleano")]:
        with pytest.raises(taxonomy.TaxonomyError, match=said):
            taxonomy.check(spark, tables(spark, **changes))
    with pytest.raises(taxonomy.TaxonomyError, match="ausentes"):
        taxonomy.check_output_model(tables(spark))


TABLE = [["Resultados"], ["Análise", "Resultado", "Unidade"], ["Ferro", "< 0,50 mg/L", "mg/L"], ["Zinco", "1,2 x 10 3", "mg/L"]]
REPORT = "Laudo de água\nAmostra: 12\nCliente: Rio\nNota: ok"
PAGES = "doc_id string, page_no int, text string, tables array<array<array<string>>>, path string, erro string"


def report_pages(spark):
    rows = [("a", 1, REPORT, [TABLE], "/in/a.pdf", None), ("b", 1, "outro", [], "/in/b.pdf", None), ("c", 1, REPORT.replace("de ", "de  "), [TABLE], "/in/c.pdf", None), ("d", None, None, None, "/in/d.pdf", "ValueError: damaged")]
    rows += [("e", n, "Laudo de água" if n == 4 else "outro", [], "/in/e.pdf", None) for n in range(1, 5)]  # in scope by its fourth page only
    return spark.createDataFrame(rows, PAGES)


def test_batch_end_to_end(spark, tmp_path):
    rules = taxonomy.compile_rules(tables(spark))
    assert rules.templates[0].template_id == "template_laudo_agua_v1" and len(store.signature(rules)) == 64
    assert set(taxonomy.known_patterns(rules)) == {"água|agua", "resultados", r"amostra:\s*(\d+)", r"cliente:\s*(\w+)", r"nota:\s*(\w+)"}
    out = batch.run(report_pages(spark), rules)
    results = {r.parameter: r for r in out["results_extract"].collect()}
    assert set(results) == {"Ferro", "Zinco"} and out["results_extract"].columns == RESULTS
    assert (results["Ferro"].acm_resultado_tratado, results["Ferro"].acm_qualificador, results["Zinco"].acm_resultado_tratado, results["Zinco"].id_amostra) == (0.5, "<", 1200.0, "12")
    assert Counter(r.status for r in out["classification_audit"].collect()) == {"winner": 2, "below_minimum": 2}
    done = out["document_reconciliation_audit"].collect()
    assert [(r.nome_do_arquivo, r.resultados_extraidos, r.tabelas_auditadas, r.secoes_auditadas, r.status) for r in done] == [("a.pdf", 2, 1, 6, "ok")]  # every section that there can be has a row
    assert out["notes"].first().texto == "ok" and out["validation_errors"].count() == 0
    assert [r.status for r in out["table_extraction_audit"].collect()] == ["ok"] and {r.status for r in out["field_extraction_audit"].collect()} == {"ok"}
    assert {r.nome_do_arquivo: (r.tipo_duplicidade, r.arquivo_referencia) for r in out["duplicate_audit"].collect()} == {"a.pdf": ("duplicado_textual", "c.pdf"), "c.pdf": ("duplicado_textual", "a.pdf")}
    assert {r.nome_do_arquivo: (r.status, r.resultados) for r in out["resumo"].collect()} == {"a.pdf": ("identificado", 2), "b.pdf": ("fora_escopo", 0), "c.pdf": ("duplicado", 0), "d.pdf": ("erro", 0), "e.pdf": ("fora_escopo", 0)}
    assert {r.path[-5:]: r.status for r in batch.classify_batch(report_pages(spark), rules, 0).collect()} == {"a.pdf": "identificado", "b.pdf": "fora_escopo", "c.pdf": "identificado", "d.pdf": "erro", "e.pdf": "identificado"}
    sinks.save({"client": out["client"], "results_extract": out["results_extract"].select("nome_do_arquivo", "parameter", "resultado", "acm_resultado_tratado", "id_amostra")}, str(tmp_path / "out.jsonl"), "jsonl", "01/02/2024 00:00:00", order={"results_extract": ["parameter"]})
    line = spark.read.text(str(tmp_path / "out.jsonl")).first()[0]
    assert '"acm_resultado_tratado":0.50,"id_amostra":12' in line and '"acm_resultado_tratado":1200.0' in line
    assert json.loads(line)["arquivo"] == {"nome_do_arquivo": "a.pdf"} and json.loads(line)["tabelas"]["client"][0]["cliente"] == "Rio"


def test_command_line(spark, tmp_path):
    for name, df in tables(spark).items():
        df.write.json(str(tmp_path / "rules" / f"{name}.json"))
    report_pages(spark).write.parquet(str(tmp_path / "pages"))
    own = ["--pages", str(tmp_path / "pages"), "--taxonomy", str(tmp_path / "rules"), "--output", str(tmp_path / "out")]
    assert command.main(["classify", *own, "--classify-pages", "0"]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).where("status = 'identificado'").count() == 3
    assert command.main(["document", "--input", str(tmp_path / "none.pdf"), "--decoder", "json:loads", "--taxonomy", str(tmp_path / "rules"), "--output", "x"]) == 1
    args = command.arguments(["extract", "--input", "x", "y", "--output", "z"])
    assert (args.classify_pages, args.preclassify_pages, args.input, args.kind) == (3, 3, ["x", "y"], "parquet")


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a.pdf", "12", "0,50 mg/L", 0.5, "01/02/2024"), ("b <&>", None, "x", None, "ontem")], "nome_do_arquivo string, id_amostra string, resultado string, acm_resultado_tratado double, data_coleta string")
    sinks.save({"sample": df}, str(tmp_path / "out.xlsx"), "xlsx", "01/02/2024 10:30:00")
    with zipfile.ZipFile(tmp_path / "out.xlsx") as z:
        for name in z.namelist():
            ElementTree.fromstring(z.read(name))
        sheet, styles = z.read("xl/worksheets/sheet1.xml").decode(), z.read("xl/styles.xml").decode()
    assert f'<c r="B2" s="{workbook.INTEGER}"><v>12</v></c>' in sheet and f'<c r="D2" s="{workbook.PLACES + 2}"><v>0.5</v></c>' in sheet and f'<c r="E2" s="{workbook.DATE}"><v>45323.0</v></c>' in sheet
    assert "b &lt;&amp;&gt;" in sheet and ">ontem<" in sheet and 'formatCode="0.00"' in styles and '<autoFilter ref="A1:F3"/>' in sheet


def test_rows_without_a_document_go_to_all(spark):
    own = spark.createDataFrame([("a", 1), ("b", 2)], "nome_do_arquivo string, n int")
    loose = spark.createDataFrame([(None, 7), ("a", 8)], "nome_do_arquivo string, n int")
    got = sinks.unfiled({"own": own, "loose": loose}, "nome_do_arquivo")["loose"]
    assert sorted(map(tuple, got.collect())) == [("a", 7), ("a", 8), ("b", 7)]


def test_a_second_run_decodes_nothing(spark, tmp_path):
    calls, kept = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    (tmp_path / "in").mkdir()
    for name, body in (("a.pdf", REPORT), ("b.pdf", REPORT), ("c.pdf", "outro"), ("d.pdf", "bad"), ("e.pdf", REPORT + " ")):
        (tmp_path / "in" / name).write_text(body)
    folder = str(calls)

    def extract(content):
        import pathlib
        import uuid

        (pathlib.Path(folder) / uuid.uuid4().hex).write_bytes(content)
        if content == b"bad":
            raise ValueError("damaged")
        return [(content.decode(), [TABLE])]

    def run(sign, whole=True):
        before = len([*calls.iterdir()])
        pages, copies = store.read_files(spark, [str(tmp_path / "in")], extract, store=store.Store(spark, kept, sign))
        if not whole:
            return len([*calls.iterdir()]) - before
        out = batch.run(pages, taxonomy.compile_rules(tables(spark)), copies=copies)
        rows = {n: sorted(map(str, out[n].drop("acm_data_hora_extracao").collect())) for n in ("results_extract", "sample", "resumo", "duplicate_audit", "section_extraction_audit")}
        return len([*calls.iterdir()]) - before, rows, out

    first, made, out = run("s")
    assert first == 4  # one call a hash: a.pdf stands for b.pdf
    assert {r.nome_do_arquivo: (r.status, r.duplicado_de) for r in out["resumo"].collect()} == {"a.pdf": ("identificado", None), "b.pdf": ("duplicado", "a.pdf"), "c.pdf": ("fora_escopo", None), "d.pdf": ("erro", None), "e.pdf": ("duplicado", "a.pdf")}
    assert {r.nome_do_arquivo: r.tipo_duplicidade for r in out["duplicate_audit"].collect()} == {"a.pdf": "duplicado_exato_arquivo", "b.pdf": "duplicado_exato_arquivo", "e.pdf": "duplicado_textual"}
    again, same, _ = run("s")
    assert again == 1 and same == made  # what failed is tried again, nothing else
    (tmp_path / "in" / "f.pdf").write_text("outro texto")
    assert run("s", False) == 2
    assert run("other rules", False) == 5
    own = store.Store(spark, kept, "s")
    assert len(own.runs()) == 3  # the second run added the empty set of what it could decode
    count = own.pages().count()
    own.compact()
    assert len(own.runs()) == 1 and own.pages().count() == count == 4


def test_pages_of_a_run_that_died_are_not_read(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "store"), "s")
    assert kept.runs() == [] and kept.pages().count() == 0 and kept.known_files() is None
    spark.createDataFrame([("h", 1, "x", None)], store.PAGES).write.parquet(str(tmp_path / "store" / "pages" / "s" / "dead"))
    assert kept.pages().count() == 0 and kept.missing(spark.createDataFrame([("h",)], "hash_arquivo string")).count() == 1


def test_config_path(monkeypatch):
    for own, want in ((None, "base/config/taxonomy"), ("other", "base/config/other"), ("my/rules", "base/my/rules"), ("/abs/rules", "/abs/rules")):
        monkeypatch.setenv("TAXONOMY_FILE", own) if own else monkeypatch.delenv("TAXONOMY_FILE", raising=False)
        assert taxonomy.resolve("base") == want


def test_json_keeps_the_scale_of_the_source(spark):
    df = spark.createDataFrame([(7.1, "7,100 mg/L"), (1200.0, "1,20 x 10 3"), (2.0, "2")], "v double, s string")
    assert [r[0] for r in df.select(sinks.scaled(F.col("v"), F.col("s"))).collect()] == ["7.100", "1200.00", "2"]


def test_sources_isolate_failures_and_reuse_hashes(spark, tmp_path):
    for name, body in (("a.pdf", b"one"), ("b.PDF.txt", b"no"), ("c.pdf", b"bad")):
        (tmp_path / name).write_bytes(body)
    listed = documents.files(spark, str(tmp_path))
    first = documents.hashes(listed, str(tmp_path))
    assert listed.columns == ["path", "length", "modificationTime"]
    assert first.count() == 2 and documents.hashes(listed, str(tmp_path), cache=first).count() == 2
    # what the cache has is not read again
    stale = first.withColumn("hash_arquivo", F.when(F.col("path").endswith("a.pdf"), "cached").otherwise(F.col("hash_arquivo"))).where(F.col("path").endswith("a.pdf"))
    got = {r.path.rsplit("/", 1)[1]: r.hash_arquivo for r in documents.hashes(listed, str(tmp_path), cache=stale).collect()}
    assert got["a.pdf"] == "cached" and len(got["c.pdf"]) == 64

    def extract(content):
        if content == b"bad":
            raise ValueError("damaged")
        return [(content.decode(), [[["x"]]])]

    got = {r.path.rsplit("/", 1)[1]: (r.text, r.erro) for r in documents.pages(documents.contents(listed, str(tmp_path)), extract).collect()}
    assert got == {"a.pdf": ("one", None), "c.pdf": (None, "ValueError: damaged")}


def test_stream_stores_each_document_once(spark, tmp_path):
    source = spark.createDataFrame([(1, "água"), (2, "x")], "doc_id long, text string")
    source.write.parquet(str(tmp_path / "in"))
    templates, rules = [C.Template("a", 1)], [C.DetectionRule("a", "positive", "água", 5)]
    for n in (1, 2):  # the second run finds the same documents in a new file
        stream = incremental.classify_stream(incremental.watch(spark, str(tmp_path / "in"), "doc_id long, text string"), templates, rules)
        incremental.store_new(stream, str(tmp_path / "store"), str(tmp_path / "check")).awaitTermination()
        if n == 1:
            source.write.mode("append").parquet(str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "store"))
    assert sorted((r.doc_id, r.status) for r in got.collect()) == [(1, "identificado"), (2, "fora_escopo")]
