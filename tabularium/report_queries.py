"""Queries over reports with page tables, rules and output contracts, each with the same query in DuckDB SQL.

Reports are made of the driver's orders and line items: a report is an order, its rows are the order's lines, numbered
within it, and what the page text and the table titles say hangs on the keys. The SQL states what must come out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions import text as X
from .functions.measures import has_loose_unit
from .operators import audits as A
from .operators import normalize as N
from .operators import packaging as P
from .operators import rows as G
from .operators import sections as S
from .operators.validate import sheet_rows, validate, validate_all
from .plans import batch, contracts, store, taxonomy
from .queries import ORACLE_SQL, QUERIES, query, table  # noqa: F401
from .sources import documents, sinks
from .sources.scratch import shared_folder

# ---- reports with page tables (G1-G16, J1-J5, C11-C12 as rule sets)

RULES = {
    "t": G.RuleSet(
        categories=(G.SectionRule("resultados analiticos", "Resultados"), G.SectionRule("fisico", "Fisico-quimico")),
        subcategories=(G.SectionRule("^metais dissolvidos", "Resultados", "Metais dissolvidos"),),
        types=(G.SectionRule("brancos? de", "QAQC", tipo_registro="BRANCO", extrair_subcategoria=True),),
        continuations=(("^CQ-", "DUPLICATA"),),
        layouts={"AMOSTRA": {"resultado": 1, "unidade": 2, "lq": 3}},
    )
}


def report_lines(spark, sf_dir) -> DataFrame:
    """k, c, s (of the order), n (1.. within the order), q, p (of the line)."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(order))
    lines = lines.select(F.col("l_orderkey").alias("k"), "n", F.col("l_quantity").cast("int").alias("q"), F.col("l_partkey").alias("p"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    return lines.join(orders, "k")


_LINES = """
    l AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n, l_quantity::INT AS q, l_partkey AS p FROM lineitem),
    r AS (SELECT k, o_custkey AS c, o_orderstatus AS s, n, q, p, (n = 2 AND k % 6 = 0) AS ausente, CASE WHEN n <= 3 THEN 1 ELSE 2 END AS pagina FROM l JOIN orders ON k = o_orderkey)"""


def report_pages(spark, sf_dir) -> DataFrame:
    """Two pages a report. The first table has a title by the order's status and mostly a header, the second has neither."""
    lines = report_lines(spark, sf_dir)
    value = F.when((F.col("n") == 2) & (F.col("k") % 6 == 0), "ausente").otherwise(F.concat(F.col("q").cast("string"), F.lit(",5")))
    name = F.concat(F.when((F.col("n") > 3) & (F.col("k") % 7 == 0), "CQ-").otherwise("P"), F.col("p").cast("string"))
    cells = F.array(name, value, F.lit("mg/L"), F.lit("0,1"), F.lit("x"))
    gathered = lines.groupBy("k", "c", "s").agg(F.array_sort(F.collect_list(F.struct("n", cells.alias("cells")))).alias("rows"))
    part = lambda cond: F.transform(F.filter("rows", cond), lambda r: r["cells"])
    row = lambda *cells: F.array(F.array(*map(F.lit, cells)))
    none = F.array().cast("array<array<string>>")
    heading = F.when(F.col("s") == "O", row("Metais dissolvidos")).when(F.col("s") == "F", row("Resultados Analíticos")).otherwise(none)
    header = F.when(F.col("k") % 3 != 0, row("Análise", "Resultado", "Unidade", "LQ")).otherwise(none)
    text = F.concat_ws(
        "\n", F.when(F.col("k") % 4 != 0, F.concat(F.lit("Relatório  Analítico "), F.col("c").cast("string"), F.lit("/2024."), F.col("k").cast("string"))), F.when(F.col("k") % 8 == 0, "Parâmetros Resultados Unidade"), F.when(F.col("k") % 5 == 0, "Resultados Analíticos")
    )
    first = F.struct(F.lit(1).alias("page_no"), text.alias("text"), F.array(F.concat(heading, header, part(lambda r: r["n"] <= 3))).alias("tables"))
    second = F.struct(F.lit(2).alias("page_no"), F.lit(None).cast("string").alias("text"), F.array(part(lambda r: r["n"] > 3)).alias("tables"))
    return gathered.select(F.col("k").alias("doc_id"), F.lit("t").alias("template_id"), F.explode(F.array(first, second)).alias("p")).select("doc_id", "template_id", "p.*")


#: Which tables are read, and with what section: f has one row for each line of a table that is read.
_READ = (
    _LINES
    + """,
    good AS (SELECT k, pagina, count(*) AS linhas, count(*) FILTER (NOT ausente) AS medidas FROM r GROUP BY ALL),
    f AS (SELECT r.*, linhas, medidas, CASE WHEN pagina = 1 AND s = 'O' OR pagina = 2 AND s = 'O' AND k % 5 <> 0 THEN 'Metais dissolvidos' END AS sub, pagina = 2 AND k % 7 = 0 AS cq FROM r JOIN good USING (k, pagina)
          WHERE CASE pagina WHEN 1 THEN s <> 'P' AND (k % 3 <> 0 OR medidas >= 2) ELSE (s <> 'P' OR k % 5 = 0) AND (k % 7 = 0 OR medidas >= 2) END)"""
)


@query(
    f"""WITH {_READ}
       SELECT k AS doc_id, pagina, 1 AS tabela_indice, row_number() OVER (PARTITION BY k ORDER BY n) AS seq, 'Resultados' AS categoria, CASE WHEN cq THEN coalesce(sub, 'Resultados') ELSE sub END AS subcategoria,
              CASE WHEN cq THEN 'DUPLICATA' ELSE 'AMOSTRA' END AS tipo_registro, 'laboratorio' AS local, CASE WHEN cq THEN 'CQ-' ELSE 'P' END || p AS parametro, q || ',5' AS resultado, 'mg/L' AS unidade_resultado, '0,1' AS lq,
              CASE WHEN k % 4 <> 0 THEN c || '/2024.' || k END AS codigo_laudo FROM f WHERE NOT ausente"""
)
def extract_rows(spark, sf_dir):
    pages = report_pages(spark, sf_dir)
    found = G.result_rows(G.sections(pages, RULES), RULES)
    return found.select("doc_id", "pagina", "tabela_indice", "seq", "categoria", "subcategoria", "tipo_registro", "local", "parametro", "resultado", "unidade_resultado", "lq", "codigo_laudo")


@query(
    f"""WITH {_READ},
       t AS (SELECT DISTINCT k, pagina, s, sub, cq, linhas, medidas, pagina = 1 AND k % 3 <> 0 AS headed, pagina = 2 AND NOT cq AND s <> 'P' AND k % 3 <> 0 AS own, pagina = 1 AND k % 8 = 0 AS named FROM f)
       SELECT k AS doc_id, pagina, 'contrato_e_descoberta' AS modo_auditoria, CASE WHEN headed THEN 'Análise | Resultado | Unidade | LQ' WHEN named THEN 'Parâmetros Resultados Unidade' END AS cabecalho_detectado,
              CASE WHEN headed THEN 'Análise; Resultado; Unidade; LQ' END AS colunas_detectadas, CASE WHEN headed THEN 'Análise -> parameter; Resultado -> resultado; Unidade -> unidade; LQ -> lq' END AS colunas_mapeadas,
              CASE WHEN named AND NOT headed THEN 'parameter; resultado; unidade' ELSE 'parameter; resultado; unidade; lq' END AS campos_esperados, NULL::VARCHAR AS campos_obrigatorios_ausentes, NOT headed AS usou_fallback,
              CASE WHEN headed THEN 'ok' WHEN named AND medidas >= 0.8 * linhas THEN 'fallback_cabecalho_texto_layout_confiavel' WHEN named THEN 'fallback_cabecalho_texto_layout_incompleto'
                   WHEN medidas >= 0.8 * linhas THEN 'fallback_layout_confiavel' ELSE 'fallback' END AS status,
              CASE WHEN NOT headed THEN 'Tabela processada sem cabecalho detectado na malha extraida pelo PDF. ' || CASE WHEN named THEN 'Cabecalho contextual encontrado no texto da pagina: Parâmetros Resultados Unidade. Campos encontrados no texto da pagina: parameter; resultado; unidade. ' ELSE '' END
                   || 'Compatibilidade do layout: ' || linhas || '/' || linhas || ' linhas com colunas suficientes; ' || medidas || '/' || linhas || ' linhas com valor na coluna de resultado. Foi usado o layout cadastrado na taxonomia.' END AS observacao FROM t"""
)
def table_audit(spark, sf_dir):
    found = A.table_audit(G.sections(report_pages(spark, sf_dir), RULES), RULES)
    return found.select("doc_id", "pagina", "modo_auditoria", "cabecalho_detectado", "colunas_detectadas", "colunas_mapeadas", "campos_esperados", "campos_obrigatorios_ausentes", "usou_fallback", "status", "observacao")


@query(
    f"""WITH {_LINES} SELECT DISTINCT k AS doc_id, 2 AS page_no, 'Resultados' AS categoria, NULL::VARCHAR AS subcategoria FROM r WHERE k % 5 = 0"""
)
def section_left_to_next_page(spark, sf_dir):
    return G.left_to_next_page(report_pages(spark, sf_dir), RULES).select("doc_id", "page_no", "secao.categoria", "secao.subcategoria")


@query(
    f"""WITH {_LINES}, t AS (SELECT k, pagina, count(*) AS linhas, min_by(p, n) AS p, min_by(q, n) AS q FROM r GROUP BY ALL)
       SELECT k AS doc_id, pagina, 1 AS tabela_indice, 'tabela' AS objeto_tipo, NULL::VARCHAR AS secao,
              (CASE WHEN pagina = 1 AND k % 3 <> 0 THEN 'Análise | Resultado | Unidade | LQ' ELSE CASE WHEN pagina = 2 AND k % 7 = 0 THEN 'CQ-' ELSE 'P' END || p || ' | ' || q || ',5 | mg/L | 0,1 | x' END) AS titulo_detectado,
              'descoberta' AS modo_auditoria, NULL::VARCHAR AS regra_encontrada, 1::BIGINT AS ocorrencias_detectadas, 0::BIGINT AS registros_extraidos, 'tabela_nao_mapeada' AS status,
              'Estrutura tabular sem correspondencia nas regras conhecidas da taxonomia.' AS observacao FROM t JOIN (SELECT DISTINCT k, s FROM r) USING (k)
       WHERE linhas + (pagina = 1 AND k % 3 <> 0)::INT >= 2 AND NOT (pagina = 2 AND k % 2 = 0) AND NOT (pagina = 1 AND s IN ('O', 'F'))"""
)
def unmapped_tables(spark, sf_dir):
    """One rule knows a title as it stands, one is written for folded text."""
    pages = report_pages(spark, sf_dir)
    audited = pages.where((F.col("page_no") == 2) & (F.col("doc_id") % 2 == 0)).select("doc_id", "page_no", F.lit(1).alias("tabela_indice"))
    return A.unmapped_tables(pages, audited, ["metais", "resultados analiticos"])


@query(
    r"""WITH t AS (SELECT p_partkey AS k, p_size % 4 AS titulos, p_partkey % 3 = 0 AS ignora, p_partkey % 5 AS registros, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS pagina FROM part)
       SELECT k AS doc_id, CASE WHEN titulos > 0 THEN pagina END AS pagina, NULL::INT AS tabela_indice, 'secao' AS objeto_tipo, 'notas' AS secao, CASE WHEN titulos > 0 THEN 'NOTAS' END AS titulo_detectado, 'conhecida' AS modo_auditoria,
              CASE WHEN titulos > 0 THEN 'notas\n' END AS regra_encontrada, titulos::BIGINT AS ocorrencias_detectadas, registros::BIGINT AS registros_extraidos,
              CASE WHEN titulos > 0 AND registros > 0 THEN 'ok' WHEN titulos > 0 AND ignora THEN 'nao_aplicavel' WHEN titulos > 0 THEN 'encontrada_sem_extracao' WHEN registros > 0 THEN 'extraida_sem_titulo' ELSE 'nao_aplicavel' END AS status,
              CASE WHEN titulos > 0 AND registros > 0 THEN 'Secao reconhecida e dados extraidos.' WHEN titulos > 0 AND ignora THEN 'Secao encontrada apenas com conteudo explicitamente ignorado pela taxonomia.'
                   WHEN titulos > 0 THEN 'A secao foi encontrada, mas nenhum registro foi gerado.' WHEN registros > 0 THEN 'Foram gerados registros sem localizar a regra de inicio da secao.' ELSE 'Secao opcional nao encontrada no documento.' END AS observacao FROM t"""
)
def known_sections(spark, sf_dir):
    """Two pages a document; the titles are on the second where their number is even."""
    part, none = table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey")), F.lit("")
    titles, even = F.repeat(F.lit("NOTAS\n"), (F.col("p_size") % 4).cast("int")), F.col("p_size") % 2 == 0
    first = F.struct(F.lit(1).alias("page_no"), F.concat(F.when(~even, titles).otherwise(none), F.when(F.col("doc_id") % 3 == 0, "Sem  notas").otherwise("")).alias("text"))
    second = F.struct(F.lit(2).alias("page_no"), F.when(even, titles).alias("text"))
    pages = part.select("doc_id", F.explode(F.array(first, second)).alias("p")).select("doc_id", "p.*")
    extracted = part.where("doc_id % 5 > 0").select("doc_id", F.lit("notas").alias("secao"), (F.col("doc_id") % 5).alias("registros"))
    return A.known_sections(pages, {"notas": ([r"notas\n"], [r"sem\s+notas"])}, extracted)


# ---- packaging (H3, H4) and header fields

PACKAGING = {"t": P.PackagingRules(("embalagens",), ("recipiente",), (r"amostra\s+(\d+ - \w+)",), ("pl[aá]stico|vidro",), (r"\d+\s*mL",))}


@query(
    """WITH d AS (SELECT p_partkey AS k, p_size AS z FROM part), rows AS (SELECT * FROM (VALUES (1, 'Plástico', '500 mL', 'SM 1'), (3, 'Vidro', '1 mL', 'SM 3')) AS t(i, e, v, m)),
            read AS (SELECT k, z, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS pagina, CASE WHEN k % 3 = 0 THEN z || ' - rio' WHEN k % 2 = 0 OR k % 4 = 1 THEN k || ' - poço' END AS nome FROM d WHERE k % 2 = 0 OR k % 4 = 1)
       SELECT k AS doc_id, pagina, CASE WHEN k % 3 = 0 THEN z::VARCHAR ELSE k::VARCHAR END AS id_amostra, nome AS identificacao_amostra, e AS embalagem, v AS volume, 'Gelo' AS preservacao, m AS metodos FROM read, rows"""
)
def extract_packaging(spark, sf_dir):
    """Even parts: section and table on page 1. Of the others every second names the section there and has the table on page 2."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    row = lambda *cells: F.array(*map(lambda c: F.lit(c) if not isinstance(c, Column) else c, cells))
    head, *body = row("Recipiente", "Volume", "Preservação", "Métodos"), row("Plástico", "500 mL", "Gelo", "SM 1"), row("Vidro", "x", "Gelo", "SM 2"), row("Vidro", "1 mL", "Gelo", "SM 3"), row("Vidro", "1 mL", "", "SM 4")
    above = F.when(key % 3 == 0, F.array(row(F.concat(F.lit("Amostra "), F.col("p_size").cast("string"), F.lit(" - rio"))))).otherwise(F.array().cast("array<array<string>>"))
    own = F.concat(above, F.array(head, *body))
    said = F.concat(F.lit("Embalagens da amostra "), key.cast("string"), F.lit(" - poço"))
    none = F.array().cast("array<array<array<string>>>")
    first = F.struct(F.lit(1).alias("page_no"), F.when((key % 2 == 0) | (key % 4 == 1), said).otherwise("outra").alias("text"), F.when(key % 2 == 0, F.array(own)).otherwise(none).alias("tables"))
    second = F.struct(F.lit(2).alias("page_no"), F.lit("").alias("text"), F.array(own).alias("tables"))
    pages = part.select(key.alias("doc_id"), F.lit("t").alias("template_id"), F.explode(F.array(first, second)).alias("p")).select("doc_id", "template_id", "p.*")
    return P.extract_packaging(pages, PACKAGING).select("doc_id", "pagina", *P.COLUMNS)


@query(
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey || '/2024.1.AB' WHEN 1 THEN o_custkey || '/7.' || o_orderkey END AS codigo, CASE o_orderkey % 3 WHEN 2 THEN NULL WHEN 0 THEN o_custkey || '/2024.1.AB' ELSE o_custkey || '/7.' || o_orderkey END AS numero,
              CASE WHEN o_orderkey % 2 = 0 THEN 'CA' || o_custkey || '/2024' END AS planejamento, CASE WHEN o_orderkey % 2 = 0 THEN 'vento forte fim' ELSE 'vento forte' END AS nao_conformidade,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN -(o_custkey + 0.25) ELSE 1000 + 0.5 END::DOUBLE AS latitude, CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE 'BASE' END AS campo FROM orders"""
)
def header_fields(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    code = F.when(k % 3 == 0, F.concat(F.lit("RELATÓRIO Analítico  Parcial "), c, F.lit("/2024.1.AB"))).when(k % 3 == 1, F.concat(F.lit("Relatorio Analitico "), c, F.lit("/7."), k.cast("string")))
    plan = F.when(k % 2 == 0, F.concat(F.lit("plano ca1 e CA"), c, F.lit("/2024 ok"))).otherwise("CA/2024")
    nonconforming = F.when(k % 2 == 0, "vento  forte Planejamento de amostragem: CA1/2024 Latitude (coordenada real): -19,5  fim").otherwise("vento\nforte")
    latitude = F.when(k % 5 == 0, "S 19").when(k % 2 == 0, F.concat(F.lit("-"), c, F.lit(",25"))).otherwise("1.000,5")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(code, F.lit("sem")).alias("t"), plan.alias("p"), nonconforming.alias("n"), latitude.alias("l"), F.when(k % 2 == 0, "Nome: x").otherwise("nome").alias("m"))
    found = S.metadata(orders, {"campo": [(r"nome(?::\s*(\w+))?", 1)]}, "m")
    return found.select("o_orderkey", S.report_code(F.col("t")).alias("codigo"), S.report_number(F.col("t")).alias("numero"), S.planning_code(F.col("p")).alias("planejamento"), S.nonconformity(F.col("n")).alias("nao_conformidade"), X.strict_decimal(F.col("l")).alias("latitude"), "campo")


@query(
    """SELECT k AS doc_id, valor, min(n)::INT AS pagina FROM (SELECT l_orderkey AS k, 'K' || l_partkey % 5 AS valor, l_linenumber AS n FROM lineitem WHERE l_partkey % 3 <> 0) GROUP BY ALL"""
)
def validation_keys(spark, sf_dir):
    key = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("fo-anl-"), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.lit("K"), (F.col("l_partkey") % 5).cast("string")))
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_no"), F.concat(F.lit("Chave:  "), key).alias("text"))
    return S.validation_keys(pages, r"chave:\s*(\S+)").select("doc_id", "valor", "pagina")


@query(
    r"""WITH v(m, campo, n, valor, dentro, status) AS (VALUES (0, 'cliente', 1, 'Rio', NULL, 'ok'), (0, 'contato', 1, 'Ana', NULL, 'ok'), (0, 'local', 0, NULL, NULL, 'nao_aplicavel'),
            (1, 'cliente', 1, 'Rio Contato: Ana', 'contato', 'possivel_contaminacao'), (1, 'contato', 1, 'Ana', NULL, 'ok'), (1, 'local', 0, NULL, NULL, 'nao_aplicavel'),
            (2, 'cliente', 0, NULL, NULL, 'nao_aplicavel'), (2, 'contato', 1, 'Local:', 'local', 'possivel_contaminacao'), (2, 'local', 1, NULL, NULL, 'encontrado_sem_extracao'),
            (3, 'cliente', 0, NULL, NULL, 'nao_aplicavel'), (3, 'contato', 0, NULL, NULL, 'nao_aplicavel'), (3, 'local', 0, NULL, NULL, 'nao_aplicavel'),
            (4, 'cliente', 2, 'A', NULL, 'ok'), (4, 'contato', 0, NULL, NULL, 'nao_aplicavel'), (4, 'local', 1, 'poço', NULL, 'ok'))
       SELECT o_orderkey AS doc_id, campo, CASE WHEN n > 0 THEN 2 END AS pagina, CASE campo WHEN 'cliente' THEN 'Cliente:\s*([^\n]*)' WHEN 'contato' THEN 'Contato:\s*([^\n]*)' ELSE 'Local:\s*(\w*)' END AS regra_encontrada, n::BIGINT AS ocorrencias_detectadas, valor AS valor_extraido,
              dentro AS campos_detectados_no_valor, status, CASE status WHEN 'possivel_contaminacao' THEN 'O valor extraido contem regra associada a outro campo.' WHEN 'encontrado_sem_extracao' THEN 'A regra foi encontrada no PDF, mas o campo de saida ficou vazio.' END AS observacao
       FROM orders JOIN v ON o_orderkey % 5 = m"""
)
def field_audit_contamination(spark, sf_dir):
    """The first page of a document says nothing."""
    texts = ["Cliente: Rio\nContato: Ana", "Cliente: Rio Contato: Ana", "Contato: \nLocal: ", None, "Cliente: A\ncliente: B\nLOCAL: poço"]
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    rules = [("client", "cliente", r"Cliente:\s*([^\n]*)"), ("client", "contato", r"Contato:\s*([^\n]*)"), ("sample", "local", r"Local:\s*(\w*)")]
    both = F.array(F.struct(F.lit(1).alias("page_no"), F.lit("capa").alias("text")), F.struct(F.lit(2).alias("page_no"), text.alias("text")))
    pages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(both).alias("p")).select("doc_id", "p.*")
    return S.field_audit(pages, rules).drop("schema_origem")


@query(
    """WITH m AS (SELECT l_orderkey AS k, l_linenumber AS n, unnest(CASE WHEN l_partkey % 2 = 0 THEN ['a' || l_partkey % 3, 'b'] ELSE ['b'] END) AS valor FROM lineitem)
       SELECT k AS doc_id, valor, min(n)::INT AS pagina FROM m GROUP BY ALL"""
)
def section_first_pages(spark, sf_dir):
    text = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("Nota: a"), (F.col("l_partkey") % 3).cast("string"), F.lit("\nNOTA:  b"))).otherwise("nota: b\nnota: b")
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_no"), text.alias("text"))
    return S.section_matches(pages, [("texto", r"nota:\s*(\w+)", 1)]).select("doc_id", "valor", "pagina")


# ---- the 53-column contract


def raw_results(spark, sf_dir) -> DataFrame:
    key, n = F.col("l_orderkey"), (F.col("l_partkey") % 90 + 1).cast("string")
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    many = table(spark, sf_dir, "lineitem")
    return many.select(
        key.cast("string").alias("nome_do_arquivo"), F.col("l_linenumber").cast("string").alias("id_amostra"), F.when(key % 3 == 0, "BRANCO").when(key % 3 == 1, "OUTRO").otherwise("AMOSTRA").alias("tipo_registro"), F.lit(" cat ").alias("categoria"),
        say("P", n).alias("parametro"), F.when(key % 4 == 0, "NA").when(key % 4 == 1, say("< ", n, ",5 mg/L")).when(key % 4 == 2, say(n, " x 10 2")).otherwise(say("-", n)).alias("resultado"), F.lit("NTU").alias("unidade_resultado"),
        say("12/2024.", n, ".A").alias("codigo_laudo"), F.when(key % 2 == 0, say("em 01/02/2024 10:3", (key % 10).cast("string"))).otherwise("01/02/2024").alias("data_inicio"), F.when(key % 2 == 0, say("Máx. ", n, " mg/L")).otherwise("3,7 mg/L para pH <= 7,5; 2,0 mg/L para pH > 8").alias("conama"), F.lit("NA").alias("copam_cerh"),
        say(n, ",1 µg/L").alias("ld"), F.lit("ND").alias("lq"), say(n, " %").alias("incerteza"), F.when(key % 2 == 0, say("< ", n, " %")).otherwise(say(n, " a 125 %")).alias("faixa_aceitacao"),
    )


@query(
    """SELECT l_orderkey::VARCHAR AS nome_do_arquivo, CASE l_orderkey % 3 WHEN 0 THEN 'Branco' WHEN 1 THEN 'OUTRO' ELSE 'Amostra' END AS tipo, 'cat' AS categoria, 'laboratorio' AS local, n || '.A' AS acm_codigo_laudo,
              '01/02/2024 ' || CASE WHEN l_orderkey % 2 = 0 THEN '10:3' || l_orderkey % 10 || ':00' ELSE '00:00:00' END AS acm_data_inicio, CASE l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN n + 0.5 WHEN 2 THEN n * 100 ELSE -n END::DOUBLE AS acm_resultado_tratado,
              CASE WHEN l_orderkey % 4 = 1 THEN '<' END AS acm_qualificador, CASE WHEN l_orderkey % 4 = 1 THEN 'mg/L' ELSE 'NTU' END AS acm_unidade, CASE WHEN l_orderkey % 2 = 0 THEN 'max' END AS acm_conama_operador, NULL::DOUBLE AS acm_conama_minimo,
              CASE WHEN l_orderkey % 2 = 0 THEN n END::DOUBLE AS acm_conama_maximo, CASE WHEN l_orderkey % 2 = 0 THEN 'mg/L' END AS acm_conama_unidade, 'NA' AS copam_cerh, NULL::DOUBLE AS acm_copam_cerh_maximo, (n + 0.1)::DOUBLE AS acm_ld_minimo, (n + 0.1)::DOUBLE AS acm_ld_maximo, 'µg/L' AS acm_ld_unidade,
              NULL::VARCHAR AS lq, NULL::DOUBLE AS acm_lq_minimo, n::DOUBLE AS acm_incerteza_valor, '%' AS acm_incerteza_unidade, CASE WHEN l_orderkey % 2 = 0 THEN '<' END AS acm_faixa_aceitacao_operador, n::DOUBLE AS acm_faixa_aceitacao_minimo,
              CASE WHEN l_orderkey % 2 = 0 THEN n ELSE 125 END::DOUBLE AS acm_faixa_aceitacao_maximo FROM (SELECT *, l_partkey % 90 + 1 AS n FROM lineitem)"""
)
def results_extract(spark, sf_dir):
    names = "nome_do_arquivo tipo categoria local acm_codigo_laudo acm_data_inicio acm_resultado_tratado acm_qualificador acm_unidade acm_conama_operador acm_conama_minimo acm_conama_maximo acm_conama_unidade copam_cerh acm_copam_cerh_maximo acm_ld_minimo acm_ld_maximo acm_ld_unidade lq acm_lq_minimo acm_incerteza_valor acm_incerteza_unidade acm_faixa_aceitacao_operador acm_faixa_aceitacao_minimo acm_faixa_aceitacao_maximo"
    return N.normalize(raw_results(spark, sf_dir)).select(*names.split())


# ---- contracts (V1, V3-V7)


def contract_rows(spark, sf_dir) -> DataFrame:
    """Rows of the results contract, one kind of fault each by the order's key."""
    k = F.col("o_orderkey")
    base = dict.fromkeys(contracts.RESULTS, F.lit(None).cast("string")) | {
        "nome_do_arquivo": k.cast("string"), "id_taxonomia": F.lit("1"), "id_amostra": k.cast("string"), "tipo": F.lit("Amostra"), "categoria": F.lit("c"), "parameter": F.lit("Ferro"), "local": F.lit("campo"),
        "resultado": F.lit("0,5 mg/L"), "acm_resultado_tratado": F.lit("0.5"), "acm_unidade": F.when(k % 9 == 1, None).otherwise("mg/L"),
        "lq": F.when(k % 9 == 2, "3 - 2").otherwise(F.when(k % 9 == 3, "5").otherwise(None)), "acm_lq_minimo": F.when(k % 9 == 2, "3").when(k % 9 == 4, "1"), "acm_lq_maximo": F.when(k % 9 == 2, "2"), "acm_lq_unidade": F.when(k % 9 == 3, "mg/L"),
        "conama": F.when(k % 9 == 5, "3,7 mg/L para pH <= 7,5; 2,0 mg/L para pH > 8").when(k % 9 == 6, "5 palmos"), "acm_ld_minimo": F.when(k % 9 == 7, "x"),
    }
    return table(spark, sf_dir, "orders").select(*(x.cast("string").alias(c) for c, x in base.items()), k.alias("linha"))


@query(
    """WITH v(m, field, type, message) AS (VALUES (1, '__row__', 'value_error', 'acm_unidade vazio para texto com unidade'), (2, '__row__', 'value_error', 'acm_lq_minimo maior que acm_lq_maximo'), (3, '__row__', 'value_error', 'acm_lq_unidade preenchido sem unidade no campo de origem'),
            (4, '__row__', 'value_error', 'acm_lq_minimo preenchido com lq vazio'), (6, '__row__', 'value_error', 'acm_conama_unidade vazio para texto com unidade'), (7, 'acm_ld_minimo', 'float_parsing', 'numero esperado'))
       SELECT 'results_extract' AS sheet, o_orderkey AS row_number, o_orderkey::VARCHAR AS nome_do_arquivo, field, type, message FROM orders JOIN v ON o_orderkey % 9 = m"""
)
def contract_errors(spark, sf_dir):
    return validate(contract_rows(spark, sf_dir), contracts.RESULTS_CONTRACT, "results_extract", row_number="linha", parameter="parameter").select("sheet", "row_number", "nome_do_arquivo", "field", "type", "message")


@query(
    """SELECT sheet, nome_do_arquivo, field, type FROM (
         SELECT 'packaging_preservatives' AS sheet, p_partkey::VARCHAR AS nome_do_arquivo, 'metodos' AS field, 'string_type' AS type FROM part WHERE p_partkey % 3 = 0
         UNION ALL SELECT 'client', p_partkey::VARCHAR, 'id_amostra', 'int_parsing' FROM part WHERE p_partkey % 4 = 0
         UNION ALL SELECT 'sample', p_partkey::VARCHAR, 'data_coleta', 'string_pattern_mismatch' FROM part WHERE p_partkey % 5 = 0
         UNION ALL SELECT 'sample', NULL, 'telefone', 'extra_column' UNION ALL SELECT 'short', NULL, c, 'missing_column' FROM (VALUES ('contato'), ('telefone'), ('endereco')) AS t(c))"""
)
def contracts_by_sheet(spark, sf_dir):
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")

    def rows(columns: list[str], **values: Column) -> DataFrame:
        own = dict.fromkeys(columns, F.lit(None).cast("string")) | {"nome_do_arquivo": k.cast("string"), "id_taxonomia": F.lit("1"), "id_amostra": k.cast("string")} | values
        return part.select(*(x.cast("string").alias(c) for c, x in own.items()))

    filled = {c: F.lit("x") for c in ("identificacao_amostra", "embalagem", "volume", "preservacao")}
    packaging = rows(contracts.PACKAGING, **filled, metodos=F.when(k % 3 == 0, " ").otherwise("m"))
    client = rows(contracts.CLIENT, id_amostra=F.when(k % 4 == 0, "abc").otherwise("7"))
    sample = rows(contracts.SAMPLE, data_coleta=F.when(k % 5 == 0, "2024-01-01").otherwise("01/02/2024 10:30"), telefone=F.lit("1"))
    tables = {"packaging_preservatives": (packaging, contracts.PACKAGING_CONTRACT), "client": (client, contracts.CLIENT_CONTRACT), "sample": (sample, contracts.SAMPLE_CONTRACT), "short": (client.drop("contato", "telefone", "endereco"), contracts.CLIENT_CONTRACT)}
    return validate_all(tables).select("sheet", "nome_do_arquivo", "field", "type")


# ---- rule tables


def rule_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Rule tables made of the driver's: taxonomies of regions, templates of nations, rules of parts; with faults."""
    t = lambda name: table(spark, sf_dir, name)
    k, null = F.col("p_partkey").cast("int"), F.lit(None).cast("string")
    nation = F.col("n_nationkey").cast("int")
    groups = F.element_at(F.array(*map(F.lit, ["notes", "layout", "template_detection", "inventado"])), (k % 4 + 1).cast("int"))
    return {
        "item_taxonomia": t("region").select(F.col("r_regionkey").cast("int").alias("id"), (F.col("r_regionkey").cast("int") + 100).alias("id_taxonomia"), F.concat(F.lit("Laudo de "), F.when(F.col("r_regionkey") == 1, "Água").otherwise(F.col("r_name"))).alias("nome")),
        "template": t("nation").select(
            nation.alias("id"), F.col("n_regionkey").cast("int").alias("id_item_taxonomia"), F.lit("x").alias("regex"), F.when(nation % 4 == 0, "Não").when(nation % 4 == 1, "talvez").otherwise("sim").alias("ativo"), F.lit("2").alias("versao_template"), F.when(nation % 5 == 2, F.concat(F.lit("tpl"), nation)).alias("template_id"),
            F.when(nation % 5 == 2, F.lit("tema")).alias("theme_id"), null.alias("nome"), F.when(nation % 3 == 0, nation * 10).cast("int").alias("prioridade"), F.when(nation % 2 == 0, 55.0).cast("double").alias("score_minimo"),
        ),
        "item_template": t("part").select(
            F.when(k % 10 == 9, k - 1).otherwise(k).alias("id"), (k % 27).alias("id_template"), groups.alias("schema"), F.when(k % 8 == 1, "resultado_col").when(k % 8 == 5, "inventado_col").otherwise("c").alias("campo"), F.lit("x").alias("regex"),
            F.when(k % 4 == 2, F.when(k % 8 == 2, "peso=1; rule_type = positive").otherwise("rule_type=outro")).otherwise("1").alias("coluna_origem"), null.alias("tipo_registro"),
        ),
        "schema": spark.createDataFrame([(1, 1, "results_extract", "nao"), (2, 1, "notes", "quem sabe")], taxonomy.SCHEMAS["schema"]),
        "item_schema": spark.createDataFrame([(1, 1, "results_extract", "lq_minimo", "t", "nao"), (2, 2, "outro", "b", "t", "sim"), (3, 9, "notes", "c", "t", "sim"), (4, 1, "results_extract", "lq", "t", "sim"), (5, 1, "results_extract", "lq", "t", "nao")], taxonomy.SCHEMAS["item_schema"]),
    }


@query(
    """WITH r AS (SELECT p_partkey AS k FROM part)
       SELECT tabela, tipo, valor, count(*) AS n FROM (
         SELECT 'item_template' AS tabela, 'id_duplicado' AS tipo, (k - 1)::VARCHAR AS valor FROM r WHERE k % 10 = 9 AND k > 0
         UNION ALL SELECT 'item_template', 'chave_desconhecida:id_template', (k % 27)::VARCHAR FROM r WHERE k % 27 >= 25
         UNION ALL SELECT 'item_template', 'grupo_desconhecido', 'inventado' FROM r WHERE k % 4 = 3
         UNION ALL SELECT 'item_template', 'rule_type_invalido', 'outro' FROM r WHERE k % 8 = 6
         UNION ALL SELECT 'item_template', 'campo_de_layout_desconhecido', 'inventado_col' FROM r WHERE k % 8 = 5
         UNION ALL SELECT 'template', 'booleano_invalido:ativo', 'talvez' FROM nation WHERE n_nationkey % 4 = 1
         UNION ALL SELECT * FROM (VALUES ('schema', 'booleano_invalido:is_serial', 'quem sabe'), ('item_schema', 'sem_prefixo_acm', 'lq_minimo'), ('item_schema', 'nome_divergente', 'outro'), ('item_schema', 'chave_desconhecida:id_schema', '9')) AS t(a, b, c)) GROUP BY ALL"""
)
def taxonomy_problems(spark, sf_dir):
    return taxonomy.problems(rule_tables(spark, sf_dir)).groupBy("tabela", "tipo", "valor").agg(F.count("*").alias("n"))


@query(
    """SELECT n_nationkey::INT AS id, CASE WHEN n_nationkey % 5 = 2 THEN 'tpl' || n_nationkey WHEN n_regionkey = 1 THEN 'template_laudo_agua_v1' ELSE 'template_laudo_laudo_de_' || replace(lower(r_name), ' ', '_') || '_v' || n_nationkey END AS template_id,
              CASE WHEN n_nationkey % 5 = 2 THEN 'tema' WHEN n_regionkey = 1 THEN 'laudo_agua' ELSE 'laudo_laudo_de_' || replace(lower(r_name), ' ', '_') END AS theme_id, (n_regionkey + 100)::INT AS id_taxonomia, 2 AS versao_template,
              CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey * 10 ELSE n_nationkey END::INT AS prioridade, CASE WHEN n_nationkey % 2 = 0 THEN 55.0 ELSE 80.0 END::DOUBLE AS score_minimo, n_nationkey % 4 <> 0 AS ativo FROM nation JOIN region ON n_regionkey = r_regionkey"""
)
def template_identities(spark, sf_dir):
    return taxonomy.template_identities(rule_tables(spark, sf_dir)).select("id", "template_id", "theme_id", "id_taxonomia", "versao_template", "prioridade", "score_minimo", "ativo")


@query(
    """WITH i AS (SELECT s_suppkey AS id, 's' || s_nationkey % 3 AS schema, 'c' || s_suppkey % 40 AS campo, CASE s_suppkey % 4 WHEN 0 THEN ' Sim' WHEN 1 THEN 'nao' WHEN 2 THEN NULL ELSE '1' END AS nulo FROM supplier),
            f AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY schema, campo ORDER BY id) = 1)
       SELECT schema, campo, row_number() OVER (PARTITION BY schema ORDER BY id)::INT AS ordem, coalesce(nulo = 'nao', false) AS obrigatorio FROM f"""
)
def output_fields(spark, sf_dir):
    """The fields of three outputs; of fields that are there twice the first counts."""
    k = F.col("s_suppkey").cast("int")
    nulls = F.when(k % 4 == 0, " Sim").when(k % 4 == 1, "nao").when(k % 4 == 3, "1")
    items = table(spark, sf_dir, "supplier").select(k.alias("id"), F.lit(1).alias("id_schema"), F.concat(F.lit("s"), (F.col("s_nationkey") % 3).cast("string")).alias("schema"), F.concat(F.lit("c"), (k % 40).cast("string")).alias("campo"), F.lit("t").alias("tipo"), nulls.alias("nulo"))
    return taxonomy.output_fields(items)


def rules_of(spark, items: DataFrame) -> taxonomy.Compiled:
    """The rules in ``items`` (as item_template), all of one template."""
    fixed = {"item_taxonomia": [(1, 7, "Laudo de água")], "template": [(1, 1, "x", "sim", "1", None, None, None, 1, 50.0)], "schema": [(1, 1, "notes", "nao")], "item_schema": [(1, 1, "notes", "texto", "t", "nao")]}
    return taxonomy.compile_rules({n: spark.createDataFrame(r, taxonomy.SCHEMAS[n]) for n, r in fixed.items()} | {"item_template": items})


@query(
    """WITH p AS (SELECT s_suppkey AS k, s_nationkey AS z, s_suppkey % 3 AS t FROM supplier)
       SELECT CASE t WHEN 0 THEN 'AMOSTRA' WHEN 1 THEN 'BRANCO' ELSE 'OUTRO TIPO' END AS tipo, CASE k % 2 WHEN 0 THEN 'resultado' ELSE 'lq' END AS campo, max_by(z, k)::INT AS coluna FROM p GROUP BY ALL"""
)
def compiled_layouts(spark, sf_dir):
    """The layouts of a compiled rule table: of two rules for one field the later one counts."""
    k = F.col("s_suppkey").cast("int")
    tipo = F.when(k % 3 == 0, " Amostra").when(k % 3 == 1, "BRANCO").otherwise("outro tipo")
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), F.lit(1).alias("id_template"), F.lit("layout").alias("schema"), F.when(k % 2 == 0, "resultado_col").otherwise("lq").alias("campo"), F.lit(None).cast("string").alias("regex"), F.col("s_nationkey").cast("string").alias("coluna_origem"), tipo.alias("tipo_registro"))
    extra = spark.createDataFrame([(-1, 1, "layout", "inventado", None, "3", "Amostra"), (-2, 1, "layout", "lq", None, "x", "Amostra"), (-3, 9, "layout", "lq", None, "3", "Amostra")], taxonomy.SCHEMAS["item_template"])
    layouts = rules_of(spark, rows.unionByName(extra)).rows["template_laudo_agua_v1"].layouts
    return spark.createDataFrame([(t, f, i) for t, own in layouts.items() for f, i in own.items()], "tipo string, campo string, coluna int")


@query(
    r"""SELECT s_suppkey::INT AS id, 'notes' AS schema, 'texto' AS campo, CASE s_suppkey % 4 WHEN 1 THEN 'nota (' WHEN 2 THEN '(a)?(?(1)b|' || s_suppkey || ')' ELSE '(?<=a+)x' END AS regex,
              CASE s_suppkey % 4 WHEN 2 THEN 'java' ELSE 'python' END AS motor FROM supplier WHERE s_suppkey % 4 <> 0"""
)
def rule_quarantine(spark, sf_dir):
    """Rules that one of the engines cannot run are rows of a table, and the others are compiled."""
    k = F.col("s_suppkey").cast("int")
    patterns = F.when(k % 4 == 0, r"nota \((?P<numero_1>\d+)\)").when(k % 4 == 1, "nota (").when(k % 4 == 2, F.concat(F.lit("(a)?(?(1)b|"), k.cast("string"), F.lit(")"))).otherwise("(?<=a+)x")
    none = F.lit(None).cast("string")
    rules = rules_of(spark, table(spark, sf_dir, "supplier").select(k.alias("id"), F.lit(1).alias("id_template"), F.lit("notes").alias("schema"), F.lit("texto").alias("campo"), patterns.alias("regex"), none.alias("coluna_origem"), none.alias("tipo_registro")))
    motor = F.when(F.col("erro").startswith("python"), "python").otherwise("java")
    return rules.quarantine(spark).select("id", "schema", "campo", "regex", motor.alias("motor"))


@query(
    """SELECT k AS doc_id, texto, valor, min(n)::INT AS pagina FROM (
         SELECT l_orderkey AS k, l_linenumber AS n, unnest(['escapado', 'nomeado', 'opcional', 'sem_grupo']) AS texto, unnest(['nota (x)', 'n' || l_partkey % 4, CASE WHEN l_partkey % 2 = 0 THEN 'aviso' ELSE 'b' || l_partkey % 3 END, 'fim']) AS valor FROM lineitem) GROUP BY ALL"""
)
def section_rule_forms(spark, sf_dir):
    """Escaped brackets, named groups, groups that take no part in a match, and no group at all."""
    p = F.col("l_partkey")
    text = F.concat(F.lit("Nota (x) num=n"), (p % 4).cast("string"), F.when(p % 2 == 0, " aviso").otherwise(F.concat(F.lit(" aviso: b"), (p % 3).cast("string"))), F.lit(" fim"))
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_no"), F.lower(text).alias("text"))
    rules = [("escapado", r"nota \(x\)"), ("nomeado", r"num=(?P<o_numero>\w+)"), ("opcional", r"aviso(?:: (\w+))?"), ("sem_grupo", "fim")]
    return S.section_matches(pages, rules).select("doc_id", F.col("campo").alias("texto"), "valor", "pagina")


# ---- row numbers of a whole sheet (V1), documents read once


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1 AS linha FROM orders")
def sheet_row_numbers(spark, sf_dir):
    return sheet_rows(table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey"), "o_orderdate", "o_orderkey", name="linha").select("o_orderkey", "linha")


@query(
    r"""WITH d AS (SELECT lpad(doc_id::VARCHAR, 12, '0') AS path, sha256(coalesce(text, '')) AS hash_arquivo, coalesce(text, '') AS text FROM documents),
            f AS (SELECT hash_arquivo, min(path) AS path, any_value(text) AS text, count(*) AS n FROM d GROUP BY 1)
       SELECT path, hash_arquivo, len(string_split(text, chr(10) || chr(10)))::BIGINT AS paginas, n - 1 AS copias, 0::BIGINT AS lidas_de_novo FROM f"""
)
def documents_read_once(spark, sf_dir):
    """Documents as files of pages parted by empty lines, read twice with a store: the second time decodes none of them."""
    text = F.coalesce("text", F.lit(""))
    read = table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.encode(text, "UTF-8").alias("content"))
    hashed = read.select("path", F.sha2("content", 256).alias("hash_arquivo"))
    kept = store.Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", "rules")
    extract = lambda content: [(page, []) for page in content.decode().split("\n\n")]
    store.decode(hashed, lambda wanted: read.join(wanted.select("path"), "path"), extract, kept)
    runs = kept.runs()
    pages, copies = store.decode(hashed, lambda wanted: read.join(wanted.select("path"), "path"), extract, kept)
    again = len(kept.runs()) - len(runs)
    of = copies.groupBy(F.col("canonico").alias("path")).agg(F.count("*").alias("n"))
    found = pages.groupBy("path", "hash_arquivo").agg(F.count("*").alias("paginas")).join(of, "path", "left")
    return found.select("path", "hash_arquivo", "paginas", F.coalesce("n", F.lit(0)).alias("copias"), F.lit(again).cast("long").alias("lidas_de_novo"))


# ---- text functions, sources and sinks


@query(
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '05/03/2024 00:00:00' WHEN 1 THEN '05/03/2024 10:30:00' WHEN 2 THEN '05/03/2024 10:30:15' WHEN 3 THEN '05/03/2024 00:00:00' WHEN 4 THEN 'ontem' ELSE NULL END AS quando,
              CASE p_partkey % 4 WHEN 0 THEN p_size || '.100' WHEN 1 THEN p_size * 10 || '.00' WHEN 2 THEN p_size::VARCHAR ELSE NULL END AS numero, CASE p_partkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false ELSE true END AS ativo,
              p_partkey % 3 = 0 AS vazia, p_partkey % 3 = 1 AS tem_unidade FROM part"""
)
def scalar_texts(spark, sf_dir):
    k, z = F.col("p_partkey"), F.col("p_size")
    size = z.cast("string")
    pick = lambda n, *options: F.element_at(F.array(*(F.lit(o) for o in options)), (k % n + 1).cast("int"))
    date = pick(6, "2024-03-05", "05/03/2024 10:30", "2024-03-05T10:30:15", "05/03/2024", "ontem", None)
    value = F.when(k % 4 == 0, z + 0.1).when(k % 4 == 1, z * 10.0).when(k % 4 == 2, z.cast("double"))
    source = F.when(k % 4 == 0, F.concat(size, F.lit(",100 mg/L"))).when(k % 4 == 1, F.concat(size, F.lit(",00 x 10 1"))).otherwise(size)
    return table(spark, sf_dir, "part").select(
        "p_partkey", sinks.datetime_text(date).alias("quando"), sinks.scaled(value, source).alias("numero"), X.boolean(pick(5, " Sim", "FALSO", "1", "não", None), True).alias("ativo"),
        X.is_blank_measure(pick(3, " n/a ", "5 palmos", "5 a 7")).alias("vazia"), has_loose_unit(pick(3, "x", "5 palmos", "5 a 7")).alias("tem_unidade"),
    )


@query(
    r"""WITH l AS (SELECT l_orderkey AS k, string_agg('{"n":' || l_linenumber || ',"v":' || l_quantity::INT || '.50,"t":"a\"b"}', ',' ORDER BY l_linenumber, l_quantity) AS rows FROM lineitem GROUP BY 1)
       SELECT o_orderkey::VARCHAR AS nome_do_arquivo, '{"arquivo":{"nome_do_arquivo":"' || o_orderkey || '"},"tabelas":{"cliente":[{"c":' || o_custkey || ',"nada":null}],"linhas":[' || coalesce(rows, '') || ']}}' AS value FROM orders LEFT JOIN l ON k = o_orderkey"""
)
def json_lines(spark, sf_dir):
    client = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("nome_do_arquivo"), F.col("o_custkey").alias("c"), F.lit(None).cast("string").alias("nada"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    lines = lines.select(F.col("l_orderkey").cast("string").alias("nome_do_arquivo"), F.col("l_linenumber").alias("n"), (F.col("l_quantity").cast("int") + 0.5).cast("double").alias("v"), F.lit('a"b').alias("t"))
    token = sinks.scaled(F.col("v"), F.concat(F.col("v").cast("int").cast("string"), F.lit(",50")))
    return sinks.jsonl({"cliente": client, "linhas": lines}, tokens={"linhas": {"v": token}}, order={"linhas": ["n", "v"]})


@query("SELECT conv_id AS doc_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations WHERE turn < 3 GROUP BY 1")
def document_preview(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"), "text")
    return documents.document_text(pages, most=3)


# ---- the batch (O2-O6, E7, F4, F7, F10, J19, B9): a document for each supplier


def batch_outputs(spark, sf_dir) -> dict[str, DataFrame]:
    """By the key modulo 5: out of scope, copies of one text, no client line, no table, whole; some could not be read."""
    rules = {
        "item_taxonomia": [(1, 7, "Laudo de água")], "template": [(1, 1, "agua", "sim", "1", None, None, None, 1, 50.0)], "schema": [(1, 1, "results_extract", "nao")],
        "item_schema": [(1, 1, "results_extract", "nome_do_arquivo", "texto", "nao")],
        "item_template": [
            (1, 1, "template_detection", "d", "água|agua", "rule_type=positive; peso=60", None), (2, 1, "category_alias", "Resultados", "resultados", None, None), (3, 1, "layout", "resultado_col", "x", "1", "Amostra"), (4, 1, "layout", "unidade_col", "x", "2", "Amostra"),
            (5, 1, "metadata", "id_amostra", r"amostra:\s*(\d+)", None, None), (6, 1, "client", "cliente", r"cliente:\s*(\w+)", None, None), (7, 1, "notes", "texto", r"nota:\s*(\w+)", None, None),
        ],
    }
    k = F.col("s_suppkey")
    line = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    number = F.when(k % 5 == 1, "7").otherwise(k.cast("string"))
    text = F.when(k % 5 == 0, line("outro ", k.cast("string"))).otherwise(F.concat_ws("\n", line("Laudo de água"), line("Amostra: ", number), F.when(k % 5 != 2, "Cliente: Rio"), F.lit("Nota: ok")))
    row = lambda *cells: F.array(*map(F.lit, cells))
    made = F.array(F.array(row("Resultados"), row("Análise", "Resultado", "Unidade"), row("Ferro", "< 0,5 mg/L", "mg/L"), row("Zinco", "1,2", "mg/L")))
    broken = k % 10 == 9
    pages = table(spark, sf_dir, "supplier").select(
        k.alias("doc_id"), F.lit(1).alias("page_no"), F.when(~broken, text).alias("text"), F.when(~broken & ~(k % 5).isin(0, 3), made).alias("tables"), line("/in/", F.lpad(k.cast("string"), 9, "0"), ".pdf").alias("path"), F.when(broken, "ValueError: x").alias("erro")
    )
    compiled = taxonomy.compile_rules({n: spark.createDataFrame(r, taxonomy.SCHEMAS[n]) for n, r in rules.items()})
    return batch.run(pages, compiled)


_SUPPLIERS = "WITH s AS (SELECT s_suppkey AS k, s_suppkey % 5 AS m, s_suppkey % 10 = 9 AS broken, lpad(s_suppkey::VARCHAR, 9, '0') || '.pdf' AS f FROM supplier), c AS (SELECT min(f) AS first FROM s WHERE m = 1)"


@query(
    _SUPPLIERS
    + """ SELECT f AS nome_do_arquivo, CASE WHEN broken THEN 'erro' WHEN m = 0 THEN 'fora_escopo' WHEN m = 1 AND f <> first THEN 'duplicado' ELSE 'identificado' END AS status, CASE WHEN m = 1 AND f <> first THEN first END AS duplicado_de,
                 CASE WHEN NOT broken AND (m IN (2, 4) OR m = 1 AND f = first) THEN 2 ELSE 0 END::BIGINT AS resultados, CASE WHEN broken THEN 'ValueError: x' END AS erro FROM s, c"""
)
def batch_summary(spark, sf_dir):
    return batch_outputs(spark, sf_dir)["resumo"].select("nome_do_arquivo", "status", "duplicado_de", "resultados", "erro")


@query(
    _SUPPLIERS
    + """ SELECT f AS nome_do_arquivo, CASE m WHEN 1 THEN '7' ELSE k::VARCHAR END AS id_amostra, CASE m WHEN 3 THEN 0 ELSE 2 END::BIGINT AS resultados_extraidos, 1::BIGINT AS registros_sample, 1::BIGINT AS registros_client, CASE m WHEN 3 THEN 0 ELSE 1 END::BIGINT AS tabelas_auditadas,
                 0::BIGINT AS erros_validacao, CASE m WHEN 3 THEN 'erro' ELSE 'ok' END AS status FROM s, c WHERE NOT broken AND m > 0 AND (m <> 1 OR f = first)"""
)
def batch_reconciliation(spark, sf_dir):
    return batch_outputs(spark, sf_dir)["document_reconciliation_audit"].select("nome_do_arquivo", "id_amostra", "resultados_extraidos", "registros_sample", "registros_client", "tabelas_auditadas", "erros_validacao", "status")
