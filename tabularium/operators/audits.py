"""Audits of tables and sections: what was mapped, what fell back on a layout, what no rule explains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import Rule, rule
from ..functions.text import clean, collapse, fold, nonblank, once
from ..plans.contracts import LAYOUT_FIELDS
from .rows import MEASURED, RuleSet, base_layout, by_template, header_field, is_header, layout_in_force
from .sections import judged, known, note_of

# How a page's text names the columns of a table whose header is not in the table.
PAGE_HEADER = {
    "parameter": r"\b(analise|parametros?)\b", "resultado": r"\bresultados?\b", "unidade": r"\b(unidade|unid)\b", "data_inicio": r"data\s+(de\s+)?inicio", "conama": "conama",
    "copam_cerh": r"copam|cerh|deliberacao\s+normativa", "ld": r"(^|\s)ld($|\s)|limite\s+de\s+deteccao", "lq": r"(^|\s)lq($|\s)|limite\s+de\s+quantificacao", "referencia": "referencia",
    "incerteza": "incerteza", "numero_cq": r"numero\s+do\s+cq|(^|\s)cq($|\s)", "duplicata": "duplicata", "faixa_aceitacao": r"faixa\s+de\s+aceitacao", "variacao_percentual": "variacao",
    "quantidade_adicionada": r"quantidade\s+adicionada|qtd\s+adicionada", "recuperacao_percentual": "recuperacao",
}
#: Lines of a page that a header may run over, and fields that it must name at least, one of them the parameter.
HEADER_LINES, HEADER_FIELDS = 4, 3
#: Share of a table's rows that must be wide enough, and have a result, for its layout to be trusted.
CONFIDENT = 0.8


def expected_fields(rules: dict[str, RuleSet]) -> Column:
    """Fields that the layout of the type of record has, the parameter first."""
    base = by_template(rules, lambda r: base_layout(r, F.col("tipo_registro")), "map<string,int>")
    return F.concat(F.array(F.lit("parameter")), F.filter(F.array(*map(F.lit, LAYOUT_FIELDS)), lambda f: F.map_contains_key(base, f)))


def page_header(tables: DataFrame, wanted: Column) -> DataFrame:
    """``tables`` with titulo, nomeados: the lines of the page that name most of the fields in ``esperados``, and those in order.

    Windows of up to HEADER_LINES lines with text are tried; of equals the shortest text wins, then the first. Both are null
    without such a window, and where ``wanted`` does not hold. A table's windows stay in its row, so nothing is shuffled.
    """
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), r"\R"), lambda x: F.trim(x) != "")
    starts = F.when(F.size("__linhas") > 0, F.sequence(F.lit(0), F.size("__linhas") - 1))
    sizes = lambda i: F.filter(F.array(*map(F.lit, range(1, HEADER_LINES + 1))), lambda n: i + n <= F.size("__linhas"))
    each = lambda i: F.transform(sizes(i), lambda n: F.struct(i.alias("i"), n.alias("n"), F.array_join(F.slice("__linhas", i + 1, n), " ").alias("titulo")))
    named = lambda w, norm: F.filter(F.array(*(F.struct(F.regexp_instr(norm, F.lit(p)).alias("em"), F.lit(f).alias("campo")) for f, p in PAGE_HEADER.items())), lambda x: (x["em"] > 0) & F.array_contains("esperados", x["campo"]))
    ranked = lambda w, found: F.struct((-F.size(found)).alias("k"), F.char_length(w["titulo"]).alias("c"), w["i"].alias("i"), w["n"].alias("n"), w["titulo"].alias("titulo"), found.alias("achados"))
    found = F.transform("__janelas", lambda w: F.transform(F.array(fold(w["titulo"])), lambda norm: F.transform(F.array(named(w, norm)), lambda x: ranked(w, x))[0])[0])
    usable = F.filter(found, lambda w: (F.size(w["achados"]) >= HEADER_FIELDS) & F.exists(w["achados"], lambda x: x["campo"] == "parameter"))
    staged = tables.withColumn("__linhas", F.when(wanted, lines)).withColumn("__janelas", F.flatten(F.transform(starts, each))).withColumn("__m", F.array_min(usable))
    return staged.withColumn("titulo", F.col("__m.titulo")).withColumn("nomeados", F.transform(F.array_sort("__m.achados"), lambda x: x["campo"])).drop("__linhas", "__janelas", "__m")


def confidence(rows: Column, at: Column, wanted: Column) -> Column:
    """struct(sure, detalhe): whether enough of a table's rows reach the wanted columns and have a result where ``at`` puts it."""
    data = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(collapse(c) != "", F.lit(False))))
    last = F.array_max(F.transform(F.filter(wanted, lambda f: F.map_contains_key(at, f)), lambda f: F.try_element_at(at, f)))
    value = F.try_element_at(at, F.lit("resultado"))
    wide = lambda d, end: F.size(F.filter(d, lambda r: F.size(r) > end))
    valued = lambda d, v: F.coalesce(F.size(F.filter(d, lambda r: F.rlike(F.coalesce(F.get(r, v), F.lit("")), F.lit(MEASURED)))), F.lit(0))
    facts = F.transform(F.array(F.struct(data.alias("d"), last.alias("fim"), value.alias("v"))), lambda x: F.struct(F.size(x["d"]).alias("n"), x["fim"].alias("fim"), x["v"].alias("v"), wide(x["d"], x["fim"]).alias("w"), F.when(x["v"].isNotNull(), valued(x["d"], x["v"])).otherwise(0).alias("r")))

    def judge(x: Column) -> Column:
        sure = (x["n"] > 0) & (x["w"] >= x["n"] * CONFIDENT) & (x["v"].isNull() | (x["r"] >= x["n"] * CONFIDENT))
        of = lambda k, said: [x[k].cast("string"), F.lit("/"), x["n"].cast("string"), F.lit(said)]
        told = F.concat(F.lit("Compatibilidade do layout: "), *of("w", " linhas com colunas suficientes; "), *of("r", " linhas com valor na coluna de resultado."))
        detail = F.when(x["fim"].isNull(), "Layout sem posicoes cadastradas para os campos esperados.").when(x["n"] == 0, "Tabela sem linhas de dados avaliaveis.").otherwise(told)
        return F.struct(F.coalesce(sure, F.lit(False)).alias("sure"), detail.alias("detalhe"))

    return F.transform(facts, judge)[0]


def table_audit(states: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """Header, mapped, unmapped and absent columns, status and remarks of each table that is read (``states``: ``rows.sections``)."""
    tables = states.where(F.col("linha") == 0).withColumn("esperados", expected_fields(rules))
    header = F.try_element_at(F.filter(F.slice("linhas", 1, 3), is_header), F.lit(1))
    tables = tables.withColumn("cab", header).withColumn("proprio", F.coalesce(F.col("vigente.tipo") == F.col("tipo_registro"), F.lit(False)))
    shown, none, mode = ["categoria", "subcategoria", "tipo_registro"], F.lit(None).cast("string"), F.lit("contrato_e_descoberta").alias("modo_auditoria")
    texts = lambda x: F.array_join(x, "; ")

    # a table with a header: which columns it maps. All tables go one way, so that the sections are made and read once
    has = F.col("cab").isNotNull()
    columns = F.filter(F.transform("cab", lambda c: collapse(F.coalesce(c, F.lit("")))), lambda c: c != "")
    named = by_template(rules, lambda r: F.transform("dobradas", lambda x: F.struct(x["c"].alias("c"), header_field(r, x["n"], parameter=True).alias("f"))), "array<struct<c:string,f:string>>")
    own = tables.withColumn("colunas", columns)
    own = own.withColumn("dobradas", F.transform("colunas", lambda c: F.struct(c.alias("c"), fold(c).alias("n")))).withColumn("nomes", named)
    unmapped = F.transform(F.filter("nomes", lambda x: x["f"].isNull()), lambda x: x["c"])
    absent = F.when(has, F.filter("esperados", lambda f: (f != "parameter") & ~F.exists("nomes", lambda x: F.coalesce(x["f"] == f, F.lit(False)))))
    own = own.withColumn("sem", unmapped).withColumn("ausentes", absent)
    some, gone = F.size("sem") > 0, F.size("ausentes") > 0
    own_status = F.when(some & gone, "alerta_descoberta_com_opcional_ausente").when(some, "alerta_descoberta").when(gone, "ok_com_opcional_ausente").otherwise("ok")
    mapped = texts(F.transform(F.filter("nomes", lambda x: x["f"].isNotNull()), lambda x: F.concat(x["c"], F.lit(" -> "), x["f"])))
    said = lambda before, x: F.concat(F.lit(before), x, F.lit("."))
    own_remarks = F.concat_ws(" ", F.when(gone, said("Campos esperados ausentes no cabecalho: ", texts(F.col("ausentes")))), F.when(some, said("Colunas sem mapeamento: ", texts(F.col("sem")))), F.when(F.col("continua").isNotNull(), F.lit("Tabela reconhecida como continuacao de QA/QC.")))

    # one without: the page's text may name the columns, else the layout in force tells
    bare = page_header(own, ~has & ~F.col("proprio"))
    by_page = F.array_contains("nomeados", "parameter") & F.array_contains("nomeados", "resultado")
    place = F.map_from_entries(F.transform("nomeados", lambda f, i: F.struct(f, i)))
    first = F.create_map(F.lit("parameter"), F.lit(0))
    bare = bare.withColumn("at", F.when(~has, F.when(by_page, place).otherwise(F.map_concat(first, F.map_filter(layout_in_force(rules), lambda k, v: k != "parameter")))))
    bare = bare.withColumn("confia", F.when(~has, confidence(F.col("linhas"), F.col("at"), F.coalesce("nomeados", "esperados"))))
    sure = F.col("confia.sure")
    named_by_text = F.col("titulo").isNotNull()
    status = F.when(named_by_text & sure, "fallback_cabecalho_texto_layout_confiavel").when(named_by_text, "fallback_cabecalho_texto_layout_incompleto").when(sure, "fallback_layout_confiavel").otherwise("fallback")
    placed = F.transform(F.array_sort(F.transform(F.map_entries("at"), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k")))), lambda e: e["k"])
    heading = F.nullif(collapse(F.col("titulo")), F.lit(""))
    remarks = F.concat_ws(
        " ", F.lit("Tabela processada sem cabecalho detectado na malha extraida pelo PDF."), F.when(named_by_text, said("Cabecalho contextual encontrado no texto da pagina: ", heading)),
        F.when(named_by_text, said("Campos encontrados no texto da pagina: ", texts(F.col("nomeados")))), F.col("confia.detalhe"), F.lit("Foi usado o layout cadastrado na taxonomia."),
    )
    either = lambda name, with_header, without: F.when(has, with_header).otherwise(without).alias(name)
    return bare.select(
        "doc_id", F.col("page_no").alias("pagina"), "tabela_indice", *shown, mode, either("cabecalho_detectado", F.array_join("colunas", " | "), heading), either("colunas_detectadas", texts(F.col("colunas")), none),
        either("colunas_mapeadas", mapped, none), either("colunas_sem_mapeamento", texts(F.col("sem")), none), either("campos_esperados", texts(F.col("esperados")), texts(F.coalesce("nomeados", placed))),
        none.alias("campos_obrigatorios_ausentes"), either("campos_opcionais_ausentes", texts(F.col("ausentes")), none), (~has).alias("usou_fallback"), either("status", own_status, status), either("observacao", F.nullif(own_remarks, F.lit("")), remarks),
    )


# What the section audit says of a status.
SECTION_NOTES = {
    "ok": "Secao reconhecida e dados extraidos.",
    "ignorada": "Secao encontrada apenas com conteudo explicitamente ignorado pela taxonomia.",
    "encontrada_sem_extracao": "A secao foi encontrada, mas nenhum registro foi gerado.",
    "extraida_sem_titulo": "Foram gerados registros sem localizar a regra de inicio da secao.",
    "ausente": "Secao opcional nao encontrada no documento.",
    "tabela_nao_mapeada": "Estrutura tabular sem correspondencia nas regras conhecidas da taxonomia.",
}
SECTION_HIT = "array<struct<secao:string,achados:array<struct<regra:int,pos:int,titulo:string,padrao:string>>,ignora:boolean>>"
SECTION_COLUMNS = ["pagina", "tabela_indice", "objeto_tipo", "secao", "titulo_detectado", "modo_auditoria", "regra_encontrada", "ocorrencias_detectadas", "registros_extraidos", "status", "observacao"]


def known_sections(pages: DataFrame, sections: dict, extracted: DataFrame, key: str = "doc_id", text: str = "text", page: str = "page_no") -> DataFrame:
    """Each section (name -> title patterns, patterns to ignore) in each document: where its title is met first and by which rule.

    ``sections`` is such a mapping, or one for each template. ``extracted``: (key, secao, registros), the records that each
    section gave. A match carries its rule, page, place and title; ``min`` by page picks the first, so that nothing but
    the matches is shuffled. Without a column ``page`` everything is on page 1.
    """
    body, at = F.coalesce(F.col(text), F.lit("")), F.col(page) if page in pages.columns else F.lit(1)
    per_template = bool(sections) and all(isinstance(v, dict) for v in sections.values())

    def titles_of(i: int, r: Rule) -> Column:
        return F.transform(r.wholes(body), lambda m, k: F.struct(F.lit(i).alias("regra"), k.alias("pos"), clean(m, 300).alias("titulo"), F.lit(r.pattern).alias("padrao")))

    def hits(own: list) -> Column:
        each = []
        for name, (titles, ignored) in own:
            found = [titles_of(i, r) for i, r in enumerate(map(rule, titles))]
            matched = F.filter(F.concat(*found), lambda m: m["titulo"].isNotNull()) if found else F.array()
            skip = F.lit(False)
            for p in ignored:
                skip = skip | rule(p).found(body)
            each.append(F.struct(F.lit(name).alias("secao"), matched.cast("array<struct<regra:int,pos:int,titulo:string,padrao:string>>").alias("achados"), skip.alias("ignora")))
        return (F.array(*each) if each else F.array()).cast(SECTION_HIT)

    by = {t: [*own.items()] for t, own in sections.items()} if per_template else [*sections.items()]
    rows = pages.select(key, at.alias("pagina"), F.explode(judged(by, hits, F.array().cast(SECTION_HIT))).alias("s")).select(key, "pagina", "s.*")
    first = F.min(F.when(F.size("achados") > 0, F.struct("pagina", F.col("achados")[0].alias("m")))).alias("f")
    met = rows.groupBy(key, "secao").agg(F.sum(F.size("achados")).cast("long").alias("ocorrencias"), F.max("ignora").alias("ignorada"), first).join(extracted, [key, "secao"], "left")
    n, seen = F.coalesce("registros", F.lit(0)).cast("long"), F.col("ocorrencias") > 0
    why = F.when(seen & (n > 0), "ok").when(seen & F.col("ignorada"), "ignorada").when(seen, "encontrada_sem_extracao").when(n > 0, "extraida_sem_titulo").otherwise("ausente")
    told = met.withColumn("registros", n).withColumn("status", why).withColumn("observacao", note_of(SECTION_NOTES))
    status = F.when(F.col("status").isin("ignorada", "ausente"), "nao_aplicavel").otherwise(F.col("status"))
    return told.select(
        key, F.col("f.pagina").alias("pagina"), F.lit(None).cast("int").alias("tabela_indice"), F.lit("secao").alias("objeto_tipo"), "secao", F.col("f.m.titulo").alias("titulo_detectado"), F.lit("conhecida").alias("modo_auditoria"),
        F.col("f.m.padrao").alias("regra_encontrada"), F.col("ocorrencias").alias("ocorrencias_detectadas"), F.col("registros").alias("registros_extraidos"), status.alias("status"), "observacao",
    )


def discovered_headings(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Audit rows of ``sections.headings``."""
    none = F.lit(None).cast("string")
    said = F.concat(F.lit("Possivel titulo sem regra na taxonomia; paginas: "), F.array_join(F.col("paginas").cast("array<string>"), ", "), F.lit("."))
    return found.select(
        key, "pagina", F.lit(None).cast("int").alias("tabela_indice"), F.lit("secao").alias("objeto_tipo"), none.alias("secao"), F.col("original").alias("titulo_detectado"), F.lit("descoberta").alias("modo_auditoria"), none.alias("regra_encontrada"),
        F.col("ocorrencias").alias("ocorrencias_detectadas"), F.lit(0).cast("long").alias("registros_extraidos"), F.lit("secao_nao_mapeada").alias("status"), said.alias("observacao"),
    )


def unmapped_tables(pages: DataFrame, audited: DataFrame, patterns: list[str] | dict[str, list[str]], key: str = "doc_id") -> DataFrame:
    """Audit rows of tables that no audit row and no known pattern explains: two rows or more with two filled cells or more.

    ``pages``: key, page_no, tables; ``audited``: key, page_no, tabela_indice. Patterns are tried on the table's text as it
    stands and folded. The tables are filtered by their own content before they meet the audit.
    """
    by = ["template_id"] if isinstance(patterns, dict) else []
    tables = pages.select(key, *by, "page_no", F.posexplode("tables").alias("i", "linhas")).withColumn("tabela_indice", F.col("i") + 1)
    cells = F.transform("linhas", lambda r: F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda c: F.coalesce(nonblank(c), F.lit(""))))
    full = F.filter("celulas", lambda r: F.size(F.filter(r, lambda c: c != "")) >= 2)
    shortened = F.transform(F.flatten("celulas"), lambda c: c.substr(1, 300))
    rows = once(once(tables, {"celulas": cells}), {"texto": clean(F.array_join(shortened, " "), 2000), "cheias": full})
    rows = rows.select(key, *by, "page_no", "tabela_indice", "texto", "cheias").where(F.col("texto").isNotNull() & (F.size("cheias") >= 2))
    rows = once(rows, {"dobrado": fold(F.col("texto"))})
    rows = rows.where(~judged(patterns, lambda p: known(p, F.col("texto"), F.col("dobrado")), F.lit(False)))
    rows = rows.join(audited, [key, "page_no", "tabela_indice"], "left_anti")
    title = clean(F.array_join(F.transform(F.col("cheias")[0], lambda c: c.substr(1, 300)), " | "), 300)
    none = F.lit(None).cast("string")
    return rows.select(
        key, F.col("page_no").alias("pagina"), "tabela_indice", F.lit("tabela").alias("objeto_tipo"), none.alias("secao"), title.alias("titulo_detectado"), F.lit("descoberta").alias("modo_auditoria"), none.alias("regra_encontrada"),
        F.lit(1).cast("long").alias("ocorrencias_detectadas"), F.lit(0).cast("long").alias("registros_extraidos"), F.lit("tabela_nao_mapeada").alias("status"), F.lit(SECTION_NOTES["tabela_nao_mapeada"]).alias("observacao"),
    )
