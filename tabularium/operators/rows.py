"""Sections and result rows of page tables, as DataFrame stages.

1. ``events`` takes from the pages what can change the section: a small struct for each page, each table, each row that names
   a section or is a header, and each line of a page's text that names a section for the next one. Cells stay where they are.
2. ``folded`` gathers a document's events in order and folds them once: the section named last, the quality-control type,
   the layout of the last header, the report's code, and which tables are read. Titles and headers inside a table count
   only if it is read, which hangs on what came before; a fold knows that when it gets there.
3. ``sections`` joins what was in force, by ranges of rows, with the tables that are read.
4. ``result_rows`` filters and projects their rows.

Everything is partitioned by document; the events of a document are bounded by its tables. Rules are configuration and
become literal patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import line_rule
from ..functions.text import cell, collapse, fold, once
from ..plans.contracts import LAYOUT_FIELDS
from .sections import LINE_ENDS, report_code

# Header words, header cells, and lines that are no results.
HEADER_FIRST, HEADER_SECOND = ["analise", "parametros"], ["resultado", "numero do cq", "unidade"]
EXACT_ALIASES = {
    "analise": "parameter", "parametro": "parameter", "parametros": "parameter", "unidade": "unidade", "unid": "unidade",
    "resultado": "resultado", "resultados": "resultado", "cq": "numero_cq", "duplicata": "duplicata",
}
PATTERN_ALIASES = {
    "ld": r"^ld$|limite de deteccao", "lq": r"^lq$|limite de quantificacao", "incerteza": "incerteza", "referencia": "referencia",
    "data_inicio": "data de inicio|data inicio", "numero_cq": "numero do cq", "faixa_aceitacao": "faixa de aceitacao", "variacao_percentual": "variacao",
    "quantidade_adicionada": "quantidade adicionada|^qtd adicionada$", "recuperacao_percentual": "recuperacao",
    "copam_cerh": "copam|cerh|deliberacao normativa", "conama": "conama",
}
NO_RESULT = r"data\s+coleta|data\s+recebimento|responsabilidade|tipo\s+de\s+coleta"
MEASURED = r"^[<>]=?|[+-]?\d"
QA_TYPES = ["BRANCO", "DUPLICATA", "RECUPERACAO"]

#: Rows of a table that may hold its header, and that are looked at for results where there is none.
HEADER_ROWS, LOOKED_AT, WIDE, ENOUGH = 2, 5, 5, 2
#: What a text says of the section; ``geral``: by a rule that names no subcategory.
SECTION = "struct<categoria:string,subcategoria:string,tipo_registro:string,local:string,geral:boolean>"
ORDER = ["page_no", "tabela_indice", "linha"]


@dataclass(frozen=True)
class SectionRule:
    regex: str
    categoria: str
    subcategoria: str | None = None
    local: str = "laboratorio"
    tipo_registro: str = "AMOSTRA"
    extrair_subcategoria: bool = False


@dataclass(frozen=True)
class RuleSet:
    """Rules of one template, each list in the order in which it is tried."""

    categories: tuple[SectionRule, ...] = ()
    subcategories: tuple[SectionRule, ...] = ()
    types: tuple[SectionRule, ...] = ()
    continuations: tuple[tuple[str, str], ...] = ()  # pattern, tipo_registro
    header_aliases: tuple[tuple[str, str], ...] = ()  # pattern, field
    layouts: dict[str, dict[str, int]] = field(default_factory=dict)  # tipo_registro -> field -> 0-based column
    outside_labs: tuple[str, ...] = ()  # folded beginnings of titles that name another laboratory, not a section after their dash


def matches(text: Column, pattern: str) -> Column:
    return line_rule(pattern).found(text)


def first_of(options: list[tuple[Column, Column]], kind: str | None) -> Column:
    """The value of the first condition that holds, else null; ``kind`` None: of the values' own type."""
    if kind is None:
        return F.coalesce(*(F.when(c, v) for c, v in options))
    return F.coalesce(F.lit(None).cast(kind), *(F.when(c, v.cast(kind)) for c, v in options))


def by_template(rules: dict[str, RuleSet], make: Callable[[RuleSet], Column], kind: str) -> Column:
    return first_of([(F.col("template_id") == t, make(r)) for t, r in rules.items()], kind)


def row_text(cells: Column) -> Column:
    return F.array_join(F.filter(cells, lambda c: c != ""), " ")


# ---- what a text says of the section


def _section(categoria: Column, sub: Column, tipo: str, local: str, geral: bool = False) -> Column:
    return F.struct(categoria.alias("categoria"), sub.alias("subcategoria"), F.lit(tipo).alias("tipo_registro"), F.lit(local).alias("local"), F.lit(geral).alias("geral"))


def title(rules: RuleSet, raw: str = "raw", norm: str = "norm", after: str = "after") -> Column:
    """Section of a title; columns: its text, that folded, and what follows its first dash (null without one)."""
    own = F.col(raw)
    outside = reduce(lambda a, lab: a | F.col(norm).startswith(lab), rules.outside_labs, F.lit(False))
    rest = F.when(~outside, F.col(after))
    part = F.when(rest.isNotNull(), own)
    options = [(matches(F.col(norm), r.regex), _section(F.lit(r.categoria), F.lit(r.subcategoria) if r.subcategoria else own, r.tipo_registro, r.local)) for r in rules.subcategories]
    for r in rules.categories:
        found = F.coalesce(matches(rest, r.regex), F.lit(False)) | matches(F.col(norm), r.regex)
        options.append((found, _section(F.lit(r.categoria), F.lit(r.subcategoria) if r.subcategoria else part, "AMOSTRA", r.local, not r.subcategoria)))
    return F.when(F.col(norm) != "", first_of(options, SECTION))


def record_type(rules: RuleSet, text: str, raw: str = "raw") -> Column:
    """Section of a line that names a type of record."""
    none = F.lit(None).cast("string")
    own = lambda r: F.when(F.col(text).contains("-"), F.col(raw)) if r.extrair_subcategoria else none
    return first_of([(matches(F.col(text), r.regex), _section(F.lit(r.categoria), own(r), r.tipo_registro, "laboratorio")) for r in rules.types], SECTION)


def titled(df: DataFrame, text: Column, rules: dict[str, RuleSet], types: bool, name: str) -> DataFrame:
    """Add ``name``: what ``text`` says of the section, as a title or (with ``types``) as a type of record."""
    read = once(once(df, {"texto": text}), {"raw": collapse(F.coalesce("texto", F.lit("")))})
    read = once(read, {"norm": fold(F.col("raw")), "after": F.when(F.col("raw").contains(" - "), fold(F.regexp_extract("raw", r"(?s)^.*? - (.*)$", 1)))})
    mark = by_template(rules, title, SECTION)
    if types:
        mark = F.coalesce(mark, by_template(rules, lambda r: record_type(r, "texto"), SECTION))
    return once(read, {name: mark}).drop("texto", "raw", "norm", "after")


def named_last(before: Column, said: Column) -> Column:
    """Of two sections that lines of a page name, the one that counts: a title without subcategory does not displace one with a
    subcategory of the same category."""
    keeps = (before["categoria"] == said["categoria"]) & before["subcategoria"].isNotNull() & said["subcategoria"].isNull()
    return F.when(said.isNull() | F.coalesce(keeps, F.lit(False)), before).otherwise(said)


def named_on_page(pages: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """doc_id, template_id, page_no, secao of every page: the last section that its text names (``named_last``), null without one."""
    lines = pages.select("doc_id", "template_id", "page_no", F.posexplode(F.split(F.coalesce("text", F.lit("")), LINE_ENDS)).alias("n", "line"))
    named = titled(lines, F.col("line"), rules, False, "secao")
    said = F.array_sort(F.collect_list(F.when(F.col("secao").isNotNull(), F.struct("n", "secao"))))
    gathered = named.groupBy("doc_id", "template_id", "page_no").agg(said.alias("s"))
    last = F.aggregate("s", F.lit(None).cast(SECTION), lambda acc, x: named_last(acc, x["secao"].withField("geral", F.lit(False))))
    return gathered.select("doc_id", "template_id", "page_no", last.alias("secao"))


def left_to_next_page(pages: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """doc_id, template_id, page_no, secao: the last section that the text of the page before names."""
    order = Window.partitionBy("doc_id").orderBy("page_no")
    return named_on_page(pages, rules).withColumn("secao", F.lag("secao").over(order)).where("secao is not null")


# ---- headers and layouts


def is_header(cells: Column) -> Column:
    at = lambda i: fold(F.try_element_at(cells, F.lit(i)))
    return (F.size(cells) >= 2) & at(1).isin(HEADER_FIRST) & at(2).isin(HEADER_SECOND)


def header_field(rules: RuleSet, text: Column, parameter: bool = False) -> Column:
    """Field that a header cell's folded text names: by the rules' aliases, by exact ones, by patterns; with ``parameter`` that one too."""
    options = [(matches(text, p), F.lit(f)) for p, f in rules.header_aliases]
    options += [(text == word, F.lit(f)) for word, f in EXACT_ALIASES.items()]
    options += [(F.rlike(text, F.lit(p)), F.lit(f)) for f, p in PATTERN_ALIASES.items()]
    names = [f for _, f in rules.header_aliases] + [*EXACT_ALIASES.values()] + [*PATTERN_ALIASES]
    return F.when(text != "", first_of([o for o, f in zip(options, names) if parameter or f != "parameter"], "string"))


def header_layout(names: Column) -> Column:
    """Fields by header cell -> field -> 0-based column (the last that names it); null without a result column."""
    entries = F.transform(F.array(*map(F.lit, LAYOUT_FIELDS)), lambda f: F.struct(f.alias("f"), (F.size(names) - F.array_position(F.reverse(names), f)).cast("int").alias("i")))
    found = F.map_from_entries(F.filter(entries, lambda e: e["i"] < F.size(names)))
    return F.when(F.map_contains_key(found, "resultado"), found)


def _literal(layout: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for kv in layout.items() for x in kv)).cast("map<string,int>") if layout else F.create_map().cast("map<string,int>")


def base_layout(rules: RuleSet, tipo: Column) -> Column:
    known = [(tipo == t, _literal(own)) for t, own in rules.layouts.items() if own]
    return F.coalesce(first_of(known, "map<string,int>"), _literal(rules.layouts.get("AMOSTRA", {})))


# ---- stages

#: The place of what a page's text leaves to the next page: after the page's tables.
END = 2**31 - 1
LAYOUT = "array<struct<f:string,i:int>>"
EVENT = {
    "page_no": "int", "tabela_indice": "int", "linha": "int", "template_id": "string", "secao": SECTION, "continua": "string", "cabecalho": "boolean", "medidas": "array<int>", "layout": LAYOUT, "codigo": "string",
}
FORCE = f"struct<layout:{LAYOUT},tipo:string>"
PLACE = f"struct<page_no:int,tabela_indice:int,linha:int,categoria:string,subcategoria:string,tipo_registro:string,local:string,vigente:{FORCE},continua:string,codigo_laudo:string,ate:int>"
STATE = f"struct<ultima:string,base:{SECTION},presa:boolean,qualidade:string,outra:string,vigente:{FORCE},lida:boolean,codigo:string,pendente:{SECTION},fora:array<{PLACE}>>"


def numbered_tables(pages: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """Tables of the pages in scope, with the section that their first row names and the rows after it (``linhas``)."""
    own = pages.where(F.col("template_id").isin([*rules]))
    tables = own.select("doc_id", "template_id", "page_no", "text", F.posexplode("tables").alias("t", "todas")).where(F.size("todas") > 0)
    tables = tables.withColumn("todas", F.transform("todas", lambda r: F.coalesce(r, F.array().cast("array<string>"))))
    tables = titled(tables, row_text(F.get("todas", F.lit(0))), rules, True, "secao")
    return tables.withColumn("linhas", F.when(F.col("secao").isNull(), F.col("todas")).otherwise(F.slice("todas", 2, F.size("todas")))).withColumn("tabela_indice", F.col("t") + 1).drop("todas", "t")


def _measured(rows: Column) -> Column:
    """For each column, how many of the first rows have a name and a value in it; too narrow rows count for none."""
    filled = lambda c: F.coalesce(F.rlike(c, F.lit("[!-~]")), F.lit(False)) | (fold(c) != "")
    first = F.filter(F.slice(rows, 1, LOOKED_AT), lambda r: (F.size(r) >= WIDE) & filled(F.get(r, F.lit(0))))
    flags = F.transform(first, lambda r: F.transform(r, lambda c: F.rlike(F.trim(F.coalesce(c, F.lit(""))), F.lit(MEASURED))))

    def counted(shown: Column) -> Column:
        width = F.coalesce(F.array_max(F.transform(shown, lambda r: F.size(r))), F.lit(0))
        count = lambda i: F.size(F.filter(shown, lambda r: F.coalesce(F.get(r, i), F.lit(False))))
        return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), count)).otherwise(F.array().cast("array<int>"))

    return _let(flags, counted)  # named, or every column's count would look through the cells again


def events(pages: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """doc_id and EVENT of all that can change the section: pages, tables, marks inside tables, titles left to the next page.

    ``pages``: doc_id, template_id, page_no, text, tables, and optionally codigo_inicial, the report's code by other rules.
    They are read once: a page becomes its parts (itself, its tables, its text), and a part the lines that may say something.
    """
    own = pages.where(F.col("template_id").isin([*rules]))
    started = F.col("codigo_inicial") if "codigo_inicial" in pages.columns else F.lit(None).cast("string")
    own = own.withColumn("codigo", F.coalesce(report_code(F.coalesce("text", F.lit(""))), F.when(F.col("page_no") <= 1, started)))
    grid = "array<array<string>>"
    part = lambda at, rows, lines: F.struct(at.cast("int").alias("tabela_indice"), rows.cast(grid).alias("todas"), lines.cast("array<string>").alias("linhas_texto"))
    none = F.lit(None)
    of_tables = F.transform(F.coalesce("tables", F.array().cast(f"array<{grid}>")), lambda t, i: part(i + 1, F.transform(t, lambda r: F.coalesce(r, F.array().cast("array<string>"))), none))
    of_tables = F.filter(of_tables, lambda x: F.coalesce(F.size(x["todas"]), F.lit(0)) > 0)
    lines = F.split(F.coalesce("text", F.lit("")), LINE_ENDS)
    parts = own.select("doc_id", "template_id", "page_no", "codigo", F.explode(F.concat(F.array(part(F.lit(0), none, none)), of_tables, F.array(part(F.lit(END), none, lines)))).alias("x"))
    parts = parts.select("doc_id", "template_id", "page_no", "codigo", "x.*")
    page, table, end = F.col("tabela_indice") == 0, F.col("todas").isNotNull(), F.col("tabela_indice") == END

    # a table: the section that its first row names, what it continues, its header and its measured columns
    parts = titled(parts, F.when(table, row_text(F.get("todas", F.lit(0)))), rules, True, "secao")
    parts = parts.withColumn("linhas", F.when(F.col("secao").isNull(), F.col("todas")).otherwise(F.slice("todas", 2, F.size("todas"))))
    parts = parts.withColumn("primeira", F.when(table, F.try_element_at("linhas", F.lit(1))))
    spoken = F.array_join(F.transform("primeira", lambda c: F.coalesce(c, F.lit(""))), " ")
    goes_on = F.when(F.size("primeira") >= 2, by_template(rules, lambda r: first_of([(matches(F.col("falada"), p), F.lit(t)) for p, t in r.continuations], "string"), "string"))
    parts = parts.withColumn("falada", spoken).withColumn("continua", goes_on)
    parts = parts.withColumn("cabecalho", F.when(table, F.exists(F.slice("linhas", 1, HEADER_ROWS), lambda r: F.coalesce(is_header(r), F.lit(False)))))
    parts = parts.withColumn("medidas", F.when(table, _measured(F.col("linhas"))))

    # its rows, and the lines of the text
    unit = lambda i, text, cells: F.struct(i.cast("int").alias("linha"), text.cast("string").alias("t"), cells.cast("array<string>").alias("celulas"))
    rows = F.when(table, F.transform("linhas", lambda r, i: unit(i + 1, row_text(r), r)))
    said = F.when(end, F.transform("linhas_texto", lambda line, i: unit(i + 1, line, none)))
    first = F.array(unit(F.lit(0), none, none))
    units = F.when(page, first).when(end, said).otherwise(F.concat(first, rows))
    kept = ["doc_id", "template_id", "page_no", "tabela_indice"]
    heads = ["secao", "continua", "cabecalho", "medidas"]
    found = parts.select(*kept, "codigo", F.struct(*heads).alias("cab"), F.explode(units).alias("u")).select(*kept, "codigo", "cab", "u.*")
    head = F.col("linha") == 0
    found = titled(found, F.col("t"), {t: replace(r, types=()) for t, r in rules.items()}, False, "titulo")
    typed = by_template(rules, lambda r: record_type(r, "t"), SECTION)
    found = once(found, {"raw": F.when(F.col("titulo").isNull() & table_row(), collapse(F.coalesce("t", F.lit(""))))})
    found = once(found.withColumnRenamed("titulo", "dito"), {"titulo": F.when(table_row(), F.coalesce("dito", typed)).otherwise(F.col("dito").withField("geral", F.lit(False)))}).drop("dito")
    header = F.col("titulo").isNull() & table_row() & F.coalesce(is_header(F.col("celulas")), F.lit(False))
    found = once(found, {"nomeia": header}).withColumn("titulo", F.when(head, F.col("cab.secao")).otherwise(F.col("titulo")))
    found = found.where(head | F.col("titulo").isNotNull() | F.col("nomeia"))
    found = found.withColumn("dobradas", F.when(F.col("nomeia"), F.transform("celulas", lambda c: fold(c))))
    names = by_template(rules, lambda r: F.transform("dobradas", lambda c: F.coalesce(header_field(r, c), F.lit(""))), "array<string>")
    found = found.withColumn("nomes", F.when(F.col("dobradas").isNotNull(), names)).withColumn("disposto", header_layout(F.col("nomes")))
    found = found.withColumn("layout", F.transform(F.map_entries("disposto"), lambda e: F.struct(e["key"].alias("f"), e["value"].alias("i"))))
    own = {"secao": F.col("titulo"), "codigo": F.when(F.col("tabela_indice") == 0, F.col("codigo"))} | {c: F.when(head, F.col(f"cab.{c}")) for c in heads[1:]}
    return found.select("doc_id", *(own.get(c, F.col(c)).cast(kind).alias(c) for c, kind in EVENT.items()))


def table_row() -> Column:
    return (F.col("linha") > 0) & (F.col("tabela_indice") < END)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def result_column(rules: dict[str, RuleSet], template: Column, tipo: Column) -> Column:
    """0-based column of the result in the layout of a type of record; 1 where the layout has none."""
    of = lambda layout: F.lit(layout.get("resultado", 1))
    each = lambda r: F.coalesce(F.lit(None).cast("int"), *(F.when(tipo == t, of(own)) for t, own in r.layouts.items() if own), of(r.layouts.get("AMOSTRA", {})))
    return F.coalesce(*(F.when(template == t, each(r)) for t, r in rules.items()), F.lit(1)) if rules else F.lit(1)


def _step(rules: dict[str, RuleSet]) -> Callable[[Column, Column], Column]:
    def step(acc: Column, e: Column) -> Column:
        page, end, head = e["tabela_indice"] == 0, e["tabela_indice"] == END, e["linha"] == 0
        counts = head | acc["lida"]
        said = F.when(end, F.lit(None).cast(SECTION)).when(page, acc["pendente"]).when(counts, e["secao"])

        def after(s: Column) -> Column:
            # a general title leaves a section of its category with a subcategory as it is
            starts = s.isNotNull() & (~s["geral"] | F.coalesce(acc["ultima"] != s["categoria"], F.lit(True)))
            fresh = lambda x: F.when(~starts, x)
            goes_on = e["continua"]
            return _let(
                F.struct(
                    F.when(starts | (s.isNotNull() & ~acc["presa"]), s).otherwise(acc["base"]).alias("base"), F.coalesce(s["categoria"], acc["ultima"]).alias("ultima"),
                    F.coalesce(fresh(acc["qualidade"]), F.when(goes_on.isin(QA_TYPES), goes_on)).alias("qualidade"), F.coalesce(goes_on, fresh(acc["outra"])).alias("outra"),
                    (F.coalesce(fresh(acc["presa"]), F.lit(False)) | s["subcategoria"].isNotNull() | goes_on.isNotNull()).alias("presa"),
                ),
                lambda b: _let(tipo_of(b), lambda tipo: judge(b, tipo)),
            )

        def tipo_of(b: Column) -> Column:
            own = b["base"]["tipo_registro"]
            return F.when(own.isin(QA_TYPES), own).otherwise(F.coalesce(b["qualidade"], b["outra"], own, F.lit("AMOSTRA")))

        def judge(b: Column, tipo: Column) -> Column:
            header = F.when(counts & e["layout"].isNotNull(), F.struct(e["layout"].alias("layout"), tipo.alias("tipo")).cast(FORCE)).otherwise(acc["vigente"])
            place = lambda force: F.filter(F.when(force["tipo"] == tipo, force["layout"]), lambda x: x["f"] == "resultado")[0]["i"]
            at = F.coalesce(place(header), result_column(rules, e["template_id"], tipo))
            good = F.coalesce(F.get(e["medidas"], at), F.lit(0)) >= ENOUGH
            read = b["base"]["categoria"].isNotNull() & (e["continua"].isNotNull() | F.coalesce(e["cabecalho"], F.lit(False)) | ((tipo == "AMOSTRA") & good))
            lida = F.when(page | end, F.lit(False)).when(head, F.coalesce(read, F.lit(False))).otherwise(acc["lida"])
            code = F.coalesce(e["codigo"], acc["codigo"])
            goes_on, base = b["outra"].isNotNull(), b["base"]
            out = F.struct(
                e["page_no"], e["tabela_indice"], e["linha"], base["categoria"], F.when(goes_on, F.coalesce(base["subcategoria"], base["categoria"])).otherwise(base["subcategoria"]), tipo,
                F.when(goes_on, F.lit("laboratorio")).otherwise(base["local"]), header, e["continua"], code, F.lit(None).cast("int"),
            ).cast(PLACE)
            pending = F.when(end, named_last(acc["pendente"], e["secao"])).when(~page, acc["pendente"])
            return F.struct(b["ultima"], base, b["presa"], b["qualidade"], b["outra"], header, lida, code, pending, F.when(lida, F.concat(acc["fora"], F.array(out))).otherwise(acc["fora"])).cast(STATE)

        return _let(said, after)

    return step


def folded(found: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """What is in force in the tables that are read: doc_id, page_no, tabela_indice, and from row ``linha`` to before ``ate``
    (null: the end) categoria, subcategoria, tipo_registro, local, vigente, continua, codigo_laudo. Row 0 is the table's start.
    """
    nothing = F.lit(None)
    start = F.struct(nothing.cast("string"), nothing.cast(SECTION), F.lit(False), nothing.cast("string"), nothing.cast("string"), nothing.cast(FORCE), F.lit(False), nothing.cast("string"), nothing.cast(SECTION), F.array().cast(f"array<{PLACE}>")).cast(STATE)
    gathered = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*EVENT))).alias("e"))
    places = gathered.select("doc_id", F.aggregate("e", start, _step(rules))["fora"].alias("fora"))
    same = lambda x, y: (x["page_no"] == y["page_no"]) & (x["tabela_indice"] == y["tabela_indice"])
    ended = F.transform("fora", lambda x, i: x.withField("ate", _let(F.get("fora", i + 1), lambda y: F.when(same(x, y), y["linha"]))))
    return places.select("doc_id", F.explode(ended).alias("x")).select("doc_id", "x.*").withColumn("vigente", F.struct(F.map_from_entries("vigente.layout").alias("layout"), F.col("vigente.tipo").alias("tipo")))


def layout_in_force(rules: dict[str, RuleSet]) -> Column:
    own = F.when(F.col("vigente.tipo") == F.col("tipo_registro"), F.col("vigente.layout"))
    return F.coalesce(own, by_template(rules, lambda r: base_layout(r, F.col("tipo_registro")), "map<string,int>"))


def sections(pages: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """``folded`` with the tables that are read: template_id, text and linhas, the rows after one that names the section."""
    tables = numbered_tables(pages, rules)
    force = folded(events(pages, rules), rules)
    return tables.drop("secao").join(force, ["doc_id", "page_no", "tabela_indice"])


RECORD = ["codigo_laudo", "categoria", "subcategoria", "tipo_registro", "local", "parametro", *(f for f in LAYOUT_FIELDS if f != "unidade"), "unidade_resultado"]


def result_rows(states: DataFrame, rules: dict[str, RuleSet]) -> DataFrame:
    """doc_id, pagina, tabela_indice, seq and RECORD of each result, in order; ``states`` as ``sections`` gives them.

    The report's code is that of the page, or the last one before it.
    """
    upto = F.coalesce("ate", F.size("linhas") + 1) - F.col("linha") - 1
    rows = states.withColumn("colunas", layout_in_force(rules)).select("*", F.posexplode(F.slice("linhas", F.col("linha") + 1, upto)).alias("n", "celulas")).drop("linhas", "text")
    text, cells = row_text(F.col("celulas")), F.col("celulas")
    likely = (F.size(F.filter(cells, lambda c: c != "")) >= 2) & F.rlike(text, F.lit(r"(?U)\d")) & ~matches(text, NO_RESULT)
    rows = rows.where(likely & ~F.coalesce(is_header(cells), F.lit(False))).withColumn("parametro", cell(cells, F.lit(0)))
    at = lambda f: cell(cells, F.try_element_at("colunas", F.lit(f)))
    rows = rows.withColumn("linha", F.col("linha") + 1 + F.col("n")).withColumns({("unidade_resultado" if f == "unidade" else f): at(f) for f in LAYOUT_FIELDS})
    rows = rows.where(F.col("parametro").isNotNull() & F.rlike("resultado", F.lit(r"(?U)\d")))
    seq = F.row_number().over(Window.partitionBy("doc_id").orderBy(*ORDER))
    return rows.select("doc_id", F.col("page_no").alias("pagina"), "tabela_indice", seq.alias("seq"), *RECORD)
