"""Text sections and single fields found by patterns; all native.

Where rules are given by template, the pages are read once, and each page is judged by its own template's rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import faults, line_rule, rule
from ..functions.text import clean, collapse, fold

#: Forms carry codes of this shape where a validation key would stand.
FORM_CODE = r"(?i)^FO-ANL-\d+$"
FROM_FILE_NAME = "DERIVADO_DO_NOME_DO_PDF"
#: What ends a line of a page.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def judged(rules: list | dict[str, list], make: Callable[[list], Column], none: Column) -> Column:
    """``make`` of the rules: of all, or of those of the row's own template (``none`` for the others)."""
    if not isinstance(rules, dict):
        return make(rules)
    found = none
    for template, own in rules.items():
        found = F.when(F.col("template_id") == template, make(own)).otherwise(found)
    return found


MATCH = "array<struct<campo:string,valor:string,regra:int,pos:int>>"


def section_matches(pages: DataFrame, rules: list | dict[str, list], key: str = "doc_id", page: str = "page_no", text: str = "text") -> DataFrame:
    """(key, campo, valor, pagina): the value of every match of (campo, pattern) on every page, the first page of each value.

    Values are pre-aggregated by (document, campo, valor); nothing is sorted across documents.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def of(i: int, campo: str, pattern: str) -> Column:
        return F.transform(rule(pattern).values(body), lambda v, k: F.struct(F.lit(campo).alias("campo"), v.alias("valor"), F.lit(i).alias("regra"), k.alias("pos")))

    def matches(own: list) -> Column:
        each = [of(i, campo, pattern) for i, (campo, pattern, *_) in enumerate(own)]
        return (F.concat(*each) if each else F.array()).cast(MATCH)

    rows = pages.select(key, F.col(page).alias("pagina"), F.explode(judged(rules, matches, F.array().cast(MATCH))).alias("m")).where("m.valor is not null")
    first = rows.groupBy(key, F.col("m.campo").alias("campo"), F.col("m.valor").alias("valor")).agg(F.min(F.struct("pagina", "m.regra", "m.pos")).alias("f"))
    return first.select(key, "campo", "valor", F.col("f.pagina").alias("pagina"))


def validation_keys(pages: DataFrame, pattern: str, key: str = "doc_id") -> DataFrame:
    return section_matches(pages, [("chave_validacao", pattern)], key).where(~F.rlike("valor", F.lit(FORM_CODE)))


def field(text: Column, patterns: list) -> Column:
    """The first pattern that matches gives the value; a group that matched nothing, or no group at all, gives ``BASE``.

    Patterns may stand alone or as (pattern, group); how many groups they have is for the compiled pattern to say.
    """
    hits = []
    for pattern in patterns:
        r = line_rule(pattern if isinstance(pattern, str) else pattern[0])
        value = F.nullif(F.regexp_extract(text, r.java, 1), F.lit("")) if r.groups else F.lit(None).cast("string")
        hits.append(F.when(r.found(text), F.coalesce(value, F.lit("BASE"))))
    return F.coalesce(*hits)


def metadata(docs: DataFrame, rules: dict[str, list], text: str = "text") -> DataFrame:
    return docs.withColumns({campo: field(F.coalesce(F.col(text), F.lit("")), patterns) for campo, patterns in rules.items()})


def header_table(docs: DataFrame, rules: dict[str, str], keys: list[str], text: str = "text") -> DataFrame:
    """Sample or client row of each document: what the first match is worth, collapsed. The file-name sentinel is skipped."""
    usable = {c: p for c, p in rules.items() if p != FROM_FILE_NAME}
    return docs.select(*keys, *(rule(p).value(F.coalesce(F.col(text), F.lit(""))).alias(c) for c, p in usable.items()))


def report_code(text: Column) -> Column:
    return F.nullif(collapse(F.regexp_extract(text, r"(?iu)Relat[oó]rio\s+Anal[ií]tico(?:\s+Parcial)?\s+(\d+/\d+\.\d+(?:\.[A-Za-z0-9]+)*)", 1)), F.lit(""))


def report_number(text: Column) -> Column:
    """A report's number and, where it has one, its suffix of letters; white space before the number may be missing."""
    p = r"(?iu)Relat.rio\s+Anal.tico(?:\s+Parcial)?\s*(\d+/\d+\.\d+(?:\.[A-Z]{1,2})?)"
    return F.nullif(F.regexp_extract(text, p, 1), F.lit(""))


def planning_code(text: Column) -> Column:
    return F.regexp_substr(text, F.lit(r"(?i)\bCA\d+/\d{4}\b"))


def nonconformity(text: Column) -> Column:
    """A description of a nonconformity without the planning and coordinate lines that run into it."""
    bare = F.regexp_replace(text, r"(?iU)\s*Planejamento de Amostragem:\s*\S+\s*", " ")
    return collapse(F.regexp_replace(bare, r"(?iU)\s*(?:Latitude|Longitude)\s*\(coordenada\s+real\)\s*:\s*[+-]?\d+(?:[.,]\d+)?\s*", " "))


# Small words that a title writes in lower case.
SMALL_WORDS = ["a", "as", "da", "das", "de", "do", "dos", "e", "em", "para"]
#: A word of a folded text.
WORD = "[a-zà-ÿ]+"


def is_heading(line: Column) -> Column:
    """A line of one to ten words without digits or colon, in capitals or with its words capitalised."""
    words = F.regexp_extract_all(line, F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1))
    title = F.filter(words, lambda w: ~fold(w).isin(SMALL_WORDS))
    capitals = F.upper(line) == line
    shape = F.char_length(line).between(3, 100) & ~F.rlike(line, F.lit("(?U)[\\d:]")) & ~F.rlike(line, F.lit("[.,;;]$")) & F.size(words).between(1, 10) & ~F.rlike(line, F.lit("(?i)^[IVXLCDM]+$"))
    return shape & ((F.size(words) > 1) | capitals) & (capitals | ((F.size(title) > 0) & F.forall(title, lambda w: F.rlike(w, F.lit("^[A-ZÀ-Þ]")))))


def known(patterns: list[str], raw: Column, folded: Column) -> Column:
    """Whether any pattern explains a text as it stands or folded: rules for categories are written for folded text."""
    found = F.lit(False)
    for p in patterns:
        found = found | line_rule(p).found(raw) | line_rule(p).found(folded)
    return found


def table_texts(tables: Column, sharp: bool = True) -> Column:
    """Distinct folded texts of a page's cells, and of its rows' cells joined."""
    rows = F.flatten(F.transform(F.coalesce(tables, F.array().cast("array<array<array<string>>>")), lambda t: F.coalesce(t, F.array().cast("array<array<string>>"))))
    cells = F.transform(rows, lambda r: F.filter(F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda c: fold(clean(c, 300), sharp)), lambda c: c != ""))
    joined = F.filter(F.transform(cells, lambda r: F.array_join(r, " ")), lambda r: r != "")
    return F.array_distinct(F.concat(F.flatten(cells), joined))


def headings(pages: DataFrame, patterns: list[str] | dict[str, list[str]], key: str = "doc_id", text: str = "text", page: str = "page_no", sharp: bool = True) -> DataFrame:
    """Lines that look like headings and that no known pattern explains.

    (key, titulo: folded, original: as it is first met, pagina: where that is, paginas: all of them, ocorrencias,
    uma_grafia: whether it is written alike everywhere). Where
    ``pages`` has ``tables``, a line is left out that a cell or a row of the page's tables holds, or whose words all stand in
    them. Without a column ``page`` everything is on page 1. ``sharp``: as ``fold`` has it.
    """
    at = F.col(page) if page in pages.columns else F.lit(1)
    own = ["template_id"] if isinstance(patterns, dict) else []
    seen = table_texts(F.col("tables"), sharp) if "tables" in pages.columns else F.array().cast("array<string>")
    staged = pages.select(key, *own, at.alias("pagina"), F.split(F.coalesce(F.col(text), F.lit("")), LINE_ENDS).alias("linhas"), seen.alias("textos"))
    lines = staged.select(key, *own, "pagina", "textos", F.posexplode("linhas").alias("n", "linha")).withColumn("linha", clean(F.col("linha"), 100))
    found = lines.where(is_heading(F.col("linha"))).withColumn("titulo", fold(F.col("linha"), sharp))
    # a heading's words are compared with those of the page's tables only where it has any
    words = F.regexp_extract_all("titulo", F.lit(WORD), F.lit(0))
    there = F.regexp_extract_all(F.array_join("textos", " "), F.lit(WORD), F.lit(0))
    inside = F.exists("textos", lambda v: F.contains(v, F.col("titulo"))) | ((F.size(words) > 0) & (F.size(F.array_except(words, there)) == 0))
    fresh = found.where(~F.when(F.size("textos") > 0, inside).otherwise(False)).where(~judged(patterns, lambda p: known(p, F.col("linha"), F.col("titulo")), F.lit(False)))
    first = F.min_by(F.struct("linha", "pagina"), F.struct("pagina", "n")).alias("f")
    got = fresh.groupBy(key, "titulo").agg(first, F.array_sort(F.collect_set("pagina")).alias("paginas"), F.count("*").alias("ocorrencias"), (F.min("linha") == F.max("linha")).alias("uma_grafia"))
    return got.select(key, "titulo", F.col("f.linha").alias("original"), F.col("f.pagina").alias("pagina"), "paginas", "ocorrencias", "uma_grafia")


def label_of(pattern: str) -> str | None:
    """A rule's label: its text up to and with the colon before white space."""
    at = pattern.find(r":\s*")
    return pattern[: at + 1] if at >= 0 else None


FIELD_MATCH = "array<struct<i:int,schema_origem:string,campo:string,regra_encontrada:string,n:bigint,v:string>>"
# What the audit says of a status.
FIELD_NOTES = {
    "encontrado_sem_extracao": "A regra foi encontrada no PDF, mas o campo de saida ficou vazio.",
    "extraido_sem_correspondencia": "O campo foi preenchido sem correspondencia da regra no texto do PDF.",
    "possivel_contaminacao": "O valor extraido contem regra associada a outro campo.",
}


def note_of(notes: dict[str, str]) -> Column:
    """What is said of the column ``status``; null for the statuses that ``notes`` does not have."""
    return F.coalesce(F.lit(None).cast("string"), *(F.when(F.col("status") == s, F.lit(said)) for s, said in notes.items()))


def field_audit(pages: DataFrame, rules: list | dict[str, list], values: dict[str, DataFrame] | None = None, key: str = "doc_id", text: str = "text", page: str = "page_no") -> DataFrame:
    """One row for each document and rule (schema, campo, pattern): where it is met, the value, other fields' labels in it, status.

    Occurrences are counted page by page, ``pagina`` is the first with one. ``values``: schema -> table of ``key`` and
    the fields that were extracted; without it a rule's own first match is its value. Pages and values are aggregated by
    (document, rule); the texts are read once and never shuffled.
    """
    body, at = F.coalesce(F.col(text), F.lit("")), F.col(page) if page in pages.columns else F.lit(1)
    by = ["template_id"] if isinstance(rules, dict) else []

    def met(own: list) -> Column:
        each = [F.struct(F.lit(i).alias("i"), F.lit(s).alias("schema_origem"), F.lit(c).alias("campo"), F.lit(p).alias("regra_encontrada"), rule(p).count(body).cast("long").alias("n"), rule(p).value(body).alias("v")) for i, (s, c, p) in enumerate(own)]
        return (F.array(*each) if each else F.array()).cast(FIELD_MATCH)

    none = F.array().cast(FIELD_MATCH)
    each = pages.select(key, *by, at.alias("pagina"), F.explode(judged(rules, met, none)).alias("m")).select(key, *by, "pagina", "m.*")
    found = F.when(F.col("n") > 0, F.col("pagina"))
    audit = each.groupBy(key, *by, "i", "schema_origem", "campo", "regra_encontrada").agg(F.min(found).alias("pagina"), F.sum("n").alias("ocorrencias_detectadas"), F.min_by("v", F.when(F.col("v").isNotNull(), F.col("pagina"))).alias("v"))
    if values is not None:
        stacked = None
        for schema, df in values.items():
            fields = [c for c in df.columns if c != key]
            own = df.select(key, F.lit(schema).alias("schema_origem"), F.explode(F.array(*(F.struct(F.lit(c).alias("campo"), F.col(c).cast("string").alias("proprio")) for c in fields))).alias("x")).select(key, "schema_origem", "x.*")
            stacked = own if stacked is None else stacked.unionByName(own)
        one = stacked.where("proprio is not null").groupBy(key, "schema_origem", "campo").agg(F.min("proprio").alias("proprio"))
        audit = audit.join(one, [key, "schema_origem", "campo"], "left").withColumn("v", F.col("proprio")).drop("proprio")
    audit = audit.withColumn("valor_extraido", clean(F.col("v"), 500))

    def others(own: list) -> Column:
        labels = [(s, c, rule(label).java) for s, c, p in own if (label := _usable_label(p))]
        hits = [F.when(F.rlike("valor_extraido", F.lit(java)) & ~((F.col("schema_origem") == s) & (F.col("campo") == c)), F.lit(c)) for s, c, java in labels]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), "; ") if hits else F.lit("")

    audit = audit.withColumn("campos_detectados_no_valor", F.nullif(judged(rules, others, F.lit("")), F.lit("")))
    found, valued = F.col("ocorrencias_detectadas") > 0, F.col("valor_extraido").isNotNull()
    status = (
        F.when(found & ~valued, "encontrado_sem_extracao").when(~found & valued, "extraido_sem_correspondencia").when(valued & F.col("campos_detectados_no_valor").isNotNull(), "possivel_contaminacao").when(found, "ok").otherwise("nao_aplicavel")
    )
    audit = audit.withColumn("status", status).withColumn("observacao", note_of(FIELD_NOTES))
    return audit.select(key, "schema_origem", "campo", "pagina", "regra_encontrada", "ocorrencias_detectadas", "valor_extraido", "campos_detectados_no_valor", "status", "observacao")


def _usable_label(pattern: str) -> str | None:
    """A label that is a pattern of its own; one cut within a group is none."""
    label = label_of(pattern)
    return label if label and not faults(label) else None
