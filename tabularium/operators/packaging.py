"""Packaging and preservatives: container rows of a section's tables, as DataFrame stages.

A page starts the section if its text names it. A page after one that starts the section without giving a row is in the
section too; whether a page gave one hangs, where it starts the section, on that page alone, so one ``lag`` tells. The
sample that a page names is good for the pages after it until some rows are found: a window over the page's events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import rule
from ..functions.text import nonblank
from .rows import first_of, row_text

COLUMNS = ["id_amostra", "identificacao_amostra", "embalagem", "volume", "preservacao", "metodos"]
CELLS = ["embalagem", "volume", "preservacao", "metodos"]
#: Rows above a header that may name the sample.
ABOVE = 2
TABLE = "array<struct<propria:boolean,cabecalho:int,acima:string,validas:array<array<string>>>>"


@dataclass(frozen=True)
class PackagingRules:
    """Patterns by role; without a section, header, container or volume pattern nothing is extracted."""

    section_start: tuple[str, ...] = ()
    table_header: tuple[str, ...] = ()
    sample_identification: tuple[str, ...] = ()
    container_value: tuple[str, ...] = ()
    volume_value: tuple[str, ...] = ()

    def complete(self) -> bool:
        return all((self.section_start, self.table_header, self.container_value, self.volume_value))


def any_of(patterns: tuple[str, ...], text: Column) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | F.coalesce(rule(p).found(text), F.lit(False))
    return found


def named_sample(patterns: tuple[str, ...], text: Column) -> Column:
    """What the first pattern that matches says: its first group, or the whole match where that is empty."""
    found = None
    for r in map(rule, patterns):
        whole = F.regexp_extract(text, r.java, 0)
        value = nonblank(F.coalesce(F.nullif(F.regexp_extract(text, r.java, 1), F.lit("")), whole) if r.groups else whole)
        found = F.when(r.found(text), value) if found is None else found.when(r.found(text), value)
    return F.lit(None).cast("string") if found is None else found


def table_facts(rules: PackagingRules, rows: Column, in_text: Column) -> Column:
    """struct(propria: names the section, cabecalho: 0-based row of the header, acima: sample named above it, validas)."""
    headed = F.transform(rows, lambda r: any_of(rules.table_header, row_text(r)))
    header = F.nullif(F.array_position(headed, True), F.lit(0)).cast("int") - 1
    above = F.reverse(F.slice(rows, F.greatest(header - ABOVE, F.lit(0)) + 1, F.least(header, F.lit(ABOVE))))
    named = F.filter(F.transform(above, lambda r: named_sample(rules.sample_identification, row_text(r))), lambda n: n.isNotNull())
    below = F.slice(rows, F.coalesce(header + 1, F.lit(0)) + 1, F.size(rows))
    cut = F.transform(below, lambda r: F.transform(F.sequence(F.lit(1), F.lit(len(CELLS))), lambda i: nonblank(F.try_element_at(r, i))))
    valid = F.filter(cut, lambda r: F.forall(r, lambda c: c.isNotNull()) & any_of(rules.container_value, F.get(r, F.lit(0))) & any_of(rules.volume_value, F.get(r, F.lit(1))))
    usable = F.when(header.isNotNull() | in_text, valid).otherwise(F.array().cast("array<array<string>>"))
    section = any_of(rules.section_start, F.array_join(F.transform(rows, row_text), " "))
    return F.struct(section.alias("propria"), header.alias("cabecalho"), F.when(header.isNotNull(), F.try_element_at(named, F.lit(1))).alias("acima"), usable.alias("validas"))


def extract_packaging(pages: DataFrame, rules: dict[str, PackagingRules]) -> DataFrame:
    """Container rows (doc_id, COLUMNS, in order of pagina, tabela_indice, linha) of ``pages`` (doc_id, template_id, page_no, text, tables).

    The pages are read once; each is judged by its own template's rules.
    """
    own = {t: r for t, r in rules.items() if r.complete()}
    if not own:
        nothing = [F.lit(None).cast("string").alias(c) for c in COLUMNS]
        return pages.limit(0).select("doc_id", F.col("page_no").alias("pagina"), F.lit(0).alias("tabela_indice"), F.lit(0).alias("linha"), *nothing)
    body = F.coalesce(F.col("text"), F.lit(""))
    by = lambda make: first_of([(F.col("template_id") == t, make(r)) for t, r in own.items()], None)
    tables = F.transform(F.coalesce("tables", F.array().cast("array<array<array<string>>>")), lambda t: F.transform(F.coalesce(t, F.array().cast("array<array<string>>")), lambda r: F.coalesce(r, F.array().cast("array<string>"))))
    # dealt by document before the patterns run: the windows keep that, and a small input file is no longer one task's work
    dealt = pages.where(F.col("template_id").isin([*own])).select("doc_id", "template_id", "page_no", "text", "tables").repartition("doc_id")
    read = dealt.select("doc_id", "template_id", "page_no", by(lambda r: any_of(r.section_start, body)).alias("inicia"), by(lambda r: named_sample(r.sample_identification, body)).alias("aqui"), by(lambda r: any_of(r.table_header, body)).alias("no_texto"), tables.alias("t"))
    found = read.withColumn("t", by(lambda r: F.transform("t", lambda rows: table_facts(r, rows, F.col("no_texto"))).cast(TABLE)))
    gives = lambda active: F.exists("t", lambda t: (F.size(t["validas"]) > 0) & F.when(t["cabecalho"].isNotNull(), active | t["propria"]).otherwise(active))
    order = Window.partitionBy("doc_id").orderBy("page_no")
    staged = found.withColumn("espera", F.coalesce(F.lag(F.col("inicia") & ~gives(F.lit(True))).over(order), F.lit(False)))
    staged = staged.withColumn("ativa", F.col("inicia") | F.col("espera")).withColumn("deu", gives(F.col("ativa")))
    # after a page: its rows end what was carried, else the sample that a starting page names is carried on
    named = F.when(F.col("inicia") & F.col("aqui").isNotNull(), F.struct(F.col("aqui").alias("v")))
    after = F.when(F.col("deu"), F.struct(F.lit(None).cast("string").alias("v"))).otherwise(named)
    carried = F.last(after, True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    staged = staged.withColumn("levada", carried["v"])
    tables = staged.select("doc_id", "page_no", "ativa", "aqui", "levada", F.posexplode("t").alias("i", "t"))
    tables = tables.where(F.when(F.col("t.cabecalho").isNotNull(), F.col("ativa") | F.col("t.propria")).otherwise(F.col("ativa")))
    rows = tables.select("doc_id", F.col("page_no").alias("pagina"), (F.col("i") + 1).alias("tabela_indice"), F.coalesce("t.acima", "aqui", "levada").alias("identificacao_amostra"), F.posexplode("t.validas").alias("linha", "c"))
    return rows.select("doc_id", "pagina", "tabela_indice", "linha", F.regexp_substr("identificacao_amostra", F.lit(r"\d+")).alias("id_amostra"), "identificacao_amostra", *(F.get("c", F.lit(k)).alias(c) for k, c in enumerate(CELLS)))
