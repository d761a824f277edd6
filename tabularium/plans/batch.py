"""The batch: documents in, output tables and audits out.

Documents are classified once; the scoped ones, the section stages of ``operators.rows`` and each output are written to the
shared folder as they are made (``sources.scratch.settle``), for the audits after them read them again and again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import first_value
from ..functions.text import strict_decimal, text_hash
from ..operators import audits as A
from ..operators import classify as C
from ..operators import duplicates as D
from ..operators import rows as G
from ..operators import sections as S
from ..operators.normalize import results_extract
from ..operators.packaging import extract_packaging
from ..operators.reconcile import reconcile
from ..operators.validate import sheet_rows, validate
from ..sources.documents import document_text
from ..sources.scratch import settle
from .contracts import CLIENT, CLIENT_CONTRACT, FIELD_AUDIT, PACKAGING, PACKAGING_CONTRACT, PREFIX, RESULTS_CONTRACT, SAMPLE, SAMPLE_CONTRACT, SECTION_AUDIT, TABLE_AUDIT, TABLES
from .taxonomy import Compiled, known_patterns

KEY = "nome_do_arquivo"
IDENTITY = ["id_taxonomia", "nome_taxonomia", "versao_template"]
TEXT_SECTIONS = ["notes", "general_considerations", "conformity_statement", "validation_key", "revision_reason"]
AUDITS = ["table_extraction_audit", "section_extraction_audit", "field_extraction_audit", "classification_audit", "duplicate_audit", "validation_errors", "document_reconciliation_audit"]


def _fill(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns), *more)


def _shaped(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` in order; those that ``df`` lacks are null text."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def _by_template(rules: Compiled, make: Callable[[str], Column | None]) -> Column:
    """``make`` of each template for its own documents; one expression for all of them."""
    found = F.lit(None).cast("string")
    for t in rules.templates:
        if (value := make(t.template_id)) is not None:
            found = F.when(F.col("template_id") == t.template_id, value.cast("string")).otherwise(found)
    return found


def header_tables(docs: DataFrame, rules: Compiled) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sample and client rows of scoped documents (with their text), and their metadata; all templates at once.

    Identity and coordinates come from the metadata rules where a template has them, else from the table's own rules.
    """
    text = F.col("text")
    patterns = lambda t, group, campo: [p for c, p in rules.fields.get(t, {}).get(group, []) if c == campo and p != S.FROM_FILE_NAME]

    def own(group: str, campo: str) -> Column:
        return _by_template(rules, lambda t: first_value(text, p) if (p := patterns(t, group, campo)) else None)

    def meta(campo: str, otherwise: Column) -> Column:
        said = lambda t: S.field(text, found) if (found := patterns(t, "metadata", campo)) else None
        return F.coalesce(_by_template(rules, said), otherwise)

    sample = {c: own("sample", c) for c in SAMPLE if c not in PREFIX}
    sample |= {c: meta(c, sample[c]) for c in ("id_amostra", "data_coleta", "latitude", "longitude")}
    sample |= {"planejamento_amostragem": S.planning_code(sample["planejamento_amostragem"]), "descricao_nao_conformidade": S.nonconformity(sample["descricao_nao_conformidade"])}
    sample |= {c: strict_decimal(sample[c]) for c in ("latitude", "longitude", "latitude_real", "longitude_real")}
    client = {c: own("client", c) for c in CLIENT if c not in PREFIX}
    client |= {"id_amostra": meta("id_amostra", client["id_amostra"])}
    identity = [KEY, "id_taxonomia", "nome_taxonomia", "versao_template"]
    table = lambda values, columns: _fill(docs.select(*identity, *(v.alias(c) for c, v in values.items())), columns)
    names = sorted({c for own in rules.fields.values() for c, _ in own.get("metadata", [])} | {"codigo_laudo"})
    said = docs.select(KEY, *(meta(c, F.lit(None).cast("string")).alias(c) for c in names))
    return table(sample, SAMPLE), table(client, CLIENT), said


def text_sections(pages: DataFrame, rules: Compiled, group: str, ids: DataFrame) -> DataFrame:
    """A text table: every match of the group's rules for the table's own columns; form codes are no validation keys."""
    columns = TABLES[group]
    own = {t: [(c, p) for c, p in groups.get(group, []) if c in columns and c not in PREFIX] for t, groups in rules.fields.items()}
    found = S.section_matches(pages, {t: r for t, r in own.items() if r}, KEY)
    if group == "validation_key":
        found = found.where(~F.rlike("valor", F.lit(S.FORM_CODE)))
    return _fill(found.join(ids, KEY, "left").withColumn(columns[-1], F.col("valor")), columns)


def section_audit(pages: DataFrame, rules: Compiled, extracted: dict[str, DataFrame], tables: DataFrame) -> DataFrame:
    """Known sections, headings that no rule knows, and tables that no audit and no rule explains; the pages are read once for each."""
    known = {}
    for t in rules.templates:
        groups = rules.fields.get(t.template_id, {})
        role = lambda g, name: [p for c, p in groups.get(g, []) if c == name]  # noqa: B023, E731
        known[t.template_id] = {g: (role(g, "section_start") or [p for _, p in groups.get(g, [])], role(g, "audit_ignore")) for g in (*TEXT_SECTIONS, "packaging_preservatives")}
    counts = [df.groupBy(KEY).agg(F.count("*").alias("registros")).withColumn("secao", F.lit(g)) for g, df in extracted.items()]
    counted = reduce(DataFrame.unionByName, counts) if counts else pages.limit(0).select(KEY, F.lit(0).cast("long").alias("registros"), F.lit("").alias("secao"))
    of = lambda ignored: {t.template_id: known_patterns(rules, t.template_id, ignored) for t in rules.templates}
    found = A.known_sections(pages, known, counted, KEY)
    found = found.unionByName(A.discovered_headings(S.headings(pages, of(True), KEY), KEY))
    return found.unionByName(A.unmapped_tables(pages, tables.select(KEY, F.col("pagina").alias("page_no"), "tabela_indice"), of(False), KEY))


def run(pages: DataFrame, rules: Compiled, first_pages: int = 3, tabs: list[str] | None = None, copies: DataFrame | None = None) -> dict[str, DataFrame]:
    """``pages``: doc_id, page_no, text, tables, and optionally path, hash_arquivo and erro.

    ``tabs``: the outputs that are asked for (all without it); only they are validated and given, audits besides.
    ``copies``: (path, canonico, hash_arquivo) of files that were not read because another has their bytes.

    Documents whose first pages (0: this is left out) have text and no template stay what those pages make them; the rest
    is read in full. Of documents of one theme with equal texts the first path is extracted, and the others are attached
    again to the duplicate audit and the summary. Documents that could not be read have ``erro``. A validation error's row
    number is its row's place in the whole sheet, by file, plus two. Rules that cannot be run are in regras_em_quarentena.
    """
    tabs = [n for n in TABLES if tabs is None or n in tabs]
    for name in ("path", "hash_arquivo", "erro"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.col("doc_id").cast("string") if name == "path" else F.lit(None).cast("string"))
    of_file = lambda df: df.withColumn(KEY, F.element_at(F.split("path", "/"), -1))
    failed = of_file(pages.where(F.col("erro").isNotNull()).groupBy("doc_id").agg(F.min("path").alias("path"), F.min("erro").alias("erro")))
    good = pages.join(failed.select("doc_id"), "doc_id", "left_anti")
    if first_pages:
        kept = C.preclassified(good, rules.templates, rules.detection, first_pages).select("doc_id").distinct()
        good = good.join(kept.withColumn("__kept", F.lit(True)), "doc_id", "left").where(F.col("__kept") | (F.col("page_no") <= first_pages)).drop("__kept")
    whole = document_text(good).join(good.groupBy("doc_id").agg(F.min("path").alias("path"), F.min("hash_arquivo").alias("hash_arquivo")), "doc_id")
    classified = settle(C.classify(of_file(whole), rules.templates, rules.detection, path="path"), "classified")
    scoped = C.winners(classified, rules.templates).withColumn("hash_texto", text_hash(F.concat_ws("|", "theme_id", "text")))
    scoped = D.canonical(scoped, "hash_texto", "path", ~D.filled(F.col("text"))).withColumn("hash_arquivo", F.coalesce("hash_arquivo", F.sha2("text", 256)))
    scoped = settle(scoped, "scoped")
    first = scoped.where("path = canonico")
    identity = first.select("doc_id", KEY, "id_taxonomia", "nome_taxonomia", "versao_template", "template_id", "theme_id")
    own = settle(good.drop("path", "hash_arquivo", "erro").join(identity, "doc_id"), "pages")

    sample, client, said = (settle(df, "header") for df in header_tables(first, rules))
    ids = sample.select(KEY, "id_amostra", *IDENTITY)
    coded = own.join(said.select(KEY, F.col("codigo_laudo").alias("codigo_inicial")), KEY, "left")
    states = settle(G.sections(coded, rules.rows), "sections")
    records = G.result_rows(states, rules.rows).join(identity, "doc_id")
    water = records.where(F.col("theme_id").contains("agua"))
    results = results_extract(water.join(sample.select(KEY, "id_amostra", "codigo_laudo_substituido"), KEY, "left"), keep=("seq",))
    results = settle(results, "results")
    packaging = settle(_fill(extract_packaging(own, rules.packaging).join(identity, "doc_id"), PACKAGING, "pagina", "tabela_indice", "linha"), "packaging")

    named = {g: settle(text_sections(own, rules, g, ids), g) for g in TEXT_SECTIONS}
    known = identity.select("doc_id", KEY, *IDENTITY)
    tables = settle(_shaped(A.table_audit(states, rules.rows).join(known, "doc_id"), TABLE_AUDIT), "table-audit")
    by_file = own.select(KEY, "template_id", "page_no", "text", "tables")
    about = known.drop("doc_id")
    sections = section_audit(by_file, rules, named | {"packaging_preservatives": packaging}, tables)
    sections = settle(_shaped(sections.join(about, KEY), SECTION_AUDIT), "section-audit")
    audited = {t: [(g, c, p) for g in ("metadata", "sample", "client") for c, p in groups.get(g, []) if c and p != S.FROM_FILE_NAME] for t, groups in rules.fields.items()}
    fields = S.field_audit(by_file, audited, {"metadata": said, "sample": sample.drop(*IDENTITY, "acm_data_hora_extracao"), "client": client.drop(*IDENTITY, "acm_data_hora_extracao")}, KEY)
    field_audit = settle(_shaped(fields.join(about, KEY), FIELD_AUDIT), "field-audit")

    candidates = settle(D.duplicate_candidates(first.select(KEY, F.col("path").alias("caminho_arquivo"), "text", "hash_arquivo"), results, sample), "candidates")
    plan = scoped.select(F.col("path").alias("caminho_arquivo"), "canonico", F.col("hash_arquivo").alias("__own"))
    if copies is not None:
        # what a file that was not read is a copy of, may have been dropped for its text itself
        of = copies.select(F.col("path").alias("copia"), F.col("canonico").alias("caminho_arquivo"), F.col("hash_arquivo").alias("__own"))
        plan = plan.unionByName(of.join(plan.drop("__own"), "caminho_arquivo").select(F.col("copia").alias("caminho_arquivo"), "canonico", "__own"))
    again = D.reattached(candidates, plan).join(plan.select("caminho_arquivo", "__own"), "caminho_arquivo").withColumn("hash_arquivo", F.col("__own")).select(*candidates.columns)

    sheets = {
        "results_extract": (results, RESULTS_CONTRACT, ["seq"]), "sample": (sample, SAMPLE_CONTRACT, []), "client": (client, CLIENT_CONTRACT, []),
        "packaging_preservatives": (packaging, PACKAGING_CONTRACT, ["pagina", "tabela_indice", "linha"]),
    }
    errors = [validate(sheet_rows(df, KEY, *order).drop(*order), contract, name, row_number="__n", parameter="parameter" if name == "results_extract" else None) for name, (df, contract, order) in sheets.items() if name in tabs]
    if not errors:
        errors = [validate(client.limit(0), CLIENT_CONTRACT, "client")]
    errors = settle(reduce(DataFrame.unionByName, errors), "errors")
    results, packaging = results.drop("seq"), packaging.drop("pagina", "tabela_indice", "linha")
    out = {"results_extract": results, "sample": sample, "client": client, "packaging_preservatives": packaging, **named}
    out = {n: out[n] for n in tabs}
    out |= {
        "table_extraction_audit": tables, "section_extraction_audit": sections, "field_extraction_audit": field_audit, "classification_audit": C.classification_audit(classified, KEY),
        "duplicate_audit": D.duplicate_audit(settle(candidates.unionByName(again), "duplicates")), "validation_errors": errors,
        "document_reconciliation_audit": reconcile(results, sample, client, packaging, tables, sections, field_audit, errors),
    }
    out["resumo"] = summary(classified, scoped, results, failed, copies)
    out["regras_em_quarentena"] = rules.quarantine(pages.sparkSession)
    return out


def summary(classified: DataFrame, scoped: DataFrame, results: DataFrame, failed: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """One row for each document: identificado, duplicado, fora_escopo or erro; how many results; what went wrong."""
    counts = results.groupBy(KEY).agg(F.count("*").alias("resultados"))
    same = scoped.where("path <> canonico").select("doc_id", F.element_at(F.split("canonico", "/"), -1).alias("duplicado_de"))
    base = C.classification_summary(classified, "doc_id", KEY, "path").join(same, "doc_id", "left").join(counts, KEY, "left")
    status = F.when(F.col("duplicado_de").isNotNull(), "duplicado").otherwise(F.col("status"))
    done = base.select(KEY, F.col("path").alias("caminho_arquivo"), "template_id", status.alias("status"), "scores", "duplicado_de", F.coalesce("resultados", F.lit(0)).alias("resultados"), F.lit(None).cast("string").alias("erro"))
    lost = failed.select(KEY, F.col("path").alias("caminho_arquivo"), F.lit(None).cast("string").alias("template_id"), F.lit("erro").alias("status"), F.lit(None).cast("string").alias("scores"), F.lit(None).cast("string").alias("duplicado_de"), F.lit(0).cast("long").alias("resultados"), "erro")
    every = done.unionByName(lost)
    if copies is None:
        return every
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    unread = copies.select(name("path").alias(KEY), F.col("path").alias("caminho_arquivo"), name("canonico").alias("duplicado_de"))
    return every.unionByName(unread.select(KEY, "caminho_arquivo", F.lit(None).cast("string").alias("template_id"), F.lit("duplicado").alias("status"), F.lit(None).cast("string").alias("scores"), "duplicado_de", F.lit(0).cast("long").alias("resultados"), F.lit(None).cast("string").alias("erro")))


def classify_batch(pages: DataFrame, rules: Compiled, first_pages: int = 3, copies: DataFrame | None = None) -> DataFrame:
    """Status and scores of each document by its first pages (0: all); documents that could not be read have status erro.

    ``copies``: (path, canonico) of files that were not read; they get what the file that they equal got.
    """
    for name in ("path", "erro"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.col("doc_id").cast("string") if name == "path" else F.lit(None).cast("string"))
    about = pages.groupBy("doc_id").agg(F.min("path").alias("path"), F.min("erro").alias("erro"))
    done = C.classification_summary(C.classify(document_text(pages, most=first_pages or None).join(about, "doc_id"), rules.templates, rules.detection, path="path"), "path", "erro")
    found = done.select("path", F.when(F.col("erro").isNull(), F.col("template_id")).alias("template_id"), F.when(F.col("erro").isNull(), F.col("status")).otherwise("erro").alias("status"), "scores", "erro")
    if copies is None:
        return found
    again = copies.select(F.col("path").alias("copia"), F.col("canonico").alias("path")).join(found, "path").drop("path").withColumnRenamed("copia", "path")
    return found.unionByName(again)
