"""Duplicate detection: exact files, equal texts, logical keys, conflicts of one sample, and what to skip.

All groups are sizes and firsts by key: aggregates with map-side combining, joined back. A key that holds a large share
of the rows is split by the engine's skewed-join handling; no group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import text_hash

# Columns of a result that its signature covers, what a replacing report says, reasons by status.
SIGNED = ["id_amostra", "categoria", "subcategoria", "parameter", "resultado", "lq", "ld"]
VERSION_MARKER = r"(?iu)cancela\s+e\s+substitui|substitui\s+o\s+relat.rio|relat.rio\s+revisad|retifica"
IDENTITY = ["id_taxonomia", "nome_taxonomia", "versao_template", "id_amostra", "identificacao_amostra", "data_publicacao", "data_coleta"]
REASONS = {
    "duplicado_exato_arquivo": "Outro PDF possui o mesmo hash binario SHA256.",
    "duplicado_textual": "Outro PDF possui o mesmo hash do texto normalizado.",
    "possivel_duplicado_laudo": "Outro PDF possui a mesma chave logica de laudo/amostra.",
    "possivel_versao_substituta": "Ha indicador textual de relatorio substituto/revisado.",
    "conflito_mesma_amostra": "A mesma amostra aparece em PDFs com assinatura de resultados diferente.",
    "unico": "Nenhuma duplicidade detectada no lote.",
}


def filled(x: Column) -> Column:
    return F.coalesce(F.trim(x.cast("string")) != "", F.lit(False))


def logical_key(identification: Column, sample: Column, published: Column, collected: Column) -> Column:
    part = lambda name, x: F.when(filled(x), F.concat(F.lit(f"{name}="), x.cast("string")))
    return F.coalesce(part("identificacao_amostra", identification), F.concat_ws("|", part("id_amostra", sample), part("data_publicacao", published), part("data_coleta", collected)))


def version_marker(text: Column) -> Column:
    """Whether a text says that it replaces or corrects another report."""
    return F.coalesce(F.rlike(text, F.lit(VERSION_MARKER)), F.lit(False))


def results_signature(results: DataFrame, key: str, columns: list[str] = SIGNED) -> DataFrame:
    """One signature for each document from its rows, whatever their order; columns that are not there do not count."""
    row = F.to_json(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if c in results.columns)))
    return results.groupBy(key).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), "\n"), 256).alias("assinatura_resultados"))


def duplicate_candidates(docs: DataFrame, results: DataFrame, sample: DataFrame) -> DataFrame:
    """What ``duplicate_audit`` takes, one row for each document.

    ``docs``: nome_do_arquivo, caminho_arquivo, text, hash_arquivo. Who a document is, its sample row says, and where
    that is silent its results do.
    """
    key = "nome_do_arquivo"

    def firsts(df: DataFrame, mark: str) -> DataFrame:
        there = [c for c in IDENTITY if c in df.columns]
        return df.groupBy(key).agg(*(F.max(F.col(c).cast("string")).alias(f"{mark}_{c}") if c in there else F.lit(None).cast("string").alias(f"{mark}_{c}") for c in IDENTITY))

    named = docs.join(firsts(sample, "s"), key, "left").join(firsts(results, "r"), key, "left").join(results_signature(results, key), key, "left")
    named = named.withColumns({c: F.coalesce(f"s_{c}", f"r_{c}") for c in IDENTITY})
    return named.select(
        key, "caminho_arquivo", *IDENTITY, "hash_arquivo", text_hash(F.col("text")).alias("hash_texto"), logical_key(*(F.col(c) for c in ("identificacao_amostra", "id_amostra", "data_publicacao", "data_coleta"))).alias("chave_laudo"),
        F.coalesce("assinatura_resultados", F.lit("")).alias("assinatura_resultados"), version_marker(F.col("text")).alias("possui_indicador_versao"),
    )


def _group(docs: DataFrame, by: str, order: Column, name: str) -> DataFrame:
    """(by, <name>_n, <name>_1, <name>_2): size of each group, and its first two different file names with null for none.

    Two aggregates by key, the first by key and name, so that no group is gathered.
    """
    there = F.col(by).isNotNull() if by.startswith("hash_") else filled(F.col(by))
    names = docs.where(there).groupBy(by, "nome_do_arquivo").agg(F.count("*").alias("n"), F.min(order).alias("o"))
    first = F.struct("o", F.col("nome_do_arquivo").alias("f"))
    # of each map task's names only the least two matter; a window keeps no more of them
    rank = F.row_number().over(Window.partitionBy(by).orderBy("o", "nome_do_arquivo"))
    two = names.withColumn("k", rank).where("k <= 2").groupBy(by).agg(F.min(first)["f"].alias(f"{name}_1"), F.max(F.when(F.col("k") == 2, F.col("nome_do_arquivo"))).alias(f"{name}_2"))
    return names.groupBy(by).agg(F.sum("n").alias(f"{name}_n")).join(two, by)


def duplicate_audit(candidates: DataFrame) -> DataFrame:
    """Status, group, reference and reason of each candidate (``duplicate_candidates``).

    The reference is the first other file name by lower-cased path. Blank keys and samples form no group.
    """
    order = F.lower("caminho_arquivo")
    named = candidates
    for by, name in (("hash_arquivo", "file"), ("hash_texto", "text"), ("chave_laudo", "key"), ("id_amostra", "sample")):
        named = named.join(_group(candidates, by, order, name), by, "left")
    signatures = candidates.where(filled(F.col("id_amostra")) & filled(F.col("assinatura_resultados"))).groupBy("id_amostra").agg((F.min("assinatura_resultados") != F.max("assinatura_resultados")).alias("differ"))
    named = named.join(signatures, "id_amostra", "left")
    many = lambda name: F.coalesce(F.col(f"{name}_n") > 1, F.lit(False))
    ladder = [
        (many("file"), "duplicado_exato_arquivo", "hash_arquivo", "file"),
        (many("text"), "duplicado_textual", "hash_texto", "text"),
        (many("key") & F.col("possui_indicador_versao"), "possivel_versao_substituta", "chave_laudo", "key"),
        (many("sample") & F.coalesce("differ", F.lit(False)), "conflito_mesma_amostra", "id_amostra", "sample"),
        (many("key"), "possivel_duplicado_laudo", "chave_laudo", "key"),
    ]
    other = lambda name: F.when(F.col(f"{name}_1") != F.col("nome_do_arquivo"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_2"))
    found = F.struct(F.lit("unico").alias("s"), F.lit("").alias("g"), F.lit(None).cast("string").alias("r"))
    for cond, status, by, name in ladder[::-1]:
        found = F.when(cond, F.struct(F.lit(status).alias("s"), F.concat(F.lit(f"{by}:"), F.col(by).cast("string")).alias("g"), other(name).alias("r"))).otherwise(found)
    reasons = F.create_map(*(F.lit(x) for kv in REASONS.items() for x in kv))
    done = named.withColumn("found", found)
    return done.select(*candidates.columns, F.col("found.s").alias("tipo_duplicidade"), F.col("found.g").alias("grupo_duplicidade"), F.col("found.r").alias("arquivo_referencia"), reasons[F.col("found.s")].alias("motivo"))


def reattached(audit: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of exact duplicates that were not extracted, with what the audit says of their canonical file.

    ``audit``: nome_do_arquivo, caminho_arquivo, ... of extracted files; ``plan``: caminho_arquivo, canonico (``canonical``).
    """
    copies = plan.where(F.col("caminho_arquivo") != F.col("canonico")).select(F.col("caminho_arquivo").alias("__copy"), F.col("canonico").alias("caminho_arquivo"))
    named = audit.join(copies, "caminho_arquivo").withColumn("caminho_arquivo", F.col("__copy")).withColumn("nome_do_arquivo", F.element_at(F.split("__copy", "/"), -1))
    return named.select(*audit.columns)


def canonical(docs: DataFrame, by: str, path: str, exempt: Column | None = None) -> DataFrame:
    """``docs`` with canonico: the path that sorts first, lower-cased, of the row's group (its own if exempt)."""
    rows = docs if exempt is None else docs.where(~exempt)
    first = rows.groupBy(by).agg(F.min(F.struct(F.lower(path).alias("o"), F.col(path).alias("p"))).alias("__first"))
    joined = docs.join(first, by, "left")
    own = F.lit(False) if exempt is None else exempt
    return joined.withColumn("canonico", F.when(own | F.col("__first").isNull(), F.col(path)).otherwise(F.col("__first.p"))).drop("__first")


def paths_to_skip(candidates: DataFrame) -> DataFrame:
    """Paths of the members of a file or text group that are not its canonical one; empty texts form no group."""
    by_file = canonical(candidates, "hash_arquivo", "caminho_arquivo")
    empty = ~filled(F.col("hash_texto")) | (F.col("hash_texto") == text_hash(F.lit("")))
    by_text = canonical(candidates, "hash_texto", "caminho_arquivo", F.coalesce(empty, F.lit(True)))
    skip = lambda df: df.where(F.col("caminho_arquivo") != F.col("canonico")).select("caminho_arquivo")
    return skip(by_file).union(skip(by_text)).distinct()
