"""Document reconciliation: rows of all sources become counts of one shape, and one aggregate by document adds them up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Audit statuses that are no alert.
TABLE_OK = ["ok", "ok_com_opcional_ausente", "fallback_layout_confiavel", "fallback_cabecalho_texto_layout_confiavel"]
SECTION_OK = ["ok", "nao_aplicavel"]
FIELD_OK = ["ok", "nao_aplicavel"]
IDENTITY = ["id_amostra", "id_taxonomia", "nome_taxonomia", "versao_template"]
DATES = ["data_coleta", "data_recebimento", "data_publicacao"]


def parse_date(x: Column) -> Column:
    """ISO dates and times, else day-first ones; null if neither.

    The colons and the T tell which one form can fit, so a text is tried once: a form that does not fit costs an exception.
    """
    t = F.trim(x.cast("string"))
    colons, tee = F.char_length(t) - F.char_length(F.replace(t, F.lit(":"), F.lit(""))), F.upper(t).contains("T")
    form = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.when(tee & (colons == 2), "yyyy-MM-dd'T'HH:mm:ss").when(~tee & (colons == 2), "yyyy-MM-dd HH:mm:ss").when(~tee & (colons == 0), "yyyy-MM-dd"))
    form = form.when(t.rlike(r"^\d{2}/\d{2}/"), F.when(colons == 2, "dd/MM/yyyy HH:mm:ss").when(colons == 1, "dd/MM/yyyy HH:mm").when(colons == 0, "dd/MM/yyyy"))
    of = lambda f: F.when(form == f, F.try_to_timestamp(t, F.lit(f)))
    return F.coalesce(*map(of, ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy"]))


def temporal_status(*dates: Column) -> Column:
    """ok if the dates that are there are in order, inconsistente if not, nao_avaliado with fewer than two."""
    there = F.array_compact(F.array(*dates))
    return F.when(F.size(there) < 2, "nao_avaliado").when(there == F.array_sort(there), "ok").otherwise("inconsistente")


def alert_counts(audit: DataFrame, accepted: list[str], name: str, key: str = "nome_do_arquivo") -> DataFrame:
    """Rows and alerts of each document; a null status is an alert."""
    return audit.groupBy(key).agg(F.count("*").alias(f"n_{name}"), F.sum((~F.coalesce("status", F.lit("")).isin(accepted)).cast("long")).alias(f"alertas_{name}"))


def unit_divergence(results: DataFrame, key: str = "nome_do_arquivo", parameter: str = "parameter", unit: str = "acm_unidade") -> DataFrame:
    """How many parameters of each document have more than one unit."""
    rows = results.where((F.trim(parameter) != "") & (F.trim(unit) != ""))
    return rows.groupBy(key, parameter).agg(F.count_distinct(unit).alias("n")).groupBy(key).agg(F.sum((F.col("n") > 1).cast("long")).alias("parametros_com_unidades_divergentes"))


def identity_divergence(frames: list[DataFrame], column: str, key: str = "nome_do_arquivo") -> DataFrame:
    """Whether a document has more than one value of a column over its tables."""
    rows = reduce(DataFrame.unionByName, [f.select(key, F.trim(F.col(column).cast("string")).alias("v")) for f in frames if column in f.columns])
    return rows.where("v <> ''").groupBy(key).agg((F.count_distinct("v") > 1).alias(f"diverge_{column}"))


def reconcile(results: DataFrame, sample: DataFrame, client: DataFrame, packaging: DataFrame, table_audit: DataFrame, section_audit: DataFrame, field_audit: DataFrame, errors: DataFrame) -> DataFrame:
    """One row for each document of results, sample or client.

    Errors belong to the file that they name (column nome_do_arquivo).
    """
    key = "nome_do_arquivo"
    text = lambda df, c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    filled = lambda x: F.nullif(F.trim(x), F.lit(""))
    counts = ["resultados_extraidos", "registros_sample", "registros_client", "embalagens_extraidas", "n_tabela", "alertas_tabela", "n_secao", "alertas_secao", "n_campo", "alertas_campo", "erros_validacao", "parametros_sem_nome", "parametros_com_unidades_divergentes"]

    def part(df: DataFrame, place: int, ones: dict[str, Column], own: dict[str, Column] | None = None) -> DataFrame:
        """Rows of one source: its place among the tables, counts, and identity (first, least and greatest value)."""
        own = own or {}
        of = lambda name, otherwise: own.get(name, otherwise).alias(name)
        identity = [x for c in IDENTITY for x in (of(f"first_{c}", text(df, c)), of(f"least_{c}", filled(text(df, c))), of(f"most_{c}", filled(text(df, c))))]
        dates = F.struct(*(text(df, d).alias(d) for d in DATES)) if place == 1 else F.lit(None).cast("struct<" + ",".join(f"{d}:string" for d in DATES) + ">")
        return df.select(F.col(key), F.lit(place).alias("place"), *(ones.get(c, F.lit(0)).cast("long").alias(c) for c in counts), *identity, dates.alias("dates"))

    # results are many: first by parameter, of which units are compared
    named = F.trim(F.coalesce("parameter", F.lit(""))) != ""
    unit = F.when(F.trim("acm_unidade") != "", F.col("acm_unidade"))
    firsts = [x for c in IDENTITY for x in (F.min(text(results, c)).alias(f"first_{c}"), F.min(filled(text(results, c))).alias(f"least_{c}"), F.max(filled(text(results, c))).alias(f"most_{c}"))]
    by_parameter = results.groupBy(key, "parameter").agg(F.count("*").alias("n"), F.coalesce(F.min(unit) != F.max(unit), F.lit(False)).alias("differ"), *firsts)
    own = {f"{w}_{c}": F.col(f"{w}_{c}") for w in ("first", "least", "most") for c in IDENTITY}
    nobody = {f"{w}_{c}": F.lit(None).cast("string") for w in ("first", "least", "most") for c in IDENTITY}
    one = F.lit(1)
    alert = lambda accepted: (~F.coalesce("status", F.lit("")).isin(accepted)).cast("long")
    parts = [
        part(by_parameter, 0, {"resultados_extraidos": F.col("n"), "parametros_sem_nome": F.when(~named, F.col("n")).otherwise(0), "parametros_com_unidades_divergentes": (named & F.col("differ")).cast("long")}, own),
        part(sample, 1, {"registros_sample": one}), part(client, 2, {"registros_client": one}), part(packaging, 3, {"embalagens_extraidas": one}),
        part(table_audit, 4, {"n_tabela": one, "alertas_tabela": alert(TABLE_OK)}, nobody),
        part(section_audit, 4, {"n_secao": one, "alertas_secao": alert(SECTION_OK)}, nobody),
        part(field_audit, 4, {"n_campo": one, "alertas_campo": alert(FIELD_OK)}, nobody),
        part(errors, 4, {"erros_validacao": one}, nobody),
    ]
    first = lambda c: F.min(F.when(F.col(f"first_{c}").isNotNull(), F.struct("place", f"first_{c}")))[f"first_{c}"].alias(c)
    wide = reduce(DataFrame.unionByName, parts).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("place").alias("place"), *(F.sum(c).alias(c) for c in counts), *(first(c) for c in IDENTITY), *((F.min(f"least_{c}") != F.max(f"most_{c}")).alias(f"diverge_{c}") for c in IDENTITY),
        F.min("dates").alias("d"),
    ).where("place < 3")
    wide = wide.withColumns({f"__{d}": parse_date(F.col("d")[d]) for d in DATES})
    wide = wide.withColumn("coerencia_temporal", F.when(F.col("d").isNotNull(), temporal_status(*(F.col(f"__{d}") for d in DATES))))
    diverges = {c: F.coalesce(F.col(f"diverge_{c}"), F.lit(False)) for c in IDENTITY}
    n = {c: F.col(c) for c in counts}
    temporal = F.coalesce("coerencia_temporal", F.lit("nao_avaliado"))
    say = lambda cond, text, count=None: F.when(cond, F.lit(text) if count is None else F.concat(F.lit(text), count.cast("string"), F.lit(".")))
    severe = [
        say(n["resultados_extraidos"] == 0, "Nenhum resultado extraido."),
        say(n["registros_sample"] != 1, "Cardinalidade de sample diferente de 1: ", n["registros_sample"]),
        say(n["registros_client"] != 1, "Cardinalidade de client diferente de 1: ", n["registros_client"]),
        *(say(diverges[c], f"Valores divergentes entre abas para {c}.") for c in IDENTITY),
    ]
    mild = [
        *(say(n[f"alertas_{k}"] > 0, f"Alertas de {k}: ", n[f"alertas_{k}"]) for k in ("tabela", "secao", "campo")),
        say(n["parametros_sem_nome"] > 0, "Resultados sem parametro: ", n["parametros_sem_nome"]),
        say(n["parametros_com_unidades_divergentes"] > 0, "Parametros com mais de uma unidade no documento: ", n["parametros_com_unidades_divergentes"]),
        say(temporal == "inconsistente", "Ordem temporal esperada: coleta <= recebimento <= publicacao."),
        say(n["erros_validacao"] > 0, "Erros de validacao associados ao documento: ", n["erros_validacao"]),
    ]
    status = F.when(F.coalesce(*severe).isNotNull(), "erro").when(F.coalesce(*mild).isNotNull(), "alerta").otherwise("ok")
    return wide.select(
        key, "id_taxonomia", "nome_taxonomia", "versao_template", "id_amostra",
        *(n[c].alias(c) for c in ("resultados_extraidos", "registros_sample", "registros_client", "embalagens_extraidas")),
        n["n_tabela"].alias("tabelas_auditadas"), n["n_secao"].alias("secoes_auditadas"),
        *(n[c].alias(c) for c in ("alertas_tabela", "alertas_secao", "alertas_campo", "erros_validacao", "parametros_sem_nome", "parametros_com_unidades_divergentes")),
        temporal.alias("coerencia_temporal"), status.alias("status"), F.nullif(F.concat_ws(" ", *severe, *mild), F.lit("")).alias("observacao"),
    )
