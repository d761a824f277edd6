"""Raw result rows -> the 53 columns of results_extract, measures parsed; one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import is_complex_note, parse_measures, parse_results
from ..functions.text import is_blank_measure
from ..plans.contracts import RESULTS, TIPO_LABELS

#: Originals whose white space stays as it was read.
KEPT = {"resultado", "ld", "lq", "incerteza", "faixa_aceitacao"}


def report_suffix(code: Column) -> Column:
    return F.nullif(F.regexp_extract(code, r"\b\d+/\d{4}\.(\d+(?:\.[A-Za-z0-9]+)*)\b", 1), F.lit(""))


def start_of(text: Column) -> Column:
    """First date with its time, seconds and midnight filled in; null without a date."""
    p = r"\b(\d{2}/\d{2}/\d{4})(?:\s+(\d{2}:\d{2}(?::\d{2})?))?\b"
    day, hour = F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2)
    full = F.when(hour == "", "00:00:00").when(F.char_length(hour) == 5, F.concat(hour, F.lit(":00"))).otherwise(hour)
    return F.when(day != "", F.concat(day, F.lit(" "), full))


def tipo_label(tipo: Column) -> Column:
    labels = F.create_map(*(F.lit(x) for kv in TIPO_LABELS.items() for x in kv))
    return F.coalesce(F.try_element_at(labels, tipo), tipo)


def results_extract(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows``: what ``rows.result_rows`` gives, with the documents' identity; columns in ``keep`` follow as they are."""
    measured = ["conama", "copam_cerh", "ld", "lq", "incerteza", "faixa_aceitacao"]
    have = lambda name: F.col(name) if name in rows.columns else F.lit(None).cast("string")
    original = lambda name: F.when(~is_blank_measure(have(name)), have(name))
    written = lambda name: F.when(F.trim(have(name)) != "", have(name))
    parsed = parse_measures(rows, {f"__{f}": have(f) for f in measured}, both=("__faixa_aceitacao",))
    parsed = parse_results(parsed, {"__resultado": (have("resultado"), original("unidade_resultado"))})
    # a note is looked at once for its four columns
    parsed = parsed.withColumns({f"__{f}_nota": F.coalesce(is_complex_note(have(f)), F.lit(False)) for f in ("conama", "copam_cerh")})
    part = lambda f, p: F.col(f"__{f}.{p}")
    values: dict[str, Column] = {
        "acm_data_hora_extracao": F.lit(None).cast("string"), "tipo": tipo_label(have("tipo_registro")), "parameter": have("parametro"), "unidade": have("unidade_resultado"),
        "acm_codigo_laudo": report_suffix(have("codigo_laudo")), "acm_data_inicio": start_of(have("data_inicio")), "local": F.coalesce(have("local"), F.lit("laboratorio")),
        "acm_resultado_tratado": part("resultado", "valor"), "acm_qualificador": part("resultado", "qualificador"), "acm_unidade": part("resultado", "unidade"),
        "acm_incerteza_valor": part("incerteza", "minimo"), "acm_incerteza_unidade": part("incerteza", "unidade"),
        **{f: original(f) for f in ("ld", "lq", "incerteza", "faixa_aceitacao")}, **{f: written(f) for f in ("conama", "copam_cerh")},
        **{f"acm_{f}_{p}": part(f, p) for f in ("ld", "lq") for p in ("minimo", "maximo", "unidade")},
        **{f"acm_faixa_aceitacao_{p}": part("faixa_aceitacao", p) for p in ("operador", "minimo", "maximo", "unidade")},
    }
    for f in ("conama", "copam_cerh"):
        values |= {f"acm_{f}_{p}": F.when(~F.col(f"__{f}_nota"), part(f, p)) for p in ("operador", "minimo", "maximo", "unidade")}
    out = parsed.select(*(values.get(name, have(name)).alias(name) for name in RESULTS), *keep)
    strip = [f.name for f in out.schema if f.dataType.simpleString() == "string" and f.name in RESULTS and f.name not in KEPT]
    return out.withColumns({name: F.trim(name) for name in strip}).select(*RESULTS, *keep)


def normalize(rows: DataFrame, theme: str = "theme_id") -> DataFrame:
    """Only documents of the water theme have result rows; other themes have none."""
    return results_extract(rows.where(F.col(theme).contains("agua")) if theme in rows.columns else rows)
