"""Measures in laboratory text -> operator, bounds, unit: columns in stages, each pattern evaluated once a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import MEASURE_MARKERS, collapse, fold, pt_number

# The known units, in the order in which they are tried at a place.
UNITS = (
    r"Pt/Co\s*\(mgPt/L\)", r"mg/L\s*\(como\s*[^)]+\)", r"NMP/100\s*mL", r"NMP/100mL", r"UFC/100\s*mL", r"UFC/100mL",
    "µS/cm", "uS/cm", "µg/L", "ug/L", r"mg\s*Pt(?:\s*-?\s*Co)?\s*/\s*L", "mL/L", "mg/L", "UNT", "NTU", "NMP/mL",
    "UFC/mL", "mg/kg", "°C", "pH", "mV", "‰", "%", "Pt/Co", "(?<![A-Za-zÀ-ÿ/])m(?![A-Za-zÀ-ÿ/])",
)
#: Every unit begins with one of the letters looked for first, so that most places are passed at once.
UNIT = "(?iu)(?=[PMNUµ°‰%])(?:" + "|".join(UNITS) + ")"
LOOSE_UNIT = r"(?iu)[+-]?[\d.,]+(?:\s*x\s*10\s*[+-]?\d+)?\s+([A-Za-zÀ-ÿµ°‰%][A-Za-zÀ-ÿ0-9µ°‰%/()._-]*)"
NOT_UNITS = ["a", "e", "x", "para"]
SIGN = r"^\s*(<=|>=|<|>|=)"
PREFIX = r"(?iu)^\s*(?:M[aá]x\.?|M[ií]n\.?|M[aá]ximo|M[ií]nimo|<=|>=|<|>|=)\s*"
RANGE = r"(?iU)([+-]?[\d.,]+)\s*(?:-|\ba\b)\s*([+-]?[\d.,]+)"
SINGLE = r"([<>]?)\s*([+-]?[\d.,]+)"
RESULT = r"(?i)([<>]?)\s*([+-]?[\d.,]+)(?:\s*x\s*10\s*([+-]?\d+))?"


def known_unit(x: Column) -> Column:
    return F.regexp_substr(x, F.lit(UNIT))


def has_loose_unit(x: Column) -> Column:
    """A number followed by a word that could be a unit."""
    words = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(LOOSE_UNIT), F.lit(1))
    return F.exists(words, lambda w: ~fold(w).isin(NOT_UNITS))


def _without_unit(x: Column, unit: Column) -> Column:
    at = F.instr(x, unit)
    cut = F.concat(F.substring(x, F.lit(1), at - 1), F.substring(x, at + F.char_length(unit), F.char_length(x)))
    return F.when(unit.isNull(), x).otherwise(collapse(cut))


def _staged(cells: Column, *stages: dict) -> Column:
    """An array of structs, a stage at a time: a stage's fields are there for the next; what is made by None is dropped."""

    def add(kept: list[str], stage: dict):
        return lambda x: F.struct(*(x[k].alias(k) for k in kept), *(make(x).alias(k) for k, make in stage.items() if make))

    known = [*stages[0]]
    for stage in stages[1:]:
        kept = [k for k in known if k not in stage]
        cells, known = F.transform(cells, add(kept, stage)), kept + [k for k, make in stage.items() if make]
    return cells


def parse_measures(df: DataFrame, texts: dict[str, Column], both: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a struct(operador, minimo, maximo, unidade) of the text of each name.

    For names in ``both`` a single value sets both bounds whatever its operator. The texts are worked on as one array, so that
    the generated code does not grow with them: Java does not compile a method of more than 8,000 bytes.
    """
    blank_to_null = lambda x: F.when(x != "", x)
    named = lambda w: F.when(F.rlike(w, F.lit(r"^(max\.|max |maximo)")), "max").when(F.rlike(w, F.lit(r"^(min\.|min |minimo)")), "min")

    def measure(x: Column) -> Column:
        ranged, single, operator = x["low"] != "", x["number"] != "", x["operator"]
        of = lambda *signs: ~x["both"] & F.coalesce(operator.isin(*signs), F.lit(False))
        low = F.when(ranged, pt_number(x["low"])).when(single & ~of("max", "<", "<="), x["value"])
        high = F.when(ranged, pt_number(x["high"])).when(single & ~of("min", ">", ">="), x["value"])
        return F.struct(operator.alias("operador"), low.alias("minimo"), high.alias("maximo"), x["unit"].alias("unidade"))

    if not texts:
        return df
    # a blank text has no parts: it is null from here on
    cells = F.array(*(F.struct(t.cast("string").alias("cell"), F.lit(n in both).alias("both")) for n, t in texts.items()))
    staged = _staged(
        cells, {"cell": None, "both": None},
        {"whole": lambda x: collapse(F.coalesce(x["cell"], F.lit(""))), "cell": None},
        {"text": lambda x: F.when(~F.upper(x["whole"]).isin(MEASURE_MARKERS), x["whole"]), "whole": None},
        {"found": lambda x: F.regexp_extract(x["text"], UNIT, 0)},
        {"unit": lambda x: blank_to_null(x["found"]), "found": None},
        {"bare": lambda x: _without_unit(x["text"], x["unit"]), "text": None},
        {"word": lambda x: F.when(F.rlike(x["bare"], F.lit("(?i)^m")), fold(x["bare"])), "mark": lambda x: F.regexp_extract(x["bare"], SIGN, 1)},
        {"sign": lambda x: F.coalesce(named(x["word"]), blank_to_null(x["mark"])), "word": None, "mark": None},
        {"rest": lambda x: F.when(x["sign"].isNotNull(), F.regexp_replace(x["bare"], PREFIX, "")).otherwise(x["bare"]), "bare": None},
        {"low": lambda x: F.regexp_extract(x["rest"], RANGE, 1), "high": lambda x: F.regexp_extract(x["rest"], RANGE, 2), "number": lambda x: F.regexp_extract(x["rest"], SINGLE, 2)},
        {"value": lambda x: pt_number(blank_to_null(x["number"])), "before": lambda x: F.when((x["low"] == "") & x["sign"].isNull() & (x["number"] != ""), F.regexp_extract(x["rest"], SINGLE, 1))},
        {"operator": lambda x: F.coalesce(x["sign"], blank_to_null(x["before"])), "sign": None, "before": None, "rest": None},
    )
    parsed = df.withColumn("__medidas", F.transform(staged, measure))
    return parsed.select(*df.columns, *(F.col("__medidas")[i].alias(n) for i, n in enumerate(texts)))


def parse_results(df: DataFrame, texts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``df`` with a struct(valor, qualificador, unidade) of each (result cell, unit column beside it).

    The sign of a value and the whole exponent of ``x 10 n`` count.
    """
    if not texts:
        return df
    blank_to_null = lambda x: F.when(x != "", x)
    # an empty text is no number: casting it would raise and catch an exception for each row
    value = lambda x: pt_number(blank_to_null(x["number"])) * F.pow(F.lit(10.0), F.coalesce(blank_to_null(x["power"]).try_cast("int"), F.lit(0)))
    cells = F.array(*(F.struct(t.cast("string").alias("cell"), beside.cast("string").alias("beside")) for t, beside in texts.values()))
    staged = _staged(
        cells, {"cell": None, "beside": None},
        {"whole": lambda x: collapse(F.coalesce(x["cell"], F.lit(""))), "cell": None},
        {"blank": lambda x: F.upper(x["whole"]).isin(MEASURE_MARKERS)},
        {"text": lambda x: F.when(~x["blank"], x["whole"]), "whole": None},
        {"number": lambda x: F.regexp_extract(x["text"], RESULT, 2), "power": lambda x: F.regexp_extract(x["text"], RESULT, 3), "first": lambda x: F.regexp_extract(x["text"], r"^\s*([<>])", 1), "found": lambda x: F.regexp_extract(x["text"], UNIT, 0)},
        {"mark": lambda x: F.coalesce(blank_to_null(x["first"]), blank_to_null(F.regexp_extract(x["text"], RESULT, 1))), "unit": lambda x: F.when(x["blank"], x["beside"]).when(x["found"] != "", x["found"]).otherwise(known_unit(x["beside"]))},
    )
    parsed = df.withColumn("__medidas", F.transform(staged, lambda x: F.struct(value(x).alias("valor"), x["mark"].alias("qualificador"), x["unit"].alias("unidade"))))
    return parsed.select(*df.columns, *(F.col("__medidas")[i].alias(n) for i, n in enumerate(texts)))


def is_complex_note(x: Column) -> Column:
    """A normative note that ties several limits to pH; it is no single measure."""
    f = fold(x)
    return f.contains("para ph") & (F.regexp_count(f, F.lit(r"\d+(?:[,.]\d+)?\s*mg/l")) > 1)
