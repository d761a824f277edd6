"""Contract checks: every row's errors as one array of conditions, exploded; one scan, no Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import has_loose_unit, is_complex_note, known_unit
from ..functions.text import is_blank_measure, scaled_number
from ..plans.contracts import LINEAGE, UNIT_FIELDS, Contract
from ..sources.scratch import settle

ERROR = "struct<field:string,type:string,message:string,value:string>"


def _error(field: str, kind: str, message: str, value: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("type"), F.lit(message).alias("message"), value.cast("string").alias("value"))


def _when(cond: Column, error: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), error)


def field_errors(c: Contract, get) -> list[Column]:
    """The first thing wrong with each field. ``get`` gives a field's text, null if blank."""
    out = []
    for name in c.columns:
        x, checks = get(name), []
        if name in c.required:
            kind = "int_type" if name in c.integers else "literal_error" if name in c.choices else "string_type"
            checks.append(_when(x.isNull(), _error(name, kind, "campo obrigatorio vazio", x)))
        if name in c.integers:
            fraction = F.rlike(x, F.lit(r"^[+-]?\d+\.\d*[1-9]\d*$"))
            checks.append(_when(fraction, _error(name, "int_from_float", "inteiro esperado", x)))
            checks.append(_when(~F.rlike(x, F.lit(r"^[+-]?\d+(\.0*)?$")), _error(name, "int_parsing", "inteiro esperado", x)))
        if name in c.numbers:
            checks.append(_when(x.isNotNull() & x.try_cast("double").isNull(), _error(name, "float_parsing", "numero esperado", x)))
        if name in c.scaled:
            checks.append(_when(x.isNotNull() & x.try_cast("double").isNull() & scaled_number(x).isNull(), _error(name, "value_error", "valor deve ser numerico", x)))
        if name in c.numeric_text:
            checks.append(_when(x.isNotNull() & scaled_number(x).isNull(), _error(name, "value_error", "valor deve ser numerico em formato texto", x)))
        if name in c.choices:
            checks.append(_when(~x.isin(c.choices[name]), _error(name, "literal_error", "valor fora do dominio", x)))
        if name in c.patterns:
            checks.append(_when(~F.rlike(x, F.lit(c.patterns[name])), _error(name, "string_pattern_mismatch", "formato invalido", x)))
        if checks:
            out.append(F.coalesce(*checks))
    return out


def row_error(c: Contract, get) -> Column:
    """The first failed check between fields, in order: bounds, lineage, units."""
    fail = lambda cond, text, value: _when(cond, _error("__row__", "value_error", text, value))
    none = F.lit(None).cast("string")
    checks = [fail(get(f"acm_{p}_minimo").try_cast("double") > get(f"acm_{p}_maximo").try_cast("double"), f"acm_{p}_minimo maior que acm_{p}_maximo", none) for p in c.ranges]
    if c.measures:
        for source, derived in LINEAGE.items():
            checks += [fail(get(source).isNull() & get(d).isNotNull(), f"{d} preenchido com {source} vazio", get(d)) for d in derived]
        for source, unit in UNIT_FIELDS.items():
            text, parsed = get(source), get(unit)
            shown = known_unit(text).isNotNull() | has_loose_unit(text)
            if source == "resultado":
                shown = shown | ~is_blank_measure(get("unidade"))
            exempt = is_complex_note(text) if source in ("conama", "copam_cerh") else F.lit(False)
            checks.append(fail(text.isNull() & parsed.isNotNull(), f"{unit} preenchido com campo de origem vazio", parsed))
            checks.append(fail(text.isNotNull() & ~exempt & shown & parsed.isNull(), f"{unit} vazio para texto com unidade", text))
            checks.append(fail(text.isNotNull() & ~exempt & ~shown & parsed.isNotNull(), f"{unit} preenchido sem unidade no campo de origem", text))
    return F.coalesce(F.lit(None).cast(ERROR), *checks)


#: Row numbers of a sheet begin below its header.
FIRST_ROW = 2


def sheet_rows(df: DataFrame, *order: str, name: str = "__n") -> DataFrame:
    """``df`` in order, with ``name``: each row's number in the whole sheet.

    The rows are dealt out by ranges of ``order`` and sorted within them, so that a row's number is its place in its range
    plus the sizes of the ranges before; those sizes, one a range, are all that comes to the driver.
    """
    low = (1 << 33) - 1
    dealt = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()), "sheet")
    part, before, offsets = F.shiftrightunsigned("__place", 33), 0, []
    for r in dealt.groupBy(part.alias("p")).count().orderBy("p").collect():
        offsets.append((r.p, before))
        before += r["count"]
    if not offsets:
        return dealt.withColumn(name, F.lit(None).cast("long")).drop("__place")
    first = df.sparkSession.createDataFrame(offsets, "__p long, __before long")
    numbered = dealt.withColumn("__p", part).join(F.broadcast(first), "__p")
    return numbered.withColumn(name, F.col("__before") + F.col("__place").bitwiseAND(F.lit(low)) + FIRST_ROW).drop("__p", "__before", "__place")


def validate(df: DataFrame, contract: Contract, sheet: str, row_number: str | None = None, parameter: str | None = None) -> DataFrame:
    """sheet, row_number, nome_do_arquivo, id_amostra, parameter, field, type, message, value: one row an error.

    Missing columns are errors and end the check; columns too many are errors, and it goes on. ``row_number`` names a
    column that orders the rows; without it the number is null. Errors of fields suppress the check between fields.
    """
    missing = [c for c in contract.columns if c not in df.columns]
    extra = [c for c in df.columns if c not in contract.columns and c != row_number]
    spark = df.sparkSession
    schema = "sheet string, row_number long, nome_do_arquivo string, id_amostra string, parameter string, field string, type string, message string, value string"
    of_columns = spark.createDataFrame([(sheet, None, None, None, None, c, kind, text, None) for cs, kind, text in ((missing, "missing_column", "coluna obrigatoria ausente"), (extra, "extra_column", "coluna nao prevista")) for c in cs], schema)
    if missing:
        return of_columns
    get = lambda name: F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))
    fields = F.array_compact(F.array(*field_errors(contract, get)))
    row = row_error(contract, get)
    found = df.withColumn("__e", fields).withColumn("__e", F.when(F.size("__e") > 0, F.col("__e")).otherwise(F.array_compact(F.array(row))))
    number = F.col(row_number).cast("long") if row_number else F.lit(None).cast("long")
    optional = lambda c: F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
    errors = found.select(number.alias("row_number"), optional("nome_do_arquivo"), optional("id_amostra"), (F.col(parameter) if parameter else F.lit(None)).cast("string").alias("parameter"), F.explode("__e").alias("e"))
    return errors.select(F.lit(sheet).alias("sheet"), "row_number", "nome_do_arquivo", "id_amostra", "parameter", "e.field", "e.type", "e.message", "e.value").unionByName(of_columns)


def validate_all(tables: dict[str, tuple[DataFrame, Contract]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [validate(df, c, name, parameter="parameter" if "parameter" in df.columns else None) for name, (df, c) in tables.items()])
