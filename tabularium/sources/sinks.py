"""Sinks: tables as Parquet, CSV or JSON, and one JSON line a document with decimals as they were written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_PLACES = 12
NUMBER = r"[+-]?\d+(?:[.,]\d+)*"


def datetime_text(x: Column) -> Column:
    """dd/MM/yyyy HH:mm:ss of a date in any form that is known; any other text as it is."""
    from ..operators.reconcile import parse_date

    return F.coalesce(F.date_format(parse_date(x), "dd/MM/yyyy HH:mm:ss"), x.cast("string"))


def decimals(source: Column, index: int) -> Column:
    """Decimal places of the i-th number of a text, the last one's if there are fewer; an exponent belongs to its number."""
    bare = F.regexp_replace(source, r"(?i)\s*x\s*10\s*[+-]?\d+", "")
    numbers = F.regexp_extract_all(bare, F.lit(f"({NUMBER})"), 1)
    number = lambda n: F.try_element_at(n, F.least(F.lit(index + 1), F.size(n)))
    return F.transform(F.array(numbers), lambda n: F.when(F.size(n) > 0, F.char_length(F.regexp_extract(number(n), r"[,.](\d+)$", 1))))[0]


def scaled(value: Column, source: Column, index: int = 0) -> Column:
    """A JSON number token with the source's decimal places, half to even."""
    exact = lambda v: v.cast("string").cast("decimal(38,18)")  # noqa: E731  # of the shortest text of the number

    def token(x: Column) -> Column:
        text = F.when(F.lit(False), F.lit(""))
        for p in range(MOST_PLACES + 1):
            text = text.when(x["p"] == p, F.bround(x["e"], p).cast(f"decimal(38,{p})").cast("string"))
        return text.otherwise(x["v"])

    # the places are counted once for a value, not once for each number of places that is tried
    facts = F.struct(decimals(source, index).alias("p"), exact(value).alias("e"), value.cast("string").alias("v"))
    return F.when(value.isNotNull(), F.transform(F.array(facts), token)[0])


def json_pair(name: str, value: Column, token: bool = False) -> Column:
    """``"name":value``; a token is written as it is, anything else by ``to_json``. Null gives null."""
    plain = F.regexp_replace(F.to_json(F.struct(value.alias("v"))), r'^\{"v":|\}$', "")
    return F.concat(F.lit(f'"{name}":'), F.coalesce(value if token else F.when(value.isNotNull(), plain), F.lit("null")))


def json_records(df: DataFrame, key: str, tokens: dict[str, Column] | None = None, order: list[str] | None = None) -> DataFrame:
    """key -> JSON array of the rows of each document, in order."""
    tokens = tokens or {}
    pairs = [json_pair(c, tokens.get(c, F.col(c)), c in tokens) for c in df.columns if c != key]
    row = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    place = F.struct(*(F.col(c) for c in order)) if order else row
    rows = F.transform(F.array_sort(F.collect_list(F.struct("o", "r"))), lambda x: x["r"])
    # the rows are written out before they are dealt, as columns: within the aggregate each would be interpreted
    made = df.select(key, place.alias("o"), row.alias("r")).repartition(F.col(key))
    return made.groupBy(key).agg(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")).alias("json"))


def jsonl(tables: dict[str, DataFrame], key: str = "nome_do_arquivo", tokens: dict[str, dict[str, Column]] | None = None, order: dict[str, list[str]] | None = None) -> DataFrame:
    """key, value: {"arquivo": {...}, "tabelas": {name: [rows]}}, a document a line; tables without its rows are empty."""
    parts = [json_records(df, key, (tokens or {}).get(n), (order or {}).get(n)).withColumnRenamed("json", f"__{n}") for n, df in tables.items()]
    wide = reduce(lambda a, b: a.join(b, key, "full_outer"), parts)
    body = F.concat_ws(",", *(F.concat(F.lit(f'"{n}":'), F.coalesce(F.col(f"__{n}"), F.lit("[]"))) for n in tables))
    return wide.select(key, F.concat(F.lit('{"arquivo":{'), json_pair(key, F.col(key)), F.lit('},"tabelas":{'), body, F.lit("}}")).alias("value"))


# Columns that are dates, integers and plain decimals in every output.
DATES = ["acm_data_hora_extracao", "acm_data_inicio", "data_inicio", "data_coleta", "data_publicacao", "data_recebimento"]
INTEGERS = ["id_taxonomia", "versao_template", "id_amostra", "pagina"]
DECIMALS = ["latitude", "longitude", "latitude_real", "longitude_real"]


def source_of(column: str) -> tuple[str, int] | None:
    """The column whose text gives a derived number its decimal places, and which of the text's numbers it is."""
    if column == "acm_resultado_tratado":
        return "resultado", 0
    for end, index in (("_minimo", 0), ("_maximo", 1), ("_valor", 0)):
        if column.startswith("acm_") and column.endswith(end):
            return column.removeprefix("acm_").removesuffix(end), index
    return None


def typed(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with canonical dates, and the number tokens of its integers, decimals and derived numbers.

    Text that is no number is written as text.
    """
    out, tokens = df.withColumns({c: datetime_text(F.col(c)) for c in DATES if c in df.columns}), {}
    quoted = lambda x: F.regexp_replace(F.to_json(F.struct(x.alias("v"))), r'^\{"v":|\}$', "")
    for c in df.columns:
        text = F.trim(F.col(c).cast("string"))
        if c in INTEGERS:
            tokens[c] = F.when(F.rlike(text, F.lit(r"^-?\d{1,18}(\.0*)?$")), text.try_cast("decimal(20,2)").cast("long").cast("string")).otherwise(F.when(text.isNotNull(), quoted(F.col(c))))
        elif c in DECIMALS:
            tokens[c] = F.coalesce(text.try_cast("double").cast("string"), F.when(text.isNotNull(), quoted(F.col(c))))
        elif (source := source_of(c)) and source[0] in df.columns:
            tokens[c] = F.coalesce(scaled(F.col(c).try_cast("double"), F.col(source[0]), source[1]), text.try_cast("double").cast("string"))
    return out, tokens


def unfiled(tables: dict[str, DataFrame], key: str) -> dict[str, DataFrame]:
    """Rows without a document go to every document; such rows speak of a whole batch and are few (MOST_UNFILED)."""
    named = [df.select(key) for df in tables.values() if key in df.columns]
    names = reduce(DataFrame.union, named).where(F.col(key).isNotNull()).distinct()
    out = {}
    for n, df in tables.items():
        own = df if key in df.columns else df.withColumn(key, F.lit(None).cast("string"))
        filed = own.where(F.col(key).isNotNull())
        rows = own.where(F.col(key).isNull()).limit(MOST_UNFILED + 1).collect()
        if len(rows) > MOST_UNFILED:
            raise ValueError(f"{n}: more than {MOST_UNFILED} rows without {key}")
        if rows:
            fields = [f for f in own.schema if f.name != key]
            each = F.array(*(F.struct(*(F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields)) for r in rows))
            filed = filed.unionByName(names.select(key, F.explode(each).alias("r")).select(key, "r.*"))
        out[n] = filed
    return out


#: Rows of a table that may lack a document when JSON lines are written.
MOST_UNFILED = 1000


def save(tables: dict[str, DataFrame], path: str, kind: str, timestamp: str, mode: str = "errorifexists", order: dict[str, list[str]] | None = None) -> None:
    """Stamp every table and write it; ``jsonl`` writes one line a document, by file name; ``xlsx`` one workbook.

    CSV and JSON have a folder for each table; validation errors get theirs only if there are some.
    """
    stamped = {n: df.withColumn("acm_data_hora_extracao", F.lit(timestamp)) for n, df in tables.items()}
    if kind == "jsonl":
        made = {n: typed(df) for n, df in unfiled(stamped, "nome_do_arquivo").items()}
        lines = jsonl({n: df for n, (df, _) in made.items()}, tokens={n: t for n, (_, t) in made.items()}, order=order)
        lines.orderBy("nome_do_arquivo").select("value").write.mode(mode).text(path)
        return
    if kind == "xlsx":
        from .workbook import write_workbook

        return write_workbook(stamped, path)
    for name, df in stamped.items():
        if name == "validation_errors" and df.isEmpty():
            continue
        writer = df.write.mode(mode)
        (writer.option("header", "true") if kind == "csv" else writer).format(kind).save(f"{path.rstrip('/')}/{name}")
