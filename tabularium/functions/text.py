"""Text helpers as Column expressions: folding, collapsing, blanks, cells and numbers written the Portuguese way."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers of an empty configuration cell and of a measure that is not there.
CONFIG_MARKERS = ["na", "nan", "none", "nao_aplicavel", "nao_se_aplica", "nao_aplica"]
MEASURE_MARKERS = ["", "NA", "ND", "N/A", "NAN"]
TRUE_WORDS = ["true", "verdadeiro", "sim", "yes", "1"]
FALSE_WORDS = ["false", "falso", "nao", "não", "no", "0"]


@cache
def fold_tables() -> tuple[str, str]:
    """Letters of the Latin blocks with a decomposition, and their base letters."""
    pairs = []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def fold(x: Column, sharp: bool = True) -> Column:
    """Without accents, in lower case, white space collapsed; null gives the empty text. Without ``sharp`` an ß stays one."""
    source, base = fold_tables()
    text = F.coalesce(x, F.lit(""))
    plain = F.regexp_replace(F.translate(text, source, base), r"\p{Mn}+", "")
    full = F.lower(collapse(plain))
    full = F.replace(full, F.lit("ß"), F.lit("ss")) if sharp else full
    # ASCII has no accents: the letters need not be looked up one by one
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(collapse(text))).otherwise(full)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are worked out once a row: unlike a projection's, a generator's are not copied into the filters that follow."""
    made = df.withColumn("__once", F.explode(F.array(F.struct(*(value.alias(name) for name, value in columns.items())))))
    return made.withColumns({name: F.col("__once")[name] for name in columns}).drop("__once")


def token(x: Column) -> Column:
    """An identifier: folded, everything but letters and digits turned to single underscores."""
    return F.regexp_replace(F.regexp_replace(fold(x), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def nonblank(x: Column) -> Column:
    """Collapsed text, null if nothing is left."""
    return F.nullif(collapse(x), F.lit(""))


def clean(x: Column, limit: int) -> Column:
    return nonblank(x).substr(1, limit)


def cell(row: Column, index: Column) -> Column:
    """Cell at a 0-based index; null outside the row."""
    return nonblank(F.when(index.isNotNull(), F.try_element_at(row, (index + 1).cast("int"))))


def is_config_marker(x: Column) -> Column:
    return x.isNull() | (F.trim(x) == "") | token(x).isin(CONFIG_MARKERS)


def is_blank_measure(x: Column) -> Column:
    return F.upper(collapse(F.coalesce(x, F.lit("")))).isin(MEASURE_MARKERS)


def boolean(x: Column, default: bool) -> Column:
    word = F.lower(F.trim(x))
    return F.when(word.isNull() | (word == ""), F.lit(default)).when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False)).otherwise(F.lit(True))


def pt_number(x: Column) -> Column:
    """With a comma, dots are thousands; else the text is taken as it is. Invalid text is null."""
    t = F.trim(x)
    dotted = F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(t.contains(","), dotted).otherwise(t).try_cast("double")


def strict_decimal(x: Column) -> Column:
    """A coordinate as reports write it: with a comma, dots are thousands and go; anything but a number is null."""
    t = F.trim(x)
    return F.when(F.rlike(t, F.lit(r"^[+-]?[\d.]*,?\d+$")), pt_number(t))


def scaled_number(x: Column) -> Column:
    """A number that may be followed by ``x 10 n``; null if the text is anything else."""
    pattern = r"(?i)^([+-]?\d+(?:[,.]\d+)?)(?:\s*x\s*10\s*([+-]?\d+))?$"
    t = F.trim(x)
    number = F.replace(F.regexp_extract(t, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")
    power = F.regexp_extract(t, pattern, 2).try_cast("int")
    return F.when(F.rlike(t, F.lit(pattern)), number * F.pow(F.lit(10.0), F.coalesce(power, F.lit(0))))


def text_hash(text: Column) -> Column:
    return F.sha2(F.lower(collapse(F.coalesce(text, F.lit("")))), 256)

