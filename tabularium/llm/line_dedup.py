"""Line dedup by a log-template tree of fixed depth, DataFrame functions only.

A line's tokens are its runs of non-space; tokens with a digit become fields, ``<*>`` (a line of fields alone keeps its
tokens as they are, so that different rows of numbers stay different). The number of tokens and the first DEPTH tokens
lead to a leaf of the tree. Within a leaf a token is constant at its place when MIN_DOCS different texts have it there;
all other tokens are fields. The constants of a line, with their places, are its template, if they make up SIMILAR of
its tokens; any other line stands for itself. So a leaf has as many templates as it needs. A template that MIN_DOCS
different texts have recurs, and all its lines are dropped in all documents; short lines are treated like any other.

Every count is of different texts: copies of a text count once, in the votes too, and so does a text that repeats a
line. Lines are parsed once and written with their leaves; leaves in too few texts are left out before any token is
looked at. That test and the choice of documents to rewrite use Bloom filters of bounded size, so that texts are not
shuffled unless they lose a line. Joins split hot keys (``lookup``). Keys are 64-bit hashes.

Defined results: a null text counts as empty and stays null; blank lines stay. Repeated rows lose the same lines. There
are no ties: a line's template does not depend on any order. A line without spaces is one token. An empty table gives an
empty result. Other columns are kept, but for columns named n_lines and n_dropped, which the operator's own replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CountFilter, bloom_filter, bloom_probe, bloom_words, clean_text, lookup, stash, unstash

DEPTH = 2
SIMILAR = 0.7
MIN_DOCS = 3
WHITE = r"\x09-\x0d\x20"
FIELD = "<*>"
#: Lines with a digit, or white space other than single spaces between tokens.
UNEVEN = r"[0-9\x09\x0b-\x0d]|\x20\x20|^\x20|\x20$"
#: From the start of a token, so that a long run is looked at once.
WITH_DIGIT = rf"(?<![^{WHITE}])[^{WHITE}0-9]*+[0-9][^{WHITE}]*+"


def form(line: Column) -> Column:
    """The line's tokens, variable fields masked, between single spaces."""
    even = F.trim(F.regexp_replace(line, f"[{WHITE}]+", " "))
    masked = F.regexp_replace(even, WITH_DIGIT, FIELD)
    constant = F.trim(F.replace(masked, F.lit(FIELD), F.lit(""))) != ""
    return F.when(F.rlike(line, F.lit(UNEVEN)), F.when(constant, masked).otherwise(even)).otherwise(line)


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that are not blank: doc_id, dh (of the text), pos, form, lh (of the form), leaf."""
    exploded = docs.select("doc_id", F.xxhash64(clean_text()).alias("dh"), F.posexplode(F.split(clean_text(), "\n")).alias("pos", "line"))
    formed = exploded.where("line <> ''").select("doc_id", "dh", "pos", form(F.col("line")).alias("form")).where("form <> ''")
    size = F.octet_length("form") - F.octet_length(F.replace("form", F.lit(" "), F.lit("")))
    return formed.select("*", F.xxhash64("form").alias("lh"), F.xxhash64(size, F.substring_index("form", " ", DEPTH)).alias("leaf"))


def _owners(near: DataFrame, min_docs: int) -> DataFrame:
    """(lh, own): texts that have a form, ``min_docs`` of them where there are more; only so many leave a map task."""
    seen = near.select("lh", "dh").distinct()
    first = seen.withColumn("n", F.row_number().over(Window.partitionBy("lh").orderBy("dh"))).where(F.col("n") <= min_docs)
    return first.groupBy("lh").agg(F.collect_list("dh").alias("own"))


def _recurring(rows: DataFrame, key: str, min_docs: int) -> DataFrame:
    """(key, uses) of the keys that ``min_docs`` different texts in ``own`` have; ``uses`` is how many rows have it."""
    texts = rows.select(key, F.posexplode("own").alias("i", "dh"))
    uses = F.count(F.when(F.col("i") == 0, 1)).alias("uses")
    return texts.groupBy(key).agg(uses, F.count_distinct("dh").alias("texts")).where(F.col("texts") >= min_docs).select(key, "uses")


def _named(forms: DataFrame, min_docs: int, similar: float) -> DataFrame:
    """(lh, name, own): the template of each form (lh, leaf, form, own), or its own hash where it has none."""
    tokens = forms.select("lh", "own", "leaf", F.posexplode(F.split("form", " ")).alias("place", "token")).where(F.col("token") != FIELD)
    placed = tokens.select("lh", "own", F.xxhash64("leaf", "place", "token").alias("key"))
    # most tokens of most lines are met too seldom to be constant: those never leave their task
    met = CountFilter(placed.select("key", F.explode("own")), "key", min_docs)
    often = met.probe(placed, "key").where("__tb_maybe").select("lh", "own", "key")
    frequent = stash(_recurring(often, "key", min_docs), "constants")
    made = lookup(often.select("lh", "key"), frequent, "key", "uses", met.rows).where("uses is not null").groupBy("lh").agg(F.count("*").alias("k"), F.bit_xor("key").alias("x"))
    template = F.when(F.col("k") >= F.size(F.split("form", " ")) * similar, F.xxhash64(F.lit("template"), "x"))
    return forms.join(made, "lh", "left").select("lh", F.coalesce(template, F.col("lh")).alias("name"), "own")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, dh, pos) of the lines whose template recurs."""
    lines = stash(_lines(docs), "lines")
    often = lines.select("leaf", "dh").distinct().groupBy("leaf").count().where(F.col("count") >= min_docs)
    often = stash(often.select(F.xxhash64("leaf").alias("__tb_x")), "leaves")
    words = bloom_words(often.count())
    bloom = stash(bloom_filter(often, "__tb_x", words), "bloom")
    near = stash(bloom_probe(lines, bloom, F.xxhash64("leaf"), words, "__tb_maybe").where("__tb_maybe").select(*lines.columns), "near")
    unstash(lines)
    total = near.count()
    forms = stash(near.select("lh", "leaf", "form").distinct().join(_owners(near, min_docs), "lh"), "forms")
    named = stash(_named(forms, min_docs, similar), "named")
    unstash(forms)
    gone = lookup(named, _recurring(named, "name", min_docs), "name", "uses", total).where("uses is not null").select("lh")
    sizes = near.groupBy("lh").agg(F.count("*").alias("lines"))
    return lookup(near.select("doc_id", "dh", "pos", "lh"), gone.join(sizes, "lh"), "lh", "lines", total).where("lines is not null").select("doc_id", "dh", "pos")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with recurring lines taken out of text, and n_lines and n_dropped added; other columns are kept."""
    lost = dropped_lines(docs.select("doc_id", "text"), min_docs, similar)
    lost = stash(lost.groupBy(F.col("doc_id").alias("__tb_id"), F.col("dh").alias("__tb_dh")).agg(F.collect_set("pos").alias("__tb_lost")), "lost")
    words = bloom_words(lost.count())
    bloom = stash(bloom_filter(lost.select(F.xxhash64("__tb_id", "__tb_dh").alias("__tb_x")), "__tb_x", words), "bloom")
    keyed = docs.withColumn("__tb_key", F.xxhash64(clean_text()))
    probed = bloom_probe(keyed, bloom, F.xxhash64("doc_id", "__tb_key"), words, "__tb_maybe")
    own = {"text", "n_lines", "n_dropped"}
    columns = [c for c in docs.columns if c.lower() not in own]
    lines = F.split("text", "\n")
    n_lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(1)).cast("long").alias("n_lines")
    whole = probed.where(~F.col("__tb_maybe")).select(*columns, "text", n_lines, F.lit(0).cast("long").alias("n_dropped"))
    some = probed.where("__tb_maybe").join(lost, F.col("doc_id").eqNullSafe(F.col("__tb_id")) & (F.col("__tb_key") == F.col("__tb_dh")), "left")
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("__tb_lost", i)), "\n")
    n = F.coalesce(F.size("__tb_lost"), F.lit(0))
    cut = some.select(*columns, F.when(F.col("__tb_lost").isNotNull(), left).otherwise(F.col("text")).alias("text"), n_lines, F.when(n > 0, n).otherwise(0).cast("long").alias("n_dropped"))
    return whole.unionByName(cut)
