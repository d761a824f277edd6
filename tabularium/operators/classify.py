"""Rule-driven classification of documents against templates.

The rules are configuration: they are folded into the plan as literal patterns, so that one scan of the texts scores
all templates without a join or a shuffle, and every pattern is compiled once a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import java_pattern, literal_text, literals


@dataclass(frozen=True)
class Template:
    template_id: str
    score_minimo: float = 80.0
    prioridade: int = 999
    theme_id: str | None = None
    id_taxonomia: int | None = None
    nome_taxonomia: str | None = None
    versao_template: int | None = None


@dataclass(frozen=True)
class DetectionRule:
    template_id: str
    rule_type: str  # required, positive or negative
    regex: str
    peso: float = 0.0
    descricao: str | None = None
    source: str = "text"  # text, path or file_name

    @property
    def label(self) -> str:
        return self.descricao or self.regex


def haystack(source: str, text: Column, path: Column) -> Column:
    if source == "text":
        return text
    return path if source == "path" else F.element_at(F.split(path, "/"), -1)


def _first(labels: list[tuple[Column, str]]) -> Column:
    """Label of the first condition that holds, else null."""
    return F.coalesce(F.lit(None).cast("string"), *(F.when(c, F.lit(name)) for c, name in labels))


def template_score(template: Template, rules: list[DetectionRule], hits: list[Column]) -> Column:
    """struct(template_id, score, score_minimo, prioridade, status, matched) from ``hits``, one boolean for each rule."""
    own = [(r, hit) for r, hit in zip(rules, hits) if r.template_id == template.template_id]
    of = lambda kind: [(r, hit) for r, hit in own if r.rule_type == kind]
    none = F.array().cast("array<string>")
    missing = _first([(~hit, r.label) for r, hit in of("required")])
    negative = _first([(hit, r.label) for r, hit in of("negative")])
    total = reduce(Column.__add__, [F.when(hit, F.lit(float(r.peso))).otherwise(F.lit(0.0)) for r, hit in of("positive")], F.lit(0.0))
    # required rules count as matched up to the first that misses
    before, sofar = [], F.lit(True)
    for r, hit in of("required"):
        sofar = sofar & hit
        before.append(F.when(sofar, F.lit(f"required:{r.label}")))
    matched = F.array_compact(F.array(*before)) if before else none
    positives = [F.when(hit, F.lit(f"positive:{r.label}")) for r, hit in of("positive")]
    positives = F.array_compact(F.array(*positives)) if positives else none
    matched = F.when(missing.isNotNull(), matched).when(negative.isNotNull(), F.concat(matched, F.array(F.concat(F.lit("negative:"), negative)))).otherwise(F.concat(matched, positives))
    score = F.when(missing.isNull() & negative.isNull(), total).otherwise(F.lit(0.0))
    status = (
        F.when(missing.isNotNull(), F.concat(F.lit("required_missing:"), missing))
        .when(negative.isNotNull(), F.concat(F.lit("negative_matched:"), negative))
        .when(total < F.lit(float(template.score_minimo or 0)), F.lit("below_minimum"))
        .otherwise(F.lit("candidate"))
    )
    return F.struct(
        F.lit(template.template_id).alias("template_id"), score.alias("score"), F.lit(float(template.score_minimo or 0)).alias("score_minimo"), F.lit(int(template.prioridade or 999)).alias("prioridade"), status.alias("status"), matched.alias("matched")
    )


#: Rules whose outcomes share a column, one bit each.
BITS = 62


def prefiltered(r: DetectionRule, body: Column, plain: Column, where: Column) -> Column:
    """Whether a rule's pattern is met; it is tried only on texts that hold one of the literals that it cannot do without."""
    hit = F.coalesce(F.rlike(haystack(r.source, body, where), F.lit(java_pattern(r.regex))), F.lit(False))
    needed = literals(r.regex) if r.source == "text" else None
    if not needed:
        return hit
    return F.when(reduce(Column.__or__, (F.contains(plain, F.lit(x)) for x in needed)), hit).otherwise(F.lit(False))


def classify(docs: DataFrame, templates: list[Template], rules: list[DetectionRule], text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``scores`` (one struct a template, the winner marked) and ``template_id`` (null: out of scope).

    Every rule's pattern stands once in the plan: outcomes are bits of a few long values that a generator of one row gives,
    for what a generator gives is neither repeated where it is used nor moved below it with a filter. Patterns meet only
    texts with one of their literals.
    """
    where = F.coalesce(F.col(path), F.lit("")) if path else F.lit("")
    body = F.coalesce(F.col(text), F.lit(""))
    masks = {}
    for at in range(0, len(rules), BITS):
        own = rules[at : at + BITS]
        bits = [F.when(prefiltered(r, body, F.col("__plain"), where), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, r in enumerate(own)]
        masks[f"h{at // BITS}"] = reduce(Column.bitwiseOR, bits)
    found = docs.withColumn("__plain", literal_text(body)).select("*", F.explode_outer(F.array(F.struct(*(m.alias(n) for n, m in masks.items())))).alias("__hits")).drop("__plain") if masks else docs
    hits = [F.getbit(F.col(f"__hits.h{i // BITS}"), F.lit(i % BITS)) == 1 for i in range(len(rules))]
    scored = found.withColumn("__scores", F.array(*(template_score(t, rules, hits) for t in templates))).drop("__hits")
    candidates = F.filter("__scores", lambda s: s["status"] == "candidate")
    best = F.array_max(F.transform(candidates, lambda s: F.struct(s["score"], (-s["prioridade"]).alias("p"), s["template_id"])))
    won = scored.withColumn("template_id", best["template_id"])
    mark = lambda s: s.withField("status", F.when((s["status"] == "candidate") & (s["template_id"] == F.col("template_id")), F.lit("winner")).otherwise(s["status"]))
    return won.withColumn("scores", F.transform("__scores", mark)).drop("__scores")


def classification_audit(classified: DataFrame, *keys: str) -> DataFrame:
    """One row for each document and template, rejected documents included."""
    # an outer generator: for the other kind the optimizer adds a filter that repeats all of ``scores``
    rows = classified.select(*keys, F.explode_outer("scores").alias("s")).where("s.template_id is not null")
    return rows.select(*keys, "s.template_id", "s.score", "s.score_minimo", "s.prioridade", "s.status", F.array_join("s.matched", "; ").alias("regras"))


def classification_summary(classified: DataFrame, *keys: str) -> DataFrame:
    """One row for each document: identificado or fora_escopo, and its scores as text."""
    written = F.array_join(F.transform("scores", lambda s: F.concat(s["template_id"], F.lit(":"), s["status"], F.lit(":"), s["score"].cast("int").cast("string"), F.lit("/"), s["score_minimo"].cast("int").cast("string"))), "; ")
    return classified.select(*keys, "template_id", F.when(F.col("template_id").isNull(), "fora_escopo").otherwise("identificado").alias("status"), written.alias("scores"))


def winners(classified: DataFrame, templates: list[Template]) -> DataFrame:
    """Documents in scope, with what their template says of the taxonomy."""
    pick = lambda field, kind: F.coalesce(F.lit(None).cast(kind), *(F.when(F.col("template_id") == t.template_id, F.lit(getattr(t, field))) for t in templates)).cast(kind)
    return classified.where("template_id is not null").withColumns({"theme_id": pick("theme_id", "string"), "id_taxonomia": pick("id_taxonomia", "long"), "nome_taxonomia": pick("nome_taxonomia", "string"), "versao_template": pick("versao_template", "long")})


def preclassified(pages: DataFrame, templates: list[Template], rules: list[DetectionRule], first_pages: int = 3) -> DataFrame:
    """Pages of the documents to read in full: those whose first pages name a template, or are blank.

    The page filter reaches the scan; only the previews are grouped.
    """
    preview = pages.where(F.col("page_no") <= first_pages) if first_pages else pages
    texts = preview.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))), lambda p: p["text"]), "\n").alias("text"))
    kept = classify(texts, templates, rules).where(F.col("template_id").isNotNull() | (F.trim("text") == "")).select("doc_id")
    return pages.join(kept, "doc_id", "left_semi")
