"""The rule tables: loading, checking and compiling them into what the operators take.

Rules are configuration of a few thousand rows at most (checked: ``MOST_RULES``); they are read with declared schemas,
checked with joins, and collected once to the driver, where they become literal patterns of the plans.
"""

from __future__ import annotations

import os
import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import faults
from ..functions.text import FALSE_WORDS, TRUE_WORDS, is_config_marker, token
from ..operators.classify import DetectionRule, Template
from ..operators.packaging import PackagingRules
from ..operators.rows import RuleSet, SectionRule
from .contracts import LAYOUT_FIELDS, RESULTS, TABLES

MOST_RULES = 100_000

# The five tables and the groups that a rule can be of.
SCHEMAS = {
    "item_taxonomia": "id int, id_taxonomia int, nome string",
    "template": "id int, id_item_taxonomia int, regex string, ativo string, versao_template string, template_id string, theme_id string, nome string, prioridade int, score_minimo double",
    "item_template": "id int, id_template int, schema string, campo string, regex string, coluna_origem string, tipo_registro string",
    "schema": "id int, id_item_taxonomia int, nome string, is_serial string",
    "item_schema": "id int, id_schema int, schema string, campo string, tipo string, nulo string",
}
FOREIGN_KEYS = [
    ("template", "id_item_taxonomia", "item_taxonomia"), ("item_template", "id_template", "template"), ("schema", "id_item_taxonomia", "item_taxonomia"), ("item_schema", "id_schema", "schema"),
]
RULE_TYPES = ["required", "positive", "negative"]
CONFIG_ONLY = ["template_detection", "template_required", "template_positive", "template_negative", "layout", "header_alias", "continuation", "category_alias", "subcategory_alias", "category_type", "metadata", "section_discovery_ignore"]
RECORD_TYPES = {"amostra": "AMOSTRA", "branco": "BRANCO", "duplicata": "DUPLICATA", "recuperacao": "RECUPERACAO"}


class TaxonomyError(ValueError):
    pass


def resolve(base: str, variable: str = "TAXONOMY_FILE", default: str = "config/taxonomy") -> str:
    """The variable's path if set, else the default. A bare name lies in the default's folder, a relative path under ``base``."""
    own = os.environ.get(variable) or default
    if own == os.path.basename(own):
        own = os.path.join(os.path.dirname(default), own)
    return os.path.join(base, own)


def load(spark: SparkSession, path: str, kind: str = "json") -> dict[str, DataFrame]:
    """The five tables under ``path`` (json, csv or parquet), schemas declared."""
    reader = lambda name: spark.read.schema(SCHEMAS[name]) if kind != "parquet" else spark.read
    found = {}
    for name in SCHEMAS:
        r = reader(name).option("header", "true") if kind == "csv" else reader(name)
        found[name] = r.format(kind).load(f"{path.rstrip('/')}/{name}.{kind}")
    return found


def attributes(text: str | None) -> dict[str, str]:
    """``a=1; b=2`` -> {"a": "1", "b": "2"}; keys in lower case."""
    pairs = (p.split("=", 1) for p in (text or "").split(";") if "=" in p)
    return {k.strip().lower(): v.strip() for k, v in pairs if k.strip()}


def weight(text: object, default: float = 0.0) -> float:
    found = re.search(r"-?\d+(?:[.,]\d+)?", str(text or ""))
    return float(found.group(0).replace(",", ".")) if found else default


def fold_text(text: str) -> str:
    """Without accents, in lower case, white space collapsed; of a rule, on the driver."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(plain.split()).casefold()


def record_type(text: str | None) -> str | None:
    if not (text or "").strip():
        return None
    return RECORD_TYPES.get(re.sub(r"[^a-z]+", "", fold_text(text)), text.strip().upper())


def problems(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, tipo, valor): everything wrong with the tables' content."""
    found = []
    say = lambda df, table, kind, value: found.append(df.select(F.lit(table).alias("tabela"), F.lit(kind).alias("tipo"), value.cast("string").alias("valor")))
    for name, df in tables.items():
        say(df.groupBy("id").count().where("count > 1"), name, "id_duplicado", F.col("id"))
    for name, column, other in FOREIGN_KEYS:
        known = tables[other].select(F.col("id").alias(column))
        say(tables[name].where(F.col(column).isNotNull()).join(known, column, "left_anti"), name, f"chave_desconhecida:{column}", F.col(column))
    items, fields = tables["item_template"], tables["item_schema"]
    groups = [*CONFIG_ONLY, *TABLES]
    say(items.where(~F.col("schema").isin(groups)), "item_template", "grupo_desconhecido", F.col("schema"))
    named = fields.select("id_schema", F.col("schema").alias("given")).join(tables["schema"].select(F.col("id").alias("id_schema"), "nome"), "id_schema")
    say(named.where("given <> nome"), "item_schema", "nome_divergente", F.col("given"))
    kind = F.element_at(F.split(F.regexp_extract("coluna_origem", r"(?i)rule_type\s*=\s*([^;]+)", 1), ";"), 1)
    say(items.where((F.col("schema") == "template_detection") & ~F.trim(kind).isin(RULE_TYPES)), "item_template", "rule_type_invalido", kind)
    source = F.lower(F.trim(F.regexp_extract("coluna_origem", r"(?i)(?:^|;)\s*source\s*=\s*([^;]+)", 1)))
    say(items.where((F.col("schema") == "template_detection") & (source != "") & (source != "text")), "item_template", "source_invalido", source)
    priority = F.trim(F.regexp_extract("coluna_origem", r"(?i)(?:^|;)\s*prioridade\s*=\s*([^;]+)", 1))
    say(items.where((priority != "") & ~F.rlike(priority, F.lit(r"^[+-]?\d+$"))), "item_template", "prioridade_invalida", priority)
    if "template_id" in tables["template"].columns:
        named = F.trim("template_id")
        say(tables["template"].where(F.col("template_id").isNotNull() & named.isin("", "*")), "template", "template_id_invalido", named)
    layout = F.regexp_replace(F.trim("campo"), "_col$", "")
    say(items.where(F.col("schema").isin("layout", "header_alias") & ~layout.isin([*LAYOUT_FIELDS, "parameter"])), "item_template", "campo_de_layout_desconhecido", F.col("campo"))
    bare = [c.removeprefix("acm_") for c in RESULTS if c.startswith("acm_") and c != "acm_data_hora_extracao" and c.removeprefix("acm_") not in ("unidade", "codigo_laudo", "data_inicio")]
    say(fields.where(F.col("campo").isin(bare)), "item_schema", "sem_prefixo_acm", F.col("campo"))
    words = [*TRUE_WORDS, *FALSE_WORDS]
    for name, column in (("template", "ativo"), ("schema", "is_serial"), ("item_schema", "nulo")):
        say(tables[name].where(F.col(column).isNotNull() & ~F.lower(F.trim(column)).isin(words)), name, f"booleano_invalido:{column}", F.col(column))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def bad_patterns(spark: SparkSession, tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """(table, pattern) of the patterns that cannot be run, judged by the very strings that run (``patterns.rule``)."""
    bad = []
    for name in ("template", "item_template"):
        distinct = tables[name].select("regex").where("regex is not null").distinct().limit(MOST_RULES + 1).collect()
        if len(distinct) > MOST_RULES:
            raise TaxonomyError(f"{name}: mais de {MOST_RULES} regras")
        bad += [(name, pattern) for (pattern,) in distinct if faults(pattern)]
    return sorted(bad)


FAULTS = "tabela string, id int, schema string, campo string, regex string, erro string"


def check(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Raise TaxonomyError unless the tables have their columns, rows, and no problem."""
    for name, ddl in SCHEMAS.items():
        optional = {"versao_template", "template_id", "theme_id", "nome", "prioridade", "score_minimo"} if name == "template" else set()
        missing = {c.split()[0] for c in ddl.split(", ")} - optional - set(tables[name].columns)
        if missing:
            raise TaxonomyError(f"{name}: colunas ausentes: {', '.join(sorted(missing))}")
        if tables[name].isEmpty():
            raise TaxonomyError(f"{name}: tabela vazia")
    first = problems(tables).limit(20).collect()
    if first:
        raise TaxonomyError("; ".join(f"{r.tabela}: {r.tipo}: {r.valor}" for r in first))
    if bad := bad_patterns(spark, tables):
        raise TaxonomyError("; ".join(f"{n}: regex invalida: {p}" for n, p in bad[:20]))


def check_output_model(tables: dict[str, DataFrame]) -> None:
    """The declared columns of each output equal the engine's, order included."""
    for name, (expected) in TABLES.items():
        rows = output_fields(tables["item_schema"].where(F.col("schema") == name)).orderBy("ordem").select("campo").collect()
        declared = [r[0] for r in rows]
        if declared and declared != expected:
            missing, extra = [c for c in expected if c not in declared], [c for c in declared if c not in expected]
            raise TaxonomyError(f"{name}: ausentes {missing}, a mais {extra}" if missing or extra else f"{name}: ordem divergente")


def output_fields(items: DataFrame) -> DataFrame:
    """campo, ordem (1..n by id), obrigatorio; the first of each campo."""
    from pyspark.sql import Window

    named = items.where(F.col("campo").isNotNull()).withColumn("k", F.row_number().over(Window.partitionBy("schema", "campo").orderBy("id"))).where("k = 1")
    return named.select("schema", "campo", F.row_number().over(Window.partitionBy("schema").orderBy("id")).alias("ordem"), (~F.lower(F.trim(F.coalesce("nulo", F.lit("sim")))).isin(TRUE_WORDS)).alias("obrigatorio"))


def template_identities(tables: dict[str, DataFrame]) -> DataFrame:
    """id, template_id, theme_id and what else a template is known by.

    Explicit ids win; a name with ``agua`` gives the water theme; any other name gives ids of its own.
    """
    name = token(F.coalesce("t.nome", "i.nome"))
    water = name.contains("agua")
    explicit = F.col("t.template_id").isNotNull() & F.col("t.theme_id").isNotNull()
    theme = F.when(explicit, F.col("t.theme_id")).when(water, F.lit("laudo_agua")).otherwise(F.concat(F.lit("laudo_"), name))
    template = F.when(explicit, F.col("t.template_id")).when(water, F.lit("template_laudo_agua_v1")).otherwise(F.concat(F.lit("template_"), theme, F.lit("_v"), F.col("t.id").cast("string")))
    joined = tables["template"].alias("t").join(tables["item_taxonomia"].alias("i"), F.col("t.id_item_taxonomia") == F.col("i.id"), "left")
    return joined.select(
        F.col("t.id").alias("id"), template.alias("template_id"), theme.alias("theme_id"), F.col("i.id_taxonomia").alias("id_taxonomia"), F.col("i.nome").alias("nome_taxonomia"), F.col("t.versao_template").try_cast("int").alias("versao_template"), F.col("t.regex").alias("regex"),
        F.coalesce("t.prioridade", "t.id", F.lit(999)).alias("prioridade"), F.coalesce("t.score_minimo", F.lit(80.0)).alias("score_minimo"), (~F.lower(F.trim(F.coalesce("t.ativo", F.lit("sim")))).isin(FALSE_WORDS)).alias("ativo"),
    )


@dataclass
class Compiled:
    templates: list[Template]
    detection: list[DetectionRule]
    rows: dict[str, RuleSet]
    fields: dict[str, dict[str, list[tuple[str, str]]]]  # template -> group -> (campo, pattern)
    packaging: dict[str, PackagingRules]
    faults: list[tuple] = field(default_factory=list)  # rules that cannot be run, as rows of FAULTS

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """The rules that were left out because they cannot be run."""
        return spark.createDataFrame(self.faults, FAULTS)


def compile_rules(tables: dict[str, DataFrame]) -> Compiled:
    """Everything that the operators take, by template; rules that lack what they need are left out.

    So are those whose pattern cannot be run: each is a row of ``faults``, and costs nothing but itself.
    """
    lost: list[tuple] = []
    known = [t for t in template_identities(tables).orderBy("id").collect() if t.ativo]
    templates = {t.template_id: Template(t.template_id, t.score_minimo, t.prioridade or 999, t.theme_id, t.id_taxonomia, t.nome_taxonomia, t.versao_template) for t in known}
    by_id = {t.id: t.template_id for t in known}
    items = tables["item_template"].where(~is_config_marker(F.col("regex")) | F.col("schema").isin("layout")).orderBy("id").limit(MOST_RULES + 1).collect()
    if len(items) > MOST_RULES:
        raise TaxonomyError(f"mais de {MOST_RULES} regras")
    def runs(table: str, ident: int, schema: str | None, campo: str | None, regex: str | None) -> bool:
        if schema == "layout" or regex is None or (why := faults(regex)) is None:
            return True
        lost.append((table, ident, schema, campo, regex, why))
        return False

    items = [r for r in items if runs("item_template", r.id, r.schema, r.campo, r.regex)]
    detection, fields = [], {}
    groups: dict[str, dict[str, list]] = {t: {} for t in templates}
    for r in items:
        if (t := by_id.get(r.id_template)) is None:
            continue
        attrs = attributes(r.coluna_origem)
        if r.schema.startswith("template_"):
            kind = attrs.get("rule_type") if r.schema == "template_detection" else r.schema.removeprefix("template_")
            detection.append(DetectionRule(t, kind, r.regex, weight(attrs.get("peso")), attrs.get("descricao"), attrs.get("source", "text")))
        else:
            groups[t].setdefault(r.schema, []).append((r, attrs))
            if (r.campo or r.schema == IGNORED) and r.schema not in ("layout", "header_alias", "continuation"):
                fields.setdefault(t, {}).setdefault(r.schema, []).append((r.campo or "", r.regex))
    with_detail = {d.template_id for d in detection}
    detection += [DetectionRule(t.template_id, "positive", t.regex, 80.0) for t in known if t.template_id not in with_detail and t.regex and runs("template", t.id, None, None, t.regex)]

    def section(r, attrs: dict) -> SectionRule:
        return SectionRule(r.regex, attrs.get("categoria") or r.campo, attrs.get("subcategoria"), attrs.get("local", "laboratorio"), record_type(r.tipo_registro) or "AMOSTRA", attrs.get("extrair_subcategoria", "").lower() in TRUE_WORDS)

    def by_priority(own: list) -> list:
        return sorted(own, key=lambda x: (weight(x[1].get("prioridade"), 1e9), x[0].id))

    rows = {}
    for t, own in groups.items():
        ordered = by_priority(own.get("subcategory_alias", []))
        labs = [fold_text(a["prefixo"]) for r, a in own.get("category_alias", []) if a.get("laboratorio_externo", "").lower() in TRUE_WORDS and a.get("prefixo")]
        layouts: dict[str, dict[str, int]] = {}
        for r, _ in own.get("layout", []):
            name = (r.campo or "").strip().removesuffix("_col")
            if name in LAYOUT_FIELDS and str(r.coluna_origem or "").strip().isdigit():
                layouts.setdefault(record_type(r.tipo_registro) or "AMOSTRA", {})[name] = int(r.coluna_origem)
        rows[t] = RuleSet(
            tuple(section(r, a) for r, a in by_priority(own.get("category_alias", []))), tuple(section(r, a) for r, a in ordered), tuple(section(r, a) for r, a in own.get("category_type", [])),
            tuple((r.regex, record_type(r.tipo_registro)) for r, _ in own.get("continuation", []) if r.tipo_registro), tuple((r.regex, r.campo.removesuffix("_col")) for r, _ in own.get("header_alias", []) if r.campo), layouts, tuple(labs),
        )
    roles = PackagingRules.__dataclass_fields__
    packaging = {t: PackagingRules(**{role: tuple(p for c, p in own.get("packaging_preservatives", []) if c == role) for role in roles}) for t, own in fields.items()}
    return Compiled([*templates.values()], detection, rows, fields, packaging, lost)


#: Rules of lines that are no headings; tables are not judged by them.
IGNORED = "section_discovery_ignore"


def known_patterns(rules: Compiled, template: str | None = None, ignored: bool = True) -> list[str]:
    """Every pattern that the rules know a line by, of one template or of all: what none of them explains is new."""
    wanted = lambda t: template is None or t == template
    found = [d.regex for d in rules.detection if wanted(d.template_id)]
    for t, own in rules.rows.items():
        if wanted(t):
            found += [r.regex for r in (*own.categories, *own.subcategories, *own.types)] + [p for p, _ in (*own.continuations, *own.header_aliases)]
    found += [p for t, groups in rules.fields.items() if wanted(t) for g, own in groups.items() if ignored or g != IGNORED for _, p in own]
    return sorted({*found})


def output_tabs(tables: dict[str, DataFrame]) -> list[str]:
    """Outputs that the schemas name, in the engine's order, the reconciliation last."""
    named = {r[0] for r in tables["schema"].select("nome").distinct().collect()}
    return [n for n in TABLES if n in named] + ["document_reconciliation_audit"]
