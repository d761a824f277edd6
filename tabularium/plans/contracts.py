"""Fixed output tables: names and order of their columns, and what validation asks of them."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the outputs, in order.
PREFIX = ["nome_do_arquivo", "id_taxonomia", "nome_taxonomia", "versao_template", "acm_data_hora_extracao"]
RESULTS = [
    *PREFIX,
    "id_amostra", "tipo", "categoria", "subcategoria", "codigo_laudo", "acm_codigo_laudo",
    "codigo_laudo_substituido", "parameter", "resultado", "unidade", "acm_resultado_tratado",
    "acm_qualificador", "acm_unidade", "local", "data_inicio", "acm_data_inicio", "conama",
    "acm_conama_operador", "acm_conama_minimo", "acm_conama_maximo", "acm_conama_unidade", "copam_cerh",
    "acm_copam_cerh_operador", "acm_copam_cerh_minimo", "acm_copam_cerh_maximo", "acm_copam_cerh_unidade", "ld",
    "acm_ld_minimo", "acm_ld_maximo", "acm_ld_unidade", "lq", "acm_lq_minimo", "acm_lq_maximo",
    "acm_lq_unidade", "referencia", "incerteza", "acm_incerteza_valor", "acm_incerteza_unidade", "numero_cq",
    "duplicata", "faixa_aceitacao", "acm_faixa_aceitacao_operador", "acm_faixa_aceitacao_minimo",
    "acm_faixa_aceitacao_maximo", "acm_faixa_aceitacao_unidade", "variacao_percentual", "quantidade_adicionada",
    "recuperacao_percentual",
]
SAMPLE = [
    *PREFIX,
    "id_amostra", "identificacao_amostra", "tipo_amostra", "criterio_conformidade", "data_coleta",
    "data_publicacao", "data_recebimento", "observacoes", "localizacao", "latitude", "longitude",
    "latitude_real", "longitude_real", "condicoes_climaticas_nas_ultimas_24_horas",
    "condicoes_climaticas_no_momento_da_coleta", "tipo_coleta", "responsavel_amostra",
    "planejamento_amostragem", "descricao_nao_conformidade", "codigo_laudo_substituido",
]
CLIENT = [
    *PREFIX,
    "id_amostra", "proposta_comercial", "cliente", "cnpj_cpf", "contato", "telefone", "endereco",
]
PACKAGING = [
    *PREFIX,
    "id_amostra", "identificacao_amostra", "embalagem", "volume", "preservacao", "metodos",
]
NOTES = [*PREFIX, "id_amostra", "pagina", "texto"]
VALIDATION_KEY = [*PREFIX, "id_amostra", "pagina", "chave_validacao"]
REVISION_REASON = [*PREFIX, "id_amostra", "pagina", "motivo_revisao"]
TABLES = {
    "results_extract": RESULTS, "sample": SAMPLE, "client": CLIENT, "packaging_preservatives": PACKAGING, "notes": NOTES,
    "general_considerations": NOTES, "conformity_statement": NOTES, "validation_key": VALIDATION_KEY, "revision_reason": REVISION_REASON,
}
TABLE_AUDIT = [
    *PREFIX,
    "pagina", "tabela_indice", "categoria", "subcategoria", "tipo_registro", "modo_auditoria", "cabecalho_detectado",
    "colunas_detectadas", "colunas_mapeadas", "colunas_sem_mapeamento", "campos_esperados", "campos_obrigatorios_ausentes",
    "campos_opcionais_ausentes", "usou_fallback", "status", "observacao",
]
SECTION_AUDIT = [
    *PREFIX,
    "pagina", "tabela_indice", "objeto_tipo", "secao", "titulo_detectado", "modo_auditoria", "regra_encontrada",
    "ocorrencias_detectadas", "registros_extraidos", "status", "observacao",
]
FIELD_AUDIT = [
    *PREFIX,
    "schema_origem", "campo", "pagina", "regra_encontrada", "ocorrencias_detectadas", "valor_extraido",
    "campos_detectados_no_valor", "status", "observacao",
]
LAYOUT_FIELDS = [
    "resultado", "unidade", "data_inicio", "conama", "copam_cerh", "ld", "lq", "referencia", "incerteza",
    "numero_cq", "duplicata", "faixa_aceitacao", "variacao_percentual", "quantidade_adicionada",
    "recuperacao_percentual",
]
TIPO_LABELS = {"AMOSTRA": "Amostra", "BRANCO": "Branco", "DUPLICATA": "Duplicata", "RECUPERACAO": "Recuperação"}
OPERATORS = ["max", "min", "<", ">", "<=", ">=", "="]
DATE = r"^\d{2}/\d{2}/\d{4}$"
DATE_TIME = r"^\d{2}/\d{2}/\d{4}(?:\s+\d{2}:\d{2}(?::\d{2})?)?$"
LINEAGE = {
    "codigo_laudo": ["acm_codigo_laudo"], "data_inicio": ["acm_data_inicio"], "resultado": ["acm_resultado_tratado", "acm_qualificador"],
    **{f: [f"acm_{f}_operador", f"acm_{f}_minimo", f"acm_{f}_maximo"] for f in ("conama", "copam_cerh")},
    **{f: [f"acm_{f}_minimo", f"acm_{f}_maximo"] for f in ("ld", "lq")}, "incerteza": ["acm_incerteza_valor"],
    "faixa_aceitacao": ["acm_faixa_aceitacao_operador", "acm_faixa_aceitacao_minimo", "acm_faixa_aceitacao_maximo"],
}
UNIT_FIELDS = {"resultado": "acm_unidade", **{f: f"acm_{f}_unidade" for f in ("conama", "copam_cerh", "ld", "lq", "incerteza", "faixa_aceitacao")}}


@dataclass(frozen=True)
class Contract:
    """Field rules of a table; a field without one is optional text."""

    columns: list[str]
    required: list[str]
    integers: list[str] = field(default_factory=list)
    numbers: list[str] = field(default_factory=list)
    scaled: list[str] = field(default_factory=list)  # may be followed by x 10 n
    numeric_text: list[str] = field(default_factory=list)
    choices: dict[str, list[str]] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    ranges: list[str] = field(default_factory=list)
    measures: bool = False


RESULTS_CONTRACT = Contract(
    RESULTS,
    ["nome_do_arquivo", "id_taxonomia", "id_amostra", "tipo", "categoria", "parameter", "local"],
    integers=["id_taxonomia", "versao_template", "id_amostra"],
    numbers=[c for c in RESULTS if c.startswith("acm_") and c.endswith(("_minimo", "_maximo", "_valor"))],
    scaled=["acm_resultado_tratado", "variacao_percentual", "quantidade_adicionada", "recuperacao_percentual"],
    numeric_text=["duplicata"],
    choices={"tipo": [*TIPO_LABELS.values()], "local": ["campo", "laboratorio"], "acm_qualificador": ["<", ">"], **{f"acm_{f}_operador": OPERATORS for f in ("conama", "copam_cerh", "faixa_aceitacao")}},
    patterns={"acm_data_hora_extracao": DATE_TIME, "data_inicio": DATE, "acm_data_inicio": DATE_TIME},
    ranges=["conama", "copam_cerh", "ld", "lq", "faixa_aceitacao"],
    measures=True,
)
CLIENT_CONTRACT = Contract(CLIENT, ["nome_do_arquivo", "id_taxonomia", "id_amostra"], integers=["id_taxonomia", "versao_template", "id_amostra"], patterns={"acm_data_hora_extracao": DATE_TIME})
PACKAGING_CONTRACT = Contract(PACKAGING, ["nome_do_arquivo", "id_taxonomia", "id_amostra", "identificacao_amostra", "embalagem", "volume", "preservacao", "metodos"], integers=["id_taxonomia", "versao_template", "id_amostra"], patterns={"acm_data_hora_extracao": DATE_TIME})
SAMPLE_CONTRACT = Contract(
    SAMPLE, ["nome_do_arquivo", "id_taxonomia", "id_amostra"], integers=["id_taxonomia", "versao_template", "id_amostra"], numbers=["latitude", "longitude", "latitude_real", "longitude_real"],
    patterns={"acm_data_hora_extracao": DATE_TIME, "data_coleta": DATE_TIME, "data_publicacao": DATE_TIME, "data_recebimento": DATE_TIME},
)
