"""Names and spellings that consumers of the published tables rely on."""

from __future__ import annotations

from dataclasses import dataclass

# Category spellings, in display order.
SENIORITIES = ("Júnior", "Pleno", "Sênior")
GENDERS = ("Feminino", "Masculino", "Outro", "Prefiro não informar")
WORK_MODELS = ("Remoto", "Híbrido flexível", "Híbrido fixo", "Presencial")
EVERYONE = "Todos"

# Technology label -> flag column.
TECHNOLOGIES = {
    "SQL": "usa_sql",
    "Python": "usa_python",
    "AWS": "usa_aws",
    "Azure": "usa_azure",
    "GCP": "usa_gcp",
    "Databricks": "usa_databricks",
    "Power BI": "usa_power_bi",
    "Tableau": "usa_tableau",
}
TREND_TECHNOLOGIES = ("SQL", "Python", "Databricks")

# AI access flag -> published count, and count -> chart label.
AI_ACCESS_COUNTS = {
    "ia_gratuita": "uso_gratuito",
    "ia_paga_propria": "uso_pago_proprio",
    "ia_paga_empresa": "uso_pago_empresa",
    "ia_copilot": "uso_copilot",
}
AI_ACCESS_LABELS = {
    "uso_gratuito": "Gratuito",
    "uso_pago_proprio": "Pago pelo profissional",
    "uso_pago_empresa": "Pago pela empresa",
    "uso_copilot": "Copilot",
}

# Segment type label -> column of the conformed table (None = everyone).
PAY_SEGMENTS = {
    "cargo": "cargo_padronizado",
    "senioridade": "senioridade",
    "regiao": "regiao_moradia",
    "modelo_trabalho": "modelo_trabalho_padronizado",
    "genero": "genero",
    "experiencia": "tempo_experiencia_historica",
}
TECHNOLOGY_SEGMENTS = {
    "geral": None,
    "cargo": "cargo_padronizado",
    "senioridade": "senioridade",
}
AI_SEGMENTS = {
    "geral": None,
    "cargo": "cargo_padronizado",
    "senioridade": "senioridade",
    "regiao": "regiao_moradia",
    "modelo_trabalho": "modelo_trabalho_padronizado",
    "faixa_salarial": "faixa_salarial_original",
}

# Expected shape of each edition's raw file.
EDITION_PROFILES = {
    2022: {"registros": 4271, "colunas": 353, "duplicados_excedentes": 1},
    2023: {"registros": 5293, "colunas": 399, "duplicados_excedentes": 0},
    2024: {"registros": 5217, "colunas": 403, "duplicados_excedentes": 2},
}

# Columns of the conformed table.
SILVER_TYPES = {
    "id_respondente": "bigint",
    "ano_pesquisa": "int",
    "cargo_padronizado": "string",
    "senioridade": "string",
    "genero": "string",
    "regiao_moradia": "string",
    "modelo_trabalho_padronizado": "string",
    "tempo_experiencia_historica": "string",
    "faixa_salarial_original": "string",
    "salario_ordem": "int",
    "salario_ponto_medio": "double",
    "eh_gestor": "int",
    "usa_sql": "int",
    "usa_python": "int",
    "usa_aws": "int",
    "usa_azure": "int",
    "usa_gcp": "int",
    "usa_databricks": "int",
    "usa_power_bi": "int",
    "usa_tableau": "int",
    "usa_ia_generativa": "int",
    "ia_gratuita": "int",
    "ia_paga_propria": "int",
    "ia_paga_empresa": "int",
    "ia_copilot": "int",
    "flag_ia_contraditoria": "int",
    "quantidade_flags_qualidade": "int",
}

# Table names in the catalog.
SILVER_TABLE = "silver_profissionais"
AUDIT_TABLE = "auditoria_pipeline"


@dataclass(frozen=True)
class Settings:
    """Analysis parameters; the defaults are those of the published analysis."""

    focus_year: int = 2024
    ai_since: int = 2023
    min_cell: int = 30
    min_pay_cell: int = 50
    top: int = 8
