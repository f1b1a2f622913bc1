"""Fixed values that must equal the reference's for results to match.

They are data contract, not logic: column names the warehouse expects, sentinel
text, literal filter lists of the stalled-cases facts, layout bucket names and
the declared schema catalogue. They are kept together, as plain text, in the
order the reference states them.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# --- fixed values: string cleaning ----------------------------------------------------------
NOT_INFORMED = "NÃO INFORMADO"

# --- fixed values: audit columns (name, meaning) ---------------------------------------------
AUDIT_LOAD_TS = "dt_carga"  # load time
AUDIT_VERSION = "etl_versao"  # version, always 1
AUDIT_VALID_FROM = "etl_dt_inicio"  # validity start
AUDIT_VALID_TO = "etl_dt_fim"  # validity end
AUDIT_VERSION_VALUE = 1
AUDIT_VALID_FROM_VALUE = "1900-01-01 00:00:00.000"
AUDIT_VALID_TO_VALUE = "2200-01-01 00:00:00.000"
AUDIT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# --- fixed values: lake layout -----------------------------------------------------------------
RAW_BUCKET = "raw"
STANDARDIZED_BUCKET = "standardized"
REFINED_BUCKET = "refined"
RAW_FILE_TYPES = ("csv", "json")
DATE_KEY_FORMAT = "yyyyMMdd"
RAW_CONTEXT = "operacional"

# --- fixed values: stalled-cases facts (movements / units / cases / case types) ----------------
EVENT_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
STALLED_TASK_CODES = ("2",)
EXCLUDED_UNIT = "AL-SAI"
STALLED_CASE_TYPES = (
    "Adesão à Ata de Registro de Preços",
    "Compra de Material e Contratação de Serviços",
    "Compra Direta",
    "Contratação por Pregão Eletrônico",
    "Contratação por Pregão Presencial",
    "Contratação/Pagamento de Serviços",
    "Contrato",
    "Controle de Pagamento de Registro de Preço",
    "Convênios",
    "Dispensa de Licitação",
    "Dispensa de Licitação - Extrato",
    "Inexigibilidade de Licitação",
    "Licitação",
    "Pagamento de Despesas Continuadas/Contratos",
    "Prestação de Serviços",
    "Projeto/Proposta",
    "Projetos/Obras e Construções",
    "Registro de Preço",
)

# Column names of the source system, as landed.
MOVEMENT_KEY = "IdAndamento"
MOVEMENT_CASE = "IdProcedimentoFormatado"
MOVEMENT_UNIT = "Unidade"
MOVEMENT_USER = "Usuario"
MOVEMENT_TASK = "IdTarefa"
MOVEMENT_TIME = "DataHora"
UNIT_KEY = "IdUnidade"
UNIT_NAME = "Sigla"
USER_KEY = "IdUsuario"
CASE_KEY = "IdProcedimento"
CASE_CODE = "ProcedimentoFormatado"
CASE_TYPE = "TipoProcedimento"
CASE_TYPE_KEY = "IdTipoProcedimento"
CASE_TYPE_NAME = "Nome"

# Nested elements whose id child is lifted when an XML response is flattened: element -> child.
NESTED_ID_CHILDREN = {"Unidade": "IdUnidade", "Usuario": "IdUsuario"}  # movement responses
CASE_NESTED_ID_CHILDREN = {"TipoProcedimento": "IdTipoProcedimento"}  # case responses

# Block list of case codes the case extraction skips.
BLOCKED_CASES = ("0000303-29.2024.4.05.7200",)

# --- fixed values: declared schema catalogue ----------------------------------------------------
_S, _I, _D = StringType(), IntegerType(), DoubleType()

_GOV_CAGED = [
    ("saldo", _I), ("raca_cor", _S), ("tipo_empregador", _S), ("contribuinte", _S),
    ("fonte_novo_caged", _S), ("tipo_movimentacao", _S), ("grau_instrucao", _S), ("cnae", _S),
    ("industria", _S), ("dt_carga", _S), ("codigo_municipio", _S), ("tipo_deficiencia", _S),
    ("secao", _S), ("cbo", _S), ("demanda_formacao", _S), ("nome_municipio", _S),
    ("tempo_emprego_meses", _I), ("divisao", _S), ("grande_grupo", _S), ("industrial_uniepro", _S),
    ("tipo_trabalhador", _S), ("salario_mensal", _D), ("grupo", _S), ("subgrupo_principal", _S),
    ("uf", _S), ("aprendiz", _S), ("horas_contratuais", _D), ("classe", _S), ("subgrupo", _S),
    ("movimentacao", _S), ("idade", _I), ("porte", _S), ("subclasse", _S), ("familia", _S),
    ("periodo", _S), ("sexo", _S), ("tipo_estabelecimento", _S), ("ocupacao", _S), ("origem", _S),
]

_GOV_CAGED_DW = [
    ("tipo_movimentacao", _S), ("raca_cor", _S), ("tipo_empregador", _S), ("contribuinte", _S),
    ("fonte_novo_caged", _S), ("codigo_municipio", _S), ("grau_instrucao", _S), ("cnae", _S),
    ("industria", _S), ("dt_carga", _S), ("nome_municipio", _S), ("tipo_deficiencia", _S),
    ("secao", _S), ("cbo", _S), ("demanda_formacao", _S), ("tipo_trabalhador", _S),
    ("tempo_emprego_meses", _I), ("divisao", _S), ("grande_grupo", _S), ("industrial_uniepro", _S),
    ("aprendiz", _S), ("salario_mensal", _D), ("grupo", _S), ("subgrupo_principal", _S),
    ("id_uf", _I), ("movimentacao", _S), ("idade", _I), ("horas_contratuais", _I), ("classe", _S),
    ("subgrupo", _S), ("dsc_uf", _S), ("periodo", _S), ("sexo", _S), ("porte", _S),
    ("subclasse", _S), ("familia", _S), ("saldo", _I), ("tipo_estabelecimento", _S),
    ("ocupacao", _S), ("origem", _S),
]


def _struct(fields: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


DECLARED_SCHEMAS: dict[str, StructType] = {
    "GovCaged": _struct(_GOV_CAGED),
    "GovCagedDW": _struct(_GOV_CAGED_DW),
}

# --- fixed values: output columns of the stalled-cases facts -----------------------------------
FACT_CASE = "IdProcedimentoFormatado"
FACT_UNIT = "Sigla"
FACT_TYPE = "tipo"
FACT_DAYS = "Dias_Sem_Movimentacao"
FACT_BY_UNIT = "Setor"
FACT_COUNT = "qtd"
