"""Schema contracts of the five input datasets.

A contract is a ``"column TYPE, ..."`` text turned into a ``StructType``. Input
is always fitted to its contract; nothing relies on inferred types.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: column names and types of the public input files. ---------
VIAGENS_ONIBUS = """
    data DATE, consorcio VARCHAR, tipo_dia VARCHAR, id_empresa VARCHAR, id_veiculo VARCHAR,
    id_viagem VARCHAR, servico VARCHAR, shape_id VARCHAR, sentido VARCHAR,
    datetime_partida TIMESTAMP, datetime_chegada TIMESTAMP, tempo_viagem INT,
    distancia_planejada DOUBLE, perc_conformidade_shape DOUBLE,
    perc_conformidade_registros DOUBLE, versao_modelo VARCHAR
"""
CLIMA_PLUVIOMETRIA = """
    primary_key VARCHAR, id_estacao VARCHAR, acumulado_chuva_15_min DOUBLE,
    acumulado_chuva_1_h DOUBLE, acumulado_chuva_4_h DOUBLE, acumulado_chuva_24_h DOUBLE,
    acumulado_chuva_96_h DOUBLE, horario TIME, data_particao DATE
"""
ESTACOES_CLIMA = """
    id_estacao VARCHAR, estacao VARCHAR, latitude DOUBLE, longitude DOUBLE, cota DOUBLE,
    x DOUBLE, y DOUBLE, endereco VARCHAR, situacao VARCHAR, data_inicio_operacao TIMESTAMP,
    data_fim_operacao TIMESTAMP, data_atualizacao TIMESTAMP
"""
LICENCIAMENTO_FROTA = """
    carroceria VARCHAR, id_chassi BIGINT, id_fabricante_chassi BIGINT, nome_chassi VARCHAR,
    id_planta BIGINT, tipo_veiculo VARCHAR, status VARCHAR, data_inicio_vinculo DATE,
    data_ultima_vistoria DATE, ano_ultima_vistoria BIGINT, ultima_situacao VARCHAR,
    tecnologia VARCHAR, quantidade_lotacao_pe BIGINT, quantidade_lotacao_sentado BIGINT,
    tipo_combustivel VARCHAR, indicador_ar_condicionado BOOLEAN, indicador_elevador BOOLEAN,
    indicador_usb BOOLEAN, indicador_wifi BOOLEAN, indicador_veiculo_lacrado BOOLEAN,
    indicador_data_ultima_vistoria_tratada BOOLEAN, data_arquivo_fonte DATE, versao VARCHAR,
    datetime_ultima_atualizacao TIMESTAMP, id_execucao_dbt VARCHAR,
    ano_ultima_vistoria_atualizado BIGINT
"""
RECLAMACOES_1746 = """
    id_unidade_organizacional VARCHAR, nome_unidade_organizacional VARCHAR,
    id_unidade_organizacional_mae VARCHAR, unidade_organizacional_ouvidoria VARCHAR,
    categoria VARCHAR, id_tipo VARCHAR, tipo VARCHAR, id_subtipo VARCHAR, subtipo VARCHAR,
    status VARCHAR, longitude DOUBLE, latitude DOUBLE, data_alvo_finalizacao TIMESTAMP,
    data_alvo_diagnostico TIMESTAMP, data_real_diagnostico TIMESTAMP, tempo_prazo BIGINT,
    prazo_unidade VARCHAR, prazo_tipo VARCHAR, dentro_prazo VARCHAR, situacao VARCHAR,
    tipo_situacao VARCHAR, justificativa_status VARCHAR, reclamacoes BIGINT,
    extracted_at TIMESTAMP, updated_at VARCHAR, data_particao DATE
"""
# --- End of fixed values. ----------------------------------------------------

_TIME_COLUMN = re.compile(r"(\w+)\s+TIME\b", re.IGNORECASE)


def schema_from_ddl(ddl: str) -> T.StructType:
    """``"c TYPE, ..."`` to a ``StructType``; VARCHAR and TIME are carried as strings.

    TIME columns are marked in the field metadata, so that casting checks and
    normalises them to ``HH:mm:ss``.
    """
    clock = {name.lower() for name in _TIME_COLUMN.findall(ddl)}
    spark_ddl = re.sub(r"\bVARCHAR\b(?!\s*\()", "STRING", ddl, flags=re.IGNORECASE)
    spark_ddl = _TIME_COLUMN.sub(r"\1 STRING", spark_ddl)
    parsed = T.StructType.fromDDL(" ".join(spark_ddl.split()))
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, True, {"kind": "time"} if f.name.lower() in clock else {})
            for f in parsed.fields
        ]
    )


def is_clock(field: T.StructField) -> bool:
    return (field.metadata or {}).get("kind") == "time"


@dataclass(frozen=True)
class Contract:
    name: str
    ddl: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return schema_from_ddl(self.ddl)


CONTRACTS = {
    c.name: c
    for c in (
        Contract("viagens_onibus", VIAGENS_ONIBUS, ("id_viagem",)),
        Contract("clima_pluviometria", CLIMA_PLUVIOMETRIA, ("primary_key",)),
        Contract("estacoes_clima", ESTACOES_CLIMA, ("id_estacao",)),
        Contract("licenciamento_frota", LICENCIAMENTO_FROTA, ()),
        Contract("reclamacoes_1746", RECLAMACOES_1746, ()),
    )
}

# The three datasets loaded by default; the other two only when a source is given.
DEFAULT_DATASETS = ("viagens_onibus", "clima_pluviometria", "estacoes_clima")
