"""Explicit schemas: no inference, product and place codes stay text."""

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# one API cell; element 0 of the payload array is the header row
PAYLOAD_CELL = _struct(
    D1C=_S, D1N=_S, D2C=_S, D2N=_S, D3C=_S, D3N=_S, D4C=_S, D4N=_S,
    MC=_S, MN=_S, NC=_S, NN=_S, V=_S,
)
PAYLOAD = T.ArrayType(PAYLOAD_CELL)

RAW_WIDE = _struct(
    produto=_S, produto_cod=_S, nivel_territorial=_S, cod_territorial=_S,
    nome_territorial=_S, ano=_I, area_colhida_ha=_D, qtd_produzida=_D,
    unidade_qtd=_S, rendimento_medio_kg_ha=_D, valor_producao_mil_reais=_D,
    fonte=_S, tabela_sidra=_S, url_origem=_S, coletado_em=_S,
)

# the same row before typing, for files whose numbers may be malformed
RAW_WIDE_TEXT = T.StructType([T.StructField(f.name, _S) for f in RAW_WIDE])

ENVELOPE = _struct(
    fonte=_S, tabela=_S, nivel=_S, anos=T.ArrayType(_L), total_registros=_L,
    coletado_em=_S, registros=T.ArrayType(RAW_WIDE),
)

PROCESSED = _struct(
    produto=_S, produto_nome_ibge=_S, produto_cod=_S, nivel_territorial=_S,
    cod_territorial=_S, nome_territorial=_S, ano=_I, area_colhida_ha=_D,
    qtd_produzida=_D, unidade_qtd=_S, rendimento_medio_kg_ha=_D,
    valor_producao_mil_reais=_D, status_dado=_S, fonte=_S, tabela_sidra=_S,
    url_origem=_S, coletado_em=T.TimestampNTZType(),
    processado_em=T.TimestampNTZType(), versao_etl=_S,
)
