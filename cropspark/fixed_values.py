"""Codes, labels, marks and column orders that results depend on.

They are data, not logic. Every operator takes them as parameters and uses the
values below only as defaults.
"""

# --- Fixed values: statistics service ---------------------------------------

# variable code -> metric column, as the published data sets label them
VARIABLES = {
    "214": "area_colhida_ha",
    "215": "qtd_produzida",
    "112": "rendimento_medio_kg_ha",
    "216": "valor_producao_mil_reais",
}

# the same codes with the labels the numbers themselves imply
# (value * yield / 1000 / area is 1 on published rows); see README
VARIABLES_CORRECTED = {
    "214": "qtd_produzida",
    "215": "valor_producao_mil_reais",
    "112": "rendimento_medio_kg_ha",
    "216": "area_colhida_ha",
}

METRICS = [
    "area_colhida_ha",
    "qtd_produzida",
    "rendimento_medio_kg_ha",
    "valor_producao_mil_reais",
]

# marks for a missing value in a payload cell, and in the second table
MISSING_MARKS = ["-", "...", "X", ""]
MISSING_MARK_SECOND_TABLE = ".."

SOURCE_NAME = "IBGE/PAM-SIDRA"
TABLE_CODE = "5457"
DEFAULT_UNIT = "Toneladas"
ETL_VERSION = "1.0"
YEAR_MIN = 1974
YEAR_MAX = 2100

TERRITORY_LEVELS = ["Brasil", "Unidade da Federação", "Município"]
STATUS_COMPLETE = "completo"
STATUS_PARTIAL = "parcial"

# product code -> official name
OFFICIAL_NAMES = {
    "40124": "Soja (em grão)",
    "40125": "Milho (em grão)",
    "40126": "Algodão herbáceo (em caroço)",
    "40127": "Amendoim (em casca)",
    "40128": "Arroz (em casca)",
    "40131": "Feijão (em grão)",
    "40132": "Café (em grão) Total",
    "40133": "Trigo (em grão)",
    "40135": "Cana-de-açúcar",
    "40138": "Mandioca",
    "40141": "Sorgo (em grão)",
    "40147": "Girassol (em grão)",
    "40148": "Aveia (em grão)",
    "40149": "Cevada (em grão)",
    "40150": "Triticale (em grão)",
    "40186": "Banana (cacho)",
    "40190": "Cacau (em amêndoa)",
    "40199": "Laranja",
    "40218": "Borracha (látex coagulado)",
    "40228": "Sisal ou agave (fibra)",
}

# lower-case product name -> canonical name (clean-up chain)
CANONICAL_NAMES = {
    "soja (em grão)": "Soja",
    "milho (em grão)": "Milho",
    "café (em grão) total": "Café",
    "cafe (em grao) total": "Café",
    "cana-de-açúcar": "Cana-de-Açúcar",
    "cana de acucar": "Cana-de-Açúcar",
    "algodão herbáceo (em caroço)": "Algodão",
    "algodao herbaceo (em caroco)": "Algodão",
    "trigo (em grão)": "Trigo",
    "arroz (em casca)": "Arroz",
    "feijão (em grão)": "Feijão",
    "feijao (em grao)": "Feijão",
    "soja": "Soja",
    "milho": "Milho",
    "café": "Café",
    "cafe": "Café",
    "algodão": "Algodão",
    "algodao": "Algodão",
    "trigo": "Trigo",
    "arroz": "Arroz",
    "feijão": "Feijão",
    "feijao": "Feijão",
    "mandioca": "Mandioca",
    "sorgo (em grão)": "Sorgo",
    "girassol (em grão)": "Girassol",
    "aveia (em grão)": "Aveia",
    "cevada (em grão)": "Cevada",
    "triticale (em grão)": "Triticale",
    "laranja": "Laranja",
    "banana (cacho)": "Banana",
    "cacau (em amêndoa)": "Cacau",
    "borracha (látex coagulado)": "Borracha",
    "sisal ou agave (fibra)": "Sisal",
}

# exact product name -> chart label (statistics script)
CHART_LABELS = {
    "Soja (em grão)": "Soja",
    "Milho (em grão)": "Milho",
    "Café (em grão) Total": "Café",
    "Cana-de-açúcar": "Cana",
    "Algodão herbáceo (em caroço)": "Algodão",
    "Trigo (em grão)": "Trigo",
    "Arroz (em casca)": "Arroz",
    "Feijão (em grão)": "Feijão",
}

# product code -> dashboard label
DASHBOARD_LABELS = {
    "40124": "Soja",
    "40125": "Milho",
    "40126": "Algodão",
    "40128": "Arroz",
    "40131": "Feijão",
    "40132": "Café",
    "40133": "Trigo",
    "40135": "Cana",
    "40138": "Mandioca",
}

# header text -> column name in the second long form
SECOND_FORM_COLUMNS = {
    "Produto das lavouras temporárias": "produto",
    "Variável": "variavel",
    "Valor": "valor",
    "Município": "municipio",
}
QUANTITY_LABEL = "Quantidade produzida"
PLANTED_AREA_LABEL = "Área plantada"

# anomaly categories, in the order they are tested
ANOMALY_CATEGORIES = [
    ("area_colhida_ha", "ÁREA INVÁLIDA"),
    ("qtd_produzida", "PRODUÇÃO INVÁLIDA"),
    ("valor_producao_mil_reais", "VALOR INVÁLIDO"),
    ("rendimento_medio_kg_ha", "RENDIMENTO INVÁLIDO"),
]
VALID_CATEGORY = "DADOS VÁLIDOS"
YIELD_CEILING = 100000

# --- Fixed values: column orders --------------------------------------------

RAW_COLUMNS = [
    "produto",
    "produto_cod",
    "nivel_territorial",
    "cod_territorial",
    "nome_territorial",
    "ano",
    "area_colhida_ha",
    "qtd_produzida",
    "unidade_qtd",
    "rendimento_medio_kg_ha",
    "valor_producao_mil_reais",
    "fonte",
    "tabela_sidra",
    "url_origem",
    "coletado_em",
]

PROCESSED_COLUMNS = [
    "produto",
    "produto_nome_ibge",
    "produto_cod",
    "nivel_territorial",
    "cod_territorial",
    "nome_territorial",
    "ano",
    "area_colhida_ha",
    "qtd_produzida",
    "unidade_qtd",
    "rendimento_medio_kg_ha",
    "valor_producao_mil_reais",
    "status_dado",
    "fonte",
    "tabela_sidra",
    "url_origem",
    "coletado_em",
    "processado_em",
    "versao_etl",
]

PIVOT_KEYS = [
    "produto",
    "produto_cod",
    "nivel_territorial",
    "cod_territorial",
    "nome_territorial",
    "ano",
    "fonte",
    "tabela_sidra",
    "url_origem",
    "coletado_em",
]
UNIT_KEYS = ["produto_cod", "ano", "cod_territorial"]

PROCESSED_KEYS = ["produto_cod", "cod_territorial", "nivel_territorial", "ano"]
PROCESSED_UPDATES = [
    "produto",
    "produto_nome_ibge",
    "area_colhida_ha",
    "qtd_produzida",
    "rendimento_medio_kg_ha",
    "valor_producao_mil_reais",
    "status_dado",
    "processado_em",
    "versao_etl",
]
FACT_KEYS = ["id_commodity", "id_territorio", "ano"]
FACT_UPDATES = METRICS + ["coletado_em"]
