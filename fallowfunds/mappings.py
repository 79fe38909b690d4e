"""The pinned reference table: which source column of which sheet holds which canonical field.

It is data, not inference: re-reading an old publication must give what it gave before. Pass a
DataFrame of the same shape to the operators to use another one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Source column names exactly as published, trailing blanks included. A layout
# used by several publications is written once.

SPECIAL_CONDITION_2017 = {
    "NÙMERODEDEPÒSITOJUDICIALENCONDICIÒNESPECIAL": "deposit_no",
    "FECHA DE  CONSTITUCION DD/MM/AAAA ": "origin_date",
    "VALOR": "amount_cop",
    "NUMERO DE RADICADO DEL PROCESO (23 DIGITOS)": "case_number",
    "ID DEMANTANTE": "plaintiff_id",
    "NOMBRE DEMANTANDE": "plaintiff_name",
    "ID DEMANDADO": "defendant_id",
    "NOMBRE DEMANDADO": "defendant_name",
    "NOMBRE DESPACHO": "court_name",
    "FECHA DE LA ACTUACIÓN QUE DIO FIN AL PROCESO  DD/MM/AAAA": "case_action_date",
    "__UNNAMED__10": "source_extra",
}

UNCLAIMED_2017 = {
    "NÙMERO DE DEPÒSITO JUDICIAL NO RECLAMADOS": "deposit_no",
    "FECHA DE  CONSTITUCION DD/MM/AAAA ": "origin_date",
    "VALOR": "amount_cop",
    "NUMERO DE RADICADO DEL PROCESO (23 DIGITOS)": "case_number",
    "ID DEMANTANTE": "plaintiff_id",
    "NOMBRE DEMANTANDE": "plaintiff_name",
    "ID DEMANDADO": "defendant_id",
    "NOMBRE DEMANDADO": "defendant_name",
    "NOMBRE DESPACHO": "court_name",
    "FECHA DE LA ACTUACIÓN QUE DIO FIN AL PROCESO  DD/MM/AAAA": "case_action_date",
    "__UNNAMED__10": "source_extra",
    "__UNNAMED__11": "source_extra",
}

CONSOLIDATED_2018 = {
    "No. DEPÓSITO": "deposit_no",
    "NOMBRE JUZGADO": "court_name",
    "No. IDENTIFICACIÓN DEMANDANTE": "plaintiff_id",
    "No. IDENTIFICACIÓN DEMANDADO": "defendant_id",
    "VALOR DEPOSITO": "amount_cop",
    "FECHA DE EMISIÓN": "origin_date",
    "DIRECCIÓN SECCIONAL": "seccional",
    "DEPARTAMENTO": "department",
    "MUNICIPIO": "city",
}

PUBLISHED_2018 = {**CONSOLIDATED_2018, "__UNNAMED__9": "source_extra"}

LISTING_2019 = {
    "TIPO DEPÓSITO ": "deposit_type",
    "No. DEPÓSITO": "deposit_no",
    "CUENTA JUDICIAL": "court_account",
    "NOMBRE JUZGADO": "court_name",
    "No. IDENTIFICACIÓN DEMANDANTE": "plaintiff_id",
    "No. IDENTIFICACIÓN DEMANDADO": "defendant_id",
    "VALOR DEPOSITO": "amount_cop",
    "FECHA DE EMISIÓN": "origin_date",
    "DIRECCIÓN SECCIONAL": "seccional",
    "DEPARTAMENTO": "department",
    "MUNICIPIO": "city",
}

LISTING_2020 = {
    "Nro. Depósito Judicial": "deposit_no",
    "Tipo Depósito Judicial": "deposit_type",
    "No. cuenta judicial": "court_account",
    "Nombre despacho judicial": "court_name",
    "Identificación demandante": "plaintiff_id",
    "Identificación demandado": "defendant_id",
    "Valor Depósito": "amount_cop",
    "Fecha Emisión": "origin_date",
    "Dirección Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

LISTING_2021_1 = {
    "Tipo de Depósito": "deposit_type",
    "Número de Depósito": "deposit_no",
    "Número de Cuenta": "court_account",
    "Despacho Judicial": "court_name",
    "Identificación Demandante": "plaintiff_id",
    "Identificación Demandado": "defendant_id",
    "Valor del Depósito": "amount_cop",
    "Fecha de Emisión ": "origin_date",
    "Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

DETAIL_2021_2 = {
    "Tipo Depósito": "deposit_type",
    "Número Depósito": "deposit_no",
    "Cuenta Judicial": "court_account",
    "Nombre Despacho Judicial": "court_name",
    "Identificación Demandante": "plaintiff_id",
    "Identificación Demandado": "defendant_id",
    "Valor Depósito": "amount_cop",
    "Fecha Elaboración": "origin_date",
    "Dirección Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

BASE_2022_1 = {
    "Clasificación": "classification",
    "Depósito Judicial": "deposit_no",
    "Cuenta Judicial": "court_account",
    "Nombre Despacho": "court_name",
    "Demandante": "plaintiff_id",
    "Demandando": "defendant_id",
    "Valor": "amount_cop",
    "Fecha": "origin_date",
    "Dirección Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

CONSOLIDATED_2022_2 = {
    "Clasificación": "classification",
    "Numero depósito": "deposit_no",
    "Cuenta judicial": "court_account",
    "Nombre Despacho": "court_name",
    "Demandante": "plaintiff_id",
    "Demandado": "defendant_id",
    "Valor Depósito": "amount_cop",
    "Fecha Constitución": "origin_date",
    "Dirección Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

INVENTORY_2023_1 = {
    "Número Depósito Judicial": "deposit_no",
    "Nombre Despacho": "court_name",
    "Cuenta Judicial": "court_account",
    "Demandante": "plaintiff_id",
    "Demandado": "defendant_id",
    "Valor Depósito": "amount_cop",
    "Fecha Depósito": "origin_date",
    "Seccional ": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

SEARCH_2023_2 = {
    "Depósito": "deposit_no",
    "Despacho Judicial": "court_name",
    "Cuenta Judicial": "court_account",
    "Tipo Identificación": "plaintiff_id_type",
    "Identificación Demandante": "plaintiff_id",
    "Nombre Demandante": "plaintiff_name",
    "Tipo Identificación2": "defendant_id_type",
    "Identificación Demandado": "defendant_id",
    "Nombre Demandado": "defendant_name",
    "Valor Depósito": "amount_cop",
    "Fecha Constitución": "origin_date",
    "Distrito Judicial": "judicial_district",
    "Dpto.": "department",
    "Ciudad": "city",
}

SEARCH_2024_ON = {
    "No. Depósito": "deposit_no",
    "Despacho Judicial": "court_name",
    "Cuenta Judicial": "court_account",
    "Identificación Demandante": "plaintiff_id",
    "Identificación Demandado": "defendant_id",
    "Valor": "amount_cop",
    "Fecha Constitución": "origin_date",
    "Seccional": "seccional",
    "Departamento": "department",
    "Ciudad": "city",
}

SUMMARY_SHEET_REASON = (
    "Aggregate summary (count + total value per city), not per-deposit rows "
    "— real detail is in the 'Publicar' sheet of this file. "
)

# (period, sheet, layout, reason to skip the sheet)
PINNED = (
    ("2017-1", "D J EN CONDICION ESPECIAL", SPECIAL_CONDITION_2017, None),
    ("2017-1", "D J NO RECLAMADOS", UNCLAIMED_2017, None),
    ("2018-1", "Consolidado Publicar", CONSOLIDATED_2018, None),
    ("2018-2", "Hoja1", {}, SUMMARY_SHEET_REASON),
    ("2018-2", "Publicar", PUBLISHED_2018, None),
    ("2019-1", "Listado Publicación", LISTING_2019, None),
    ("2020-1", "Consolidado", LISTING_2020, None),
    ("2020-2", "Publicación", LISTING_2020, None),
    ("2021-1", "Depósitos a Prescribir 2021-1a", LISTING_2021_1, None),
    ("2021-2", "Detalle", DETAIL_2021_2, None),
    ("2022-1", "Base Publicación", BASE_2022_1, None),
    ("2022-2", "Consolidado", CONSOLIDATED_2022_2, None),
    ("2023-1", "Inventario Publicar", INVENTORY_2023_1, None),
    ("2023-2", "Busqueda", SEARCH_2023_2, None),
    ("2024-1", "Busqueda", SEARCH_2024_ON, None),
    ("2024-2", "Busqueda", SEARCH_2024_ON, None),
    ("2025-1", "Busqueda", SEARCH_2024_ON, None),
    ("2025-2", "Busqueda", SEARCH_2024_ON, None),
    ("2026-1", "Busqueda", SEARCH_2024_ON, None),
)


def pinned_mapping(spark: SparkSession) -> DataFrame:
    """The reference table as a DataFrame of 19 rows."""
    table = pa.table(
        {
            "period": [period for period, _, _, _ in PINNED],
            "sheet": [sheet for _, sheet, _, _ in PINNED],
            "skip_reason": pa.array([reason for _, _, _, reason in PINNED], pa.string()),
            "column_map": pa.array(
                [
                    [{"source": source, "field": field} for source, field in layout.items()]
                    for _, _, layout, _ in PINNED
                ],
                pa.list_(pa.struct([("source", pa.string()), ("field", pa.string())])),
            ),
        }
    )
    # From Arrow the planner knows the size, so the join with it needs no shuffle.
    return spark.createDataFrame(table)
