"""Spec of the fixed-schema load: financial project lines, 80 target columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadsieve.functions.text import NULL_TOKENS_V1
from loadsieve.plans.spec import ColumnMeta, LoadSpec
from loadsieve.session import small_frame

# Column names in target order. {group} stands for the short name of the group of
# companies, which some market columns carry.
DATES = ("periodo", "fecha_inicio_proyecto", "fecha_fin_proyecto")
AMOUNTS = (
    "contratacion", "ventas", "margen_bruto", "costes_directos", "c_dir_corporativos", "c_dir_auxiliares",
    "c_elaboracion_ofertas", "disponibilidad", "actividades_id", "desviacion_tasa", "margen_directo", "indirectos",
    "costes_indirectos_mercado", "costes_indirectos_produccion", "costes_indirectos_comerciales",
    "margen_contribucion", "estructura", "indemnizaciones", "funciones_corporativas", "resto_estructura", "ebit",
    "amortizacion", "facturacion", "cobros", "cartera_com_final", "mg_cartera_com_final", "cartera_fin_final",
    "deuda", "dpf", "alo", "existencias",
)
DESCRIPTIVE = (
    "periodo", "operacion_cdg", "id_externo", "proyecto_indicador", "proyecto_indicador2", "empresa", "empresa5",
    "mercado_global_hom", "mercado_{group}_homg_ln", "mercado_{group}_homg_norg", "mercado_{group}_group",
    "nivel_org_2", "unidad_empresa_ano", "unidad_empresa_ano8", "cliente_contractual", "metacliente",
    "interlocutor", "intergrupo_rev", "intergrupo_rev_fyc", "intersegmento", "segmento_linea_negocio",
    "geografia_hom", "pais", "region_defensa", "aftermarket", "clase_proyecto", "tipo_proyecto_servicio_nivel_1",
    "tipo_proyecto_servicio_nivel_2", "tipo_proyecto_servicio_nivel_3", "solucion_nivel_2", "solucion_nivel_3",
    "gerente_vertical", "gestor_vertical", "fecha_inicio_proyecto", "fecha_fin_proyecto", "grandes_prog_def",
    "metodo_reconocimiento_ingreso7", "indicador_agrupacion", "mercado_{group}", "auditable", "mision", "programa",
    "valores",
)
FIXED = {
    "fecha_carga": ("timestamp without time zone", "__now_ts__"),
    "fecha_creacion": ("date", "__today__"),
    "fecha_ult_modificacion": ("date", "__today__"),
    "creador": ("text", "Massive Import"),
    "ult_modificador": ("text", "Massive Import"),
    "deleted_row": ("boolean", "__false__"),
}

# Header keys that are more than the column name without underscores.
SPELLED_OUT = {
    "id": "id_externo",
    "unidaddeempresaano": "unidad_empresa_ano",
    "unidaddeempresaano8": "unidad_empresa_ano8",
    "segmentolineadenegocio": "segmento_linea_negocio",
    "clasedeproyecto": "clase_proyecto",
    "costesindirectosdemercado": "costes_indirectos_mercado",
    "costesindirectosdeproduccion": "costes_indirectos_produccion",
}


def _inputs(group: str) -> list[str]:
    return [n.format(group=group) for n in DESCRIPTIVE] + list(AMOUNTS)


def fixed_schema_spec(group: str, target: str = "project_lines") -> LoadSpec:
    def kind(name: str) -> str:
        return "date" if name in DATES else "double precision" if name in AMOUNTS else "text"

    fixed = {n: ColumnMeta(n, t) for n, (t, _) in FIXED.items()}
    inputs = [ColumnMeta(n, kind(n)) for n in _inputs(group)]
    columns = (fixed.pop("fecha_carga"), *inputs, *fixed.values())
    return LoadSpec(
        target=target,
        columns=columns,
        fixed_values={n: token for n, (_, token) in FIXED.items()},
        null_tokens=NULL_TOKENS_V1,
        plain_numbers_only=True,
        summary_columns=("periodo", "operacion_cdg", "id_externo"),
        false_when_null=("deleted_row",),
    )


def header_aliases(spark: SparkSession, group: str) -> DataFrame:
    """key, alias: most keys are the column name without underscores."""
    special = set(SPELLED_OUT.values())
    pairs = [(n.replace("_", ""), n) for n in _inputs(group) if n not in special]
    return small_frame(spark, pairs + list(SPELLED_OUT.items()), "key STRING, alias STRING")
