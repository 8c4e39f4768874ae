"""Table specs: one declaration per source table drives bronze ingest and the
silver strategy (``cdc`` = SCD-1 upsert by keys and sequence, ``snapshot`` =
latest full load)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from finlake.operators.cdc import latest_snapshot, scd1_upsert

MONEY = "decimal(18,2)"
RESCUED = "_rescued"        # JSON of the raw texts that their column's type can't hold

CARDS_SCHEMA = "id bigint, nome string"
ACCOUNTS_SCHEMA = "id bigint, nome string"
CATEGORIES_SCHEMA = "id bigint, categoriaPai string, categoria string, natureza string"
BUDGETS_SCHEMA = (f"data date, categoria string, subcategoria string, planejado {MONEY}, "
                  f"efetivado {MONEY}, previsto {MONEY}")
MOVEMENTS_SCHEMA = ("unique_id string, id bigint, conta_id bigint, cartao_id bigint, "
                    "tipo_transacao_id bigint, tipo_transacao_filho_id bigint, data date, "
                    "descricao string, tipo int, situacao string, ignorada boolean, fixa boolean, "
                    f"valor {MONEY}, valor_abs {MONEY}")


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: str
    keys: tuple
    strategy: str = "cdc"                   # "cdc" | "snapshot"
    business_date: str | None = None
    sequence_by: tuple = ("_ingesttime",)
    tiebreak: tuple = ("_sourcefile",)
    load_col: str = "_ingesttime"      # column or SQL expression identifying a load
    fmt: str = "csv"

    def columns(self) -> StructType:
        """The declared columns; files may name more."""
        return StructType.fromDDL(self.schema) if self.schema else StructType([])

    def bronze_columns(self) -> StructType:
        """Columns of the bronze table before any file came: declared ones, rescued texts, audit."""
        text = [StructField(n, StringType()) for n in (RESCUED, "_processdate", "_businessdate", "_businessmonth")]
        return StructType([*self.columns().fields, *text, StructField("_ingesttime", TimestampType()),
                           StructField("_sourcefile", StringType())])


FINANCE_SPECS = [
    TableSpec("cartoes", CARDS_SCHEMA, ("id",)),
    TableSpec("categorias", CATEGORIES_SCHEMA, ("id",)),
    TableSpec("orcamentos", BUDGETS_SCHEMA, ("subcategoria", "categoria", "_businessdate"),
              business_date="data"),
    TableSpec("contas", ACCOUNTS_SCHEMA, ("id",)),
    TableSpec("transacoes_pendentes", MOVEMENTS_SCHEMA, ("id", "tipo", "_businessmonth"),
              strategy="snapshot", business_date="data"),
    TableSpec("transacoes_efetivadas", MOVEMENTS_SCHEMA, ("id", "tipo", "_businessmonth"),
              business_date="data"),
]

SPECS_BY_NAME = {s.name: s for s in FINANCE_SPECS}

# Load identity taken from the extraction directory instead of the ingest time:
# two files of one extraction form one snapshot even if they were ingested in
# different micro-batches.
EXTRACTION_LOAD = r"regexp_extract(_sourcefile, 'extraction_ts=([^/]+)', 1)"


def silver(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """Dispatch a bronze DataFrame to its silver strategy."""
    if spec.strategy == "cdc":
        tie = [c for c in spec.tiebreak if c in bronze.columns]
        return scd1_upsert(bronze, list(spec.keys), list(spec.sequence_by), tie)
    if spec.strategy == "snapshot":
        load = spec.load_col if spec.load_col in bronze.columns else F.expr(spec.load_col)
        return latest_snapshot(bronze, load)
    raise ValueError(f"unknown load strategy {spec.strategy!r} for {spec.name}")
