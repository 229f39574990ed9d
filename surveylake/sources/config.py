"""The load configuration table (one row per PROCESSED table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
CONFIG_COLUMNS = ("DOMINIO", "TABLA", "ORIGEN", "DATASET_STAGE", "DATASET_DESTINO", "COLUMNAS",
                  "SQL_1", "PK", "TRUNCATE_TABLE", "NPK")
LOG_COLUMNS = ("DOMINIO", "TABLA", "TIPO_DE_PROCESO", "CANT_REGISTROS", "USUARIO", "FECHA_CARGA")
# ----------------------------------------------------------------------------


def load_config(config: DataFrame, domain: str) -> DataFrame:
    """``SELECT ... FROM config WHERE DOMINIO = d ORDER BY TABLA``.

    The result is small (one row per table of a domain); callers may
    ``collect()`` it to drive the per-table loop -- that is control data, not
    the data being loaded.
    """
    return config.where(F.col("DOMINIO") == F.lit(domain)).orderBy("TABLA")
