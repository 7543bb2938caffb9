"""The plant dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from penstock.model import PLANT_TABLE

# Id, name, river, state, installed MW, head m, largest flow m3/s, base efficiency,
# base temperature C, base vibration mm/s, units
PLANTS = [
    ("itaipu", "Itaipu Binacional", "Rio Paraná", "PR", 14000.0, 118.4, 12600.0, 0.933, 52.0, 1.4, 20),
    ("belo_monte", "Belo Monte", "Rio Xingu", "PA", 11233.0, 87.0, 13000.0, 0.926, 56.0, 1.6, 24),
    ("tucurui", "Tucuruí", "Rio Tocantins", "PA", 8370.0, 72.0, 13800.0, 0.921, 58.0, 1.8, 25),
    ("jirau", "Jirau", "Rio Madeira", "RO", 3750.0, 18.5, 14000.0, 0.912, 55.0, 2.1, 50),
    ("santo_antonio", "Santo Antônio", "Rio Madeira", "RO", 3568.0, 15.5, 16000.0, 0.908, 55.0, 2.3, 50),
]
# The plants of event generation 2.0; state, installed power and units were not recorded.
PLANTS_V2 = [
    ("hidro-01", "Usina Serra Azul", "Rio Grande", None, None, 105.0, 520.0, 0.91, 58.0, 1.8, None),
    ("hidro-02", "Usina Vale Verde", "Rio Paranaíba", None, None, 82.0, 340.0, 0.89, 55.0, 1.5, None),
    ("hidro-03", "Usina Pedra Clara", "Rio São Francisco", None, None, 128.0, 710.0, 0.92, 60.0, 2.0, None),
    ("hidro-04", "Usina Horizonte", "Rio Tocantins", None, None, 97.0, 460.0, 0.90, 57.0, 1.7, None),
]


def plant_dimension(spark: SparkSession, rows: list[tuple] = PLANTS) -> DataFrame:
    """A few plants as a local relation, whose size Spark knows and broadcasts on its own."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    typed = ", ".join(
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in PLANT_TABLE
    )
    names = ", ".join(f"`{n}`" for n in PLANT_TABLE.names)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS p({names})")


def read_plants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLANT_TABLE).parquet(path)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)
