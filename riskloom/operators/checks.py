"""Column presence, request contract, duplicates, infinities, code books."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Required request columns in model order.
REQUEST_COLUMNS = (
    "status",
    "duration",
    "credit_history",
    "purpose",
    "amount",
    "savings",
    "employment_duration",
    "installment_rate",
    "personal_status_sex",
    "other_debtors",
    "present_residence",
    "property",
    "age",
    "other_installment_plans",
    "housing",
    "number_credits",
    "job",
    "people_liable",
    "telephone",
    "foreign_worker",
)

# Allowed ranges of the free-entry request columns (None = no upper limit).
REQUEST_RANGES: dict[str, tuple[float, float | None]] = {
    "duration": (4.0, 72.0),
    "age": (18.0, 75.0),
    "amount": (0.0, None),
    "installment_rate": (1.0, 4.0),
    "present_residence": (1.0, 4.0),
    "number_credits": (1.0, 4.0),
    "people_liable": (1.0, 4.0),
}

# Code book of the 13 coded request columns.
CODE_LABELS: dict[str, dict[float, str]] = {
    "status": {
        1.0: "Sin cuenta corriente",
        2.0: "Cuenta con saldo bajo (< 0)",
        3.0: "Cuenta con saldo medio (0-200 DM)",
        4.0: "Cuenta con saldo alto (> 200 DM)",
    },
    "credit_history": {
        0.0: "Crédito pagado debidamente hasta ahora",
        1.0: "Créditos pagados debidamente en este banco",
        2.0: "Retrasos en pagos en el pasado",
        3.0: "Cuenta crítica / otros créditos existentes",
        4.0: "Todos los créditos en este banco pagados",
    },
    "purpose": {
        0.0: "Carro (nuevo)",
        1.0: "Carro (usado)",
        2.0: "Muebles/Equipo",
        3.0: "Radio/TV",
        4.0: "Electrodomésticos",
        5.0: "Reparaciones",
        6.0: "Educación",
        7.0: "Vacaciones",
        8.0: "Capacitación",
        9.0: "Negocios",
        10.0: "Otros",
    },
    "savings": {
        1.0: "Desconocido / Sin ahorros",
        2.0: "< 100 DM",
        3.0: "100 - 500 DM",
        4.0: "500 - 1000 DM",
        5.0: "> 1000 DM",
    },
    "employment_duration": {
        1.0: "Desempleado",
        2.0: "< 1 año",
        3.0: "1 - 4 años",
        4.0: "4 - 7 años",
        5.0: "> 7 años",
    },
    "personal_status_sex": {
        1.0: "Hombre: Divorciado/Separado",
        2.0: "Mujer: Divorciada/Separada/Casada",
        3.0: "Hombre: Soltero",
        4.0: "Hombre: Casado/Viudo",
        5.0: "Mujer: Soltera",
    },
    "other_debtors": {
        1.0: "Ninguno",
        2.0: "Co-solicitante",
        3.0: "Garante",
    },
    "property": {
        1.0: "Bienes raíces (Casa/Terreno)",
        2.0: "Seguro de vida / Ahorros",
        3.0: "Carro u otro",
        4.0: "Desconocido / Sin propiedad",
    },
    "other_installment_plans": {
        1.0: "Bancarios",
        2.0: "Tiendas",
        3.0: "Ninguno",
    },
    "housing": {
        1.0: "Alquiler",
        2.0: "Vivienda propia",
        3.0: "Gratis",
    },
    "job": {
        1.0: "No calificado - no residente",
        2.0: "No calificado - residente",
        3.0: "Calificado / Obrero",
        4.0: "Gerente / Ejecutivo / Autónomo",
    },
    "telephone": {
        1.0: "No",
        2.0: "Sí (registrado)",
    },
    "foreign_worker": {
        1.0: "Sí",
        2.0: "No",
    },
}


def missing_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One finding per expected column: is it there, and with which type."""
    found = dict(df.dtypes)
    rows = [(c, c in found, found.get(c)) for c in expected]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean, type string")


def contract_rules(columns: Sequence[str] = REQUEST_COLUMNS) -> dict[str, Column]:
    """Rule name to the condition that breaks it."""
    rules: dict[str, Column] = {}
    for c in columns:
        value = F.col(c).try_cast("double")
        rules[f"{c}:missing"] = value.isNull() | F.isnan(value)
        if c in REQUEST_RANGES:
            low, high = REQUEST_RANGES[c]
            bad = value < F.lit(low)
            rules[f"{c}:range"] = bad if high is None else bad | (value > F.lit(high))
        if c in CODE_LABELS:
            rules[f"{c}:code"] = ~value.isin(list(CODE_LABELS[c]))
    return rules


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations`` (broken rule names) and ``accepted``; one projection, no shuffle."""
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return df.withColumn("violations", found).withColumn("accepted", F.size("violations") == 0)


def check_requests(df: DataFrame) -> DataFrame:
    """Contract check of a table of scoring requests; missing columns are an error."""
    absent = [c for c in REQUEST_COLUMNS if c not in df.columns]
    if absent:
        raise ValueError(f"request table lacks columns: {absent}")
    return check_rules(df, contract_rules())


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests in model order, and quarantined ones with their broken rules."""
    checked = check_requests(df)
    others = [c for c in df.columns if c not in REQUEST_COLUMNS]
    good = checked.where("accepted").select(*others, *[F.col(c).cast("double").alias(c) for c in REQUEST_COLUMNS])
    return good, checked.where("NOT accepted").drop("accepted")


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def code_book(spark) -> DataFrame:
    """The code book as a table (column, code, label); its size is fixed."""
    rows = [(column, code, label) for column, labels in CODE_LABELS.items() for code, label in labels.items()]
    return spark.createDataFrame(rows, "column string, code double, label string")


def decode(df: DataFrame, column: str, book: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """Add the label of a coded column.

    Without ``book`` the fixed code book becomes a map literal in the projection. With ``book`` (columns
    ``code``, ``label``) it is a left join whose strategy Catalyst picks from the book's size.
    """
    name = name or f"{column}_label"
    if book is not None:
        renamed = book.select(F.col("code").alias("_code"), F.col("label").alias(name))
        return df.join(renamed, F.col(column) == F.col("_code"), "left").drop("_code")
    pairs = [F.lit(x) for pair in CODE_LABELS[column].items() for x in pair]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(column).cast("double")))


def encode_labels(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """The way back: label text to code."""
    pairs = [F.lit(x) for code, label in CODE_LABELS[column].items() for x in (label, code)]
    return df.withColumn(name or f"{column}_code", F.try_element_at(F.create_map(*pairs), F.col(column)))


def quality_summary(df: DataFrame) -> DataFrame:
    """Rows, repeated rows and infinite numbers of a table.

    Rows are compared by a pair of 64-bit digests, so that the shuffle carries 16 bytes per row.
    """
    doubles = [n for n, t in df.dtypes if t in ("double", "float")]
    inf = F.lit(0)
    for c in doubles:
        inf = inf + F.coalesce((F.abs(F.col(c)) == F.lit(float("inf"))).cast("int"), F.lit(0))
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in df.columns])
    digests = df.select(
        F.xxhash64(*df.columns).alias("h1"),
        F.xxhash64(F.lit(7), nulls, *reversed(df.columns)).alias("h2"),
        inf.alias("inf"),
    )
    groups = digests.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum("inf").alias("inf"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("inf"), F.lit(0)).cast("bigint").alias("infinite_values"),
    )
