"""The 21-column lead CSV: scan, overwrite, append, and the row conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, iso_utc, truthy
from ..schemas import BASE_VERTICAL, CSV_COLUMNS, CSV_SCHEMA, DEFAULT_COUNTRY, VERTICALS

_READ = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "encoding": "UTF-8", "mode": "PERMISSIVE"}
_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "encoding": "UTF-8"}


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_leads_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, ``""`` for absent values; a missing path is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], CSV_SCHEMA)
    df = spark.read.options(**_READ).schema(CSV_SCHEMA).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in CSV_COLUMNS])


def export_row(df: DataFrame) -> DataFrame:
    """Typed leads to the text columns of the export."""
    def text(name: str):
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    def coordinate(name: str):
        return F.coalesce(F.format_string("%.6f", F.col(name)), F.lit("")).alias(name)

    special = {
        "email_validado": F.when(F.coalesce("email_validado", F.lit(False)), "true").otherwise("false").alias("email_validado"),
        "email_score": F.coalesce(F.col("email_score").cast("string"), F.lit("")).alias("email_score"),
        "fecha_enriquecimiento": iso_utc(F.coalesce("fecha_enriquecimiento", F.current_timestamp())).alias("fecha_enriquecimiento"),
        "pais": F.when(truthy("pais"), F.col("pais")).otherwise(DEFAULT_COUNTRY).alias("pais"),
        "latitud": F.when(F.col("latitud").isNull(), "").otherwise(F.format_string("%.6f", F.col("latitud"))).alias("latitud"),
        "longitud": F.when(F.col("longitud").isNull(), "").otherwise(F.format_string("%.6f", F.col("longitud"))).alias("longitud"),
        "metadata": F.when(F.coalesce(F.trim("metadata"), F.lit("")).isin("", "{}"), "").otherwise(F.col("metadata")).alias("metadata"),
    }
    return df.select(*[special.get(c, text(c)) for c in CSV_COLUMNS])


def write_leads_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export folder of CSV part files, each with the header."""
    export_row(df).write.mode(mode).options(**_WRITE).csv(path)


def append_leads_csv(df: DataFrame, path: str) -> None:
    """New part files next to the old ones; creates the folder when absent."""
    write_leads_csv(df, path, mode="append")


def minimal_lead(rows: DataFrame) -> DataFrame:
    """Export rows to typed minimal leads; rows without a name are dropped."""
    def text(name: str):
        return blank_to_null(name).alias(name)

    keep = [c for c in rows.columns if c not in CSV_COLUMNS]
    return rows.filter(truthy("nombre")).select(
        *keep, "nombre", text("vertical"), text("email"), text("telefono"), text("sitio_web"), text("partido"), text("localidad"),
        blank_to_null("latitud").try_cast("double").alias("latitud"),
        blank_to_null("longitud").try_cast("double").alias("longitud"),
        F.coalesce(F.col("email_validado") == "true", F.lit(False)).alias("email_validado"),
    )


def production_lead(rows: DataFrame) -> DataFrame:
    """Production rows to (nombre, vertical, partido): trimmed, unknown vertical -> the base one."""
    vertical = F.col("vertical") if "vertical" in rows.columns else F.lit(BASE_VERTICAL)
    keep = [c for c in rows.columns if c not in CSV_COLUMNS]
    nombre = F.trim(F.coalesce("nombre", F.lit("")))
    return rows.select(
        *keep, nombre.alias("nombre"),
        F.when(vertical.isin(*VERTICALS), vertical).otherwise(BASE_VERTICAL).alias("vertical"),
        blank_to_null(F.trim(F.coalesce("partido", F.lit("")))).alias("partido"),
    ).filter("nombre <> ''")


def preview(df: DataFrame, order_col: str = "ord", rows: int = 10) -> DataFrame:
    """First rows for display, a dash where a value is missing."""
    def dash(name: str):
        return F.when(truthy(name), F.col(name)).otherwise("—").alias(name)

    return df.orderBy(order_col).limit(rows).select(
        order_col, "nombre", dash("email"), dash("telefono"), dash("partido"),
        F.when(F.coalesce("email_validado", F.lit(False)), "✓").otherwise("·").alias("v_email"),
    )


def consolidate(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL of lot tables on the 21 columns: missing ones ``""``, extras ignored."""
    def fit(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c)
            for c in CSV_COLUMNS
        ])

    return reduce(DataFrame.unionByName, [fit(p) for p in parts])


def latest_export(files: DataFrame, name: str = "consolidated.csv") -> DataFrame:
    """Folder of the newest export among the part files of a listing (``path, modificationTime``)."""
    folder = F.regexp_extract("path", r"^(.*/" + name.replace(".", r"\.") + r")/part-[^/]*$", 1)
    parts = files.select(folder.alias("path"), "modificationTime").filter("path <> ''")
    return parts.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).filter("path is not null")


def read_latest_export(spark: SparkSession, root: str, name: str = "consolidated.csv") -> DataFrame:
    """The newest export folder of that name anywhere below ``root`` as lead rows; none -> empty.

    Only the file listing is read to choose it, not the files.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], CSV_SCHEMA)
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.csv")
        .load(root).select("path", "modificationTime")
    )
    found = latest_export(listing, name).first()
    return read_leads_csv(spark, found["path"]) if found else spark.createDataFrame([], CSV_SCHEMA)
