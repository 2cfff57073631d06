"""Readers and writers (SRC1-SRC8, SNK1-SNK3).

Thin, explicit wrappers over ``DataFrameReader``/``DataFrameWriter`` that fix
the options the recipes rely on (header, type inference, NULL marker) and add
the two things the plain reader lacks: blank text as NULL for formats without
a ``nullValue`` option, and a guarded single-file export.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_local(spark: SparkSession, data, schema=None) -> DataFrame:
    """SRC1: a local frame (pandas, list of rows/tuples) as a distributed table.

    Meant for fixtures and parameter lists; large data should be read from
    files instead of passing through the driver.
    """
    return spark.createDataFrame(data, schema=schema)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema=None) -> DataFrame:
    """SRC2/SRC3: JSON lines, one or several paths read as one table.

    With several files the inferred schema is the union of the fields; give
    ``schema`` to skip the inference pass on large inputs.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if isinstance(paths, str):
        return reader.json(paths)
    return reader.json(list(paths))


def read_csv(spark: SparkSession, path: str | Sequence[str], header: bool = True,
             infer_schema: bool = True, null_value: str | None = "NA",
             sep: str = ",", schema=None) -> DataFrame:
    """SRC4: CSV with header, type inference and a NULL marker (``na.strings``).

    Type inference reads the input once more before the real scan; for large
    inputs pass ``schema`` (inference is then skipped).
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_avro(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC5: a folder of Avro files.  Needs the ``spark-avro`` package."""
    try:
        return spark.read.format("avro").load(path if isinstance(path, str) else list(path))
    except Exception as exc:  # AnalysisException when the data source is absent
        if "avro" in str(exc).lower() and ("not find" in str(exc).lower()
                                           or "failed to find" in str(exc).lower()):
            raise RuntimeError(
                "Avro data source not on the class path; start Spark with "
                "--packages org.apache.spark:spark-avro_2.13:<spark version>") from exc
        raise


def blank_as_null(df: DataFrame, cols: Iterable[str] | None = None,
                  markers: Sequence[str] = ("",)) -> DataFrame:
    """SRC6: turn chosen text markers (default the empty string) into NULL.

    Applies to string columns only (as ``na.strings`` does); whitespace around
    the text is ignored.  Formats without a ``nullValue`` option (Avro,
    Parquet, JSON) use this after the read.
    """
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = [c for c in (cols if cols is not None else df.columns) if c in string_cols]
    marks = [F.lit(m) for m in markers]
    return df.withColumns({
        c: F.when(F.trim(F.col(c)).isin(*marks), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in targets
    })


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """SRC7: LIBSVM text into ``(label double, features vector)``."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC8: Parquet (filters and projections reach the scan)."""
    return spark.read.parquet(*paths)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                **options) -> None:
    """SNK1/SNK2: write in any built-in format, replacing by default."""
    writer = df.write.mode(mode).format(fmt)
    for k, v in options.items():
        writer = writer.option(k, v)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: Sequence[str] | None = None, **options) -> None:
    """SNK1: replace a table by ``df`` in one step, also by a result read from the table itself.

    The new table is written beside the old one and takes its name when it is
    whole; only then is the old one deleted.  If the job fails, the old table
    stays as it was.  Both moves are renames within one folder of the table's
    own file system; between them the name is free for a moment, and a reader
    of that moment finds no table, never a mixed one.
    """
    spark = df.sparkSession
    jvm, mark = spark.sparkContext._jvm, uuid.uuid4().hex
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fresh, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{kind}-{mark}")
                  for kind in ("new", "old"))
    try:
        write_table(df, fresh.toString(), fmt, "errorifexists", partition_by, **options)
    except Exception:
        fs.delete(fresh, True)
        raise
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        fs.delete(fresh, True)
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(fresh, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"the new table cannot take the name {path}")
    if replaced:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_partitioned(df: DataFrame, path: str, files: int, fmt: str = "csv",
                      mode: str = "overwrite", **options) -> None:
    """SNK3/ACT8: export as a given number of files, written in parallel.

    ``files=1`` is the recipe's single file; one task then writes everything,
    so ask for it only when the result is known to be small.
    """
    write_table(df.repartition(files), path, fmt=fmt, mode=mode, **options)
