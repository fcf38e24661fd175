"""Scans of landed files with declared schemas.

All scans are one ``spark.read`` over a glob (never a Python loop over
files), so listing and parsing run as parallel tasks and partition pruning
comes from the path pattern.  The period of every row comes from its own
file path (``_metadata.file_path``), so no temporary table per period is
needed.  Registry and debt files hold quoted line breaks; they are split all the same
(``quoted_csv``), so a file of gigabytes is read by many tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.paths import file_path, period_of_path, segment_after
from .quoted_csv import read_quoted_csv

REGISTRY = {"estabelecimentos": (schemas.ESTABLISHMENTS, "*.ESTABELE"),
            "empresas": (schemas.COMPANIES, "*.EMPRECSV")}


def _glob(base: str, periods: list[str] | None) -> str:
    base = base.rstrip("/")
    if not periods:
        return f"{base}/*"
    return f"{base}/{{{','.join(f'{p},ano_mes={p}' for p in periods)}}}"


def read_registry(spark: SparkSession, base: str, data_type: str, periods: list[str] | None = None,
                  file_glob: str | None = None, encoding: str = "ISO-8859-1",
                  corrupt_column: str | None = None) -> DataFrame:
    """Headerless ``;`` CSV, ISO-8859-1, quoted newlines and doubled quotes,
    all columns STRING; ``ano_mes`` from the folder of each file.

    Short rows read as NULL-padded and extra fields are ignored (jagged rows are
    accepted, as the source loader does); ``corrupt_column`` names a column that keeps
    the raw text of such rows (NULL for the others); ``periods`` prunes by path.
    """
    schema, default_glob = REGISTRY[data_type]
    df = read_quoted_csv(spark, _glob(base, periods), schema, ";", encoding, file_glob=file_glob or default_glob,
                         corrupt_column=corrupt_column)
    return _by_file(df, _glob(base, periods), file_glob or default_glob, {"ano_mes": period_of_path("_path")})


def _by_file(df: DataFrame, path: str, file_glob: str, values: dict[str, F.Column]) -> DataFrame:
    """``df`` with ``values`` (expressions of ``_path``) in place of ``_path``.

    They are worked out once for each file of the listing (no content is read) and looked up by the rows; as an
    expression of a row, the patterns are matched several times for each, wherever the value is used.
    """
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", file_glob).load(path)
    known = files.select(file_path().alias("_path")).distinct().select(
        F.col("_path").alias("_file"), *[v.alias(c) for c, v in values.items()])
    return df.join(F.broadcast(known), F.col("_path") == F.col("_file"), "left").drop("_path", "_file")


def bad_registry_rows(df: DataFrame) -> F.Column:
    """A row the load counts as bad: its 8-digit company key is missing or malformed."""
    return ~F.coalesce(F.col("cnpj_basico").rlike(r"^\d{8}$"), F.lit(False))


def bad_debt_rows(df: DataFrame) -> F.Column:
    """A debt row the load counts as bad: no debtor number, or an amount that is not a number."""
    amount = F.regexp_replace("valor_consolidado", ",", ".").try_cast("double")
    return (F.regexp_replace("cpf_cnpj", r"\D", "") == "") | F.col("cpf_cnpj").isNull() | amount.isNull()


def _either(name: str, key: str | None) -> str:
    """Glob matching a folder named ``name`` or ``<key>=<name>`` (Spark's partition layout)."""
    return f"{{{name},{key}={name}}}" if key else name


def read_debts(spark: SparkSession, base: str, data_type: str, years: list[int] | None = None,
               file_glob: str = "*.csv", encoding: str = "UTF-8") -> DataFrame:
    """Headered ``;`` CSV of one debt type across years and quarters.

    One brace glob covers every year / quarter (a missing folder is simply not
    matched; a list of paths would fail on it).  Year and quarter come from the
    path, the only place they live.  Folders may be plain (``2024/1trimestre/FGTS``)
    or ``key=value`` (``ano=2024/trimestre=1trimestre/tipo=FGTS``).
    """
    if years:
        year_glob = "{" + ",".join(f"{y},ano={y}" for y in years) + "}"
    else:
        year_glob = "*"
    path = f"{base.rstrip('/')}/{year_glob}/*trimestre/{_either(data_type, 'tipo')}"
    df = read_quoted_csv(spark, path, schemas.DEBTS, ";", encoding, header=True, file_glob=file_glob)
    p = F.col("_path")
    return _by_file(df, path, file_glob, {
        "ano": segment_after(p, r"/(?:[^/=]+=)?(\d{4})/(?:[^/=]+=)?\d+trimestre/").cast("int"),
        "trimestre": segment_after(p, r"/(?:[^/=]+=)?(\d+)trimestre/").cast("int"),
    }).withColumn("tipo", F.lit(data_type))


def available_periods(spark: SparkSession, base: str, file_glob: str = "*") -> DataFrame:
    """Distinct ``yyyy-MM`` periods with a matching file under ``base`` (listing only: the
    ``binaryFile`` source reads no file content when only ``path`` is selected)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", file_glob).load(base.rstrip("/")).select("path"))
    return (files.select(period_of_path(F.col("path")).alias("ano_mes")).where(F.col("ano_mes").isNotNull())
            .distinct().orderBy("ano_mes"))


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.PANEL,
                   index_columns=("Unnamed: 0", "_c0", "")) -> DataFrame:
    """Headered panel CSV.  Columns are matched by name and cast to the declared
    types (lenient: unparsable -> NULL); a leading index column is dropped; declared
    columns absent from the file come back as NULL.  Codes stay strings (no leading-zero loss)."""
    # no quoted newline stands in a panel file, so files are split among tasks
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    raw = raw.drop(*[c for c in index_columns if c in raw.columns])
    cols = []
    for f in schema.fields:
        if f.name in raw.columns:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def read_tax_regime(spark: SparkSession, base: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Headered tax-regime files, one folder per regime; regime from the folder name."""
    df = (spark.read.schema(schemas.TAX_REGIME).option("header", "true").option("sep", sep)
          .option("encoding", encoding).option("mode", "PERMISSIVE").csv(f"{base.rstrip('/')}/*"))
    return df.withColumn("regime", segment_after(file_path(), r"/(?:[^/=]+=)?([^/]+)/[^/]+$"))


def land_csv(df: DataFrame, path: str, partition_by: str | list[str] | None = "ano_mes",
             encoding: str = "ISO-8859-1", header: bool = False, sep: str = ";",
             rows_per_file: int = 500_000) -> str:
    """Write a frame in the landed-file dialect (``;``, quoted, chosen encoding).

    Rows are rebalanced by partition value, which lets AQE split a hot period over
    several writer tasks and join small ones; ``rows_per_file`` bounds a file.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if parts:
        df = df.hint("rebalance", *[F.col(c) for c in parts])
    w = (df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower())
         .option("encoding", encoding).option("quoteAll", "false").option("escape", '"')
         .option("maxRecordsPerFile", rows_per_file))
    if parts:
        w = w.partitionBy(*parts)
    w.csv(path)
    return path


def land_named(df: DataFrame, path: str, name_col: str) -> None:
    """One CSV file ``<value>.csv`` in ``path`` for each value of ``name_col``, in place of one of that name.

    Files of a landing have names of their own, so a period's file can land again; a file is one task's work.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.repartition(F.col(name_col)).write.partitionBy(name_col).csv(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    top, target = hadoop.Path(staged), hadoop.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for folder in fs.listStatus(top):
        name = folder.getPath().getName()
        if "=" not in name:
            continue
        final = hadoop.Path(target, f"{name.split('=', 1)[1]}.csv")
        files = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise ValueError(f"{name} has {len(files)} files")
        fs.delete(final, False)
        fs.rename(files[0], final)
