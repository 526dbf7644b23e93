"""Table loading, timestamp coercion, inventory and zones."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curata.functions.nulls import PANDAS_NA_TOKENS, na_to_null
from curata.functions.scalars import parse_ts
from curata.sources import fs

# The zones of the lakehouse layout.
ZONES = ("raw", "quarantine", "curated", "staging", "intermediate", "marts", "snapshots", "monitoring")


def zone_path(base: str, zone: str, table: str) -> str:
    """``<base>/<zone>/<table>``."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; expected one of {ZONES}")
    return f"{base.rstrip('/')}/{zone}/{table}"


#: Columns that ``parsed_csv`` adds.
FILE, REASON, RECORD, BAD = "_file", "_reason", "_record", "_bad"


def parsed_csv(spark: SparkSession, path: str, schema: StructType | None = None, na_tokens: Iterable[str] = PANDAS_NA_TOKENS,
               multi_line: bool = True) -> DataFrame:
    """Every record of CSV files with a header row, and what was wrong with it.

    Columns are taken by their name in the header, in any order; all files
    must have the same header. Quotes follow RFC 4180; with ``multi_line``
    line breaks may stand in quotes, so a file isn't split (without it, it
    is). Text columns are read as strings and pandas' NA tokens become null
    (N17); typed columns are cast so that a bad cell is null, and a whole
    number written as ``1985.0`` is an integer. Without a schema every column
    stays text; a column that the header lacks is an error.

    Added: ``_file``; ``_reason`` of a record with the wrong number of cells
    ("short record", "surplus cells"; else null) and its text ``_record``;
    ``_bad``, a map of the columns whose text was no value of their type.
    """
    read = spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    header = read.csv(path).columns
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in header]
        if missing:
            raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    text = StructType([StructField(c, StringType()) for c in [*header, RECORD]])
    raw = read.option("enforceSchema", False).option("columnNameOfCorruptRecord", RECORD).schema(text).csv(path).select("*", F.col("_metadata.file_path").alias(FILE))
    fields = schema.fields if schema is not None else [StructField(c, StringType()) for c in header]
    tokens = list(na_tokens)
    cleaned = raw.select(*[na_to_null(f"`{f.name}`", tokens).alias(f.name) for f in fields], FILE, RECORD)
    out, bad = [], []
    for f in fields:
        x = F.col(f"`{f.name}`")
        value = _typed(f.name, f.dataType.simpleString())
        out.append(value.alias(f.name))
        if f.dataType.simpleString() != "string":
            bad.append(F.when(x.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("key"), x.alias("value"))))
    # cells are counted between the separators that stand outside quotes
    cells = F.length(F.regexp_replace(F.regexp_replace(RECORD, r'"(?:[^"]|"")*"', ""), "[^,]", "")) + 1
    reason = F.when(F.col(RECORD).isNotNull(), F.when(cells > len(header), "surplus cells").otherwise("short record"))
    found = F.filter(F.array(*bad), lambda e: e.isNotNull()) if bad else F.array()
    cell_map = F.map_from_entries(found) if bad else F.lit(None).cast("map<string,string>")
    return cleaned.select(*out, F.col(FILE), reason.alias(REASON), F.col(RECORD),
                          F.when(F.col(RECORD).isNull() & (F.size(found) > 0), cell_map).alias(BAD))


def _typed(name: str, t: str) -> Column:
    """The text of a column as a value of type ``t``, null if it is none."""
    x = F.col(f"`{name}`")
    if t == "string":
        return x
    if t == "timestamp":
        return parse_ts(x)
    if t == "boolean":
        low = F.lower(x)
        return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)
    if t in ("tinyint", "smallint", "int", "bigint"):
        number = f"try_cast(`{name}` as double)"
        return F.expr(f"coalesce(try_cast(`{name}` as {t}), if({number} = floor({number}), try_cast({number} as {t}), null))")
    return F.expr(f"try_cast(`{name}` as {t})")


def read_csv_table(spark: SparkSession, path: str, schema: StructType | None = None,
                   na_tokens: Iterable[str] = PANDAS_NA_TOKENS, multi_line: bool = True) -> DataFrame:
    """The well-formed records of ``parsed_csv``; use ``land_csv`` to keep and count the others."""
    rows = parsed_csv(spark, path, schema, na_tokens, multi_line)
    return rows.where(F.col(REASON).isNull()).drop(FILE, REASON, RECORD, BAD)


def land_csv(spark: SparkSession, path: str, schema: StructType, base: str, table: str, run_id: str, multi_line: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """Write one table's records to the staging zone and count what is wrong with them in the same pass.

    Returns the well-formed rows, read back, and the counts: ``rows_read``,
    ``rows_rejected`` and ``bad <column>`` for every typed column (cells that
    hold text but no value of their type; the row stays, with a null). So rows
    read = rows kept + rows rejected. The quarantine zone gets
    ``<table>_rejected`` (file, reason, record) and ``<table>_cells`` (file,
    column, text), one folder per run.
    """
    rows = parsed_csv(spark, path, schema, multi_line=multi_line).withColumn("_kept", F.col(REASON).isNull())
    typed = [f.name for f in schema.fields if f.dataType.simpleString() != "string"]
    counted = Observation(f"land {table}")
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows_read"), F.count_if(~F.col("_kept")).alias("rows_rejected"),
                        *[F.count_if(F.coalesce(F.map_contains_key(BAD, c), F.lit(False))).alias(f"bad {c}") for c in typed])
    staged = f"{zone_path(base, 'staging', table)}/run_id={run_id}"
    rows.write.mode("overwrite").partitionBy("_kept").parquet(staged)
    back = spark.read.schema(StructType([*rows.schema.fields])).parquet(staged)
    kept = back.where("_kept")
    back.where("not _kept").select(FILE, REASON, RECORD).write.mode("overwrite").parquet(f"{zone_path(base, 'quarantine', f'{table}_rejected')}/run_id={run_id}")
    kept.where(F.col(BAD).isNotNull()).select(FILE, F.explode(BAD).alias("column", "text")).write.mode("overwrite").parquet(
        f"{zone_path(base, 'quarantine', f'{table}_cells')}/run_id={run_id}")
    return kept.drop(FILE, REASON, RECORD, BAD, "_kept"), {k: int(v) for k, v in counted.get.items()}


def coerce_timestamps(df: DataFrame, cols: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """S3: parse text columns to UTC timestamps; bad text -> null.

    Returns the converted frame and a one-row frame with the number of
    failures per column (cells that were set before and are null after).
    """
    cols = list(cols)
    out = df.select(*[parse_ts(c).alias(c) if c in cols else F.col(c) for c in df.columns])
    fails = df.agg(*[
        F.count_if(F.col(c).isNotNull() & parse_ts(c).isNull()).cast("long").alias(c) for c in cols
    ]) if cols else None
    return out, fails


def locate_tables(spark: SparkSession, names: Iterable[str], candidates: Iterable[str], override: str | None = None,
                  ext: str = ".csv") -> str:
    """The first folder holding every named table; ``override`` (e.g. a path from the caller's
    environment) is tried before the candidates. Fails naming what was searched."""
    names = list(names)
    tried = ([override] if override else []) + list(candidates)
    for folder in tried:
        if all(fs.exists(spark, f"{folder.rstrip('/')}/{n}{ext}") for n in names):
            return folder
    raise FileNotFoundError(f"no folder holds all of {', '.join(n + ext for n in names)}; searched: {', '.join(tried)}")


def load_tables(spark: SparkSession, base_dir: str, names: Iterable[str], fmt: str = "parquet",
                schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Load every named table from ``base_dir``; fail listing all missing ones."""
    names = list(names)
    ext = {"parquet": ".parquet", "csv": ".csv"}[fmt]
    missing = [n for n in names if not fs.exists(spark, f"{base_dir.rstrip('/')}/{n}{ext}")]
    if missing:
        raise FileNotFoundError(f"missing tables in {base_dir}: {', '.join(missing)}")
    out = {}
    for n in names:
        p = f"{base_dir.rstrip('/')}/{n}{ext}"
        if fmt == "parquet":
            st = (schemas or {}).get(n)
            out[n] = (spark.read.schema(st) if st is not None else spark.read).parquet(p)
        else:
            out[n] = read_csv_table(spark, p, (schemas or {}).get(n))
    return out


def inventory(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """Rows, columns, expected rows and delta per table (one row per table)."""
    parts = []
    for name, df in tables.items():
        exp = (expected or {}).get(name)
        parts.append(df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
            F.lit(exp).cast("long").alias("rows_expected"),
            (F.col("rows") - F.lit(exp)).cast("long").alias("delta_vs_expected")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Iterable[str] = ()) -> None:
    """Write a result table as parquet (default refuses to overwrite)."""
    w = df.write.mode(mode)
    pb = list(partition_by)
    if pb:
        w = w.partitionBy(*pb)
    w.parquet(path)
