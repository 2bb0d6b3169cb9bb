"""Connection-record scans: KDD / NSL layouts, generic CSV, JSON records,
format auto-detection, and rejected-row quarantine.

Scans declare an explicit schema (no inference pass over the data); bad lines
are kept in ``_corrupt_record`` (PERMISSIVE mode) and split off by
``quarantine`` rather than failing the job or silently vanishing.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.expressions import derive_label
from ..schemas import CORRUPT, KDD_NAMES, kdd_schema, nan_to_null, nsl_schema


class ScanError(ValueError):
    pass


def first_cells(spark: SparkSession, path: str) -> list[str]:
    """Cells of the first line (reads one line, not the file)."""
    first = spark.read.text(path).limit(1).collect()
    return next(csv.reader([first[0][0]]), []) if first else []


def looks_like_header(spark: SparkSession, path: str, names=KDD_NAMES) -> bool:
    """Half or more of the first line's cells are known column names, in any order."""
    cells = {c.strip() for c in first_cells(spark, path)}
    return 2 * len(cells & set(names)) >= len(cells) > 0


def header_schema(cells: list[str], known: T.StructType) -> T.StructType:
    """Schema of a file with this header line: known columns with their types
    wherever they stand, others as text, and the column for bad lines."""
    types = {f.name: f.dataType for f in known.fields}
    names = [c.strip() for c in cells]
    twice = {c for c in names if names.count(c) > 1}
    if twice:
        raise ScanError(f"column names repeat in the header: {sorted(twice)}")
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in names]
                        + [T.StructField(CORRUPT, T.StringType())])


def _csv(spark, path, schema, header: bool) -> DataFrame:
    # which lines are bad must not depend on the columns that a query reads
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _finish(df: DataFrame, drop=()) -> DataFrame:
    df = nan_to_null(df.drop(*drop))
    return df.withColumn("is_attack", derive_label("attack_type"))


def _by_header(spark, path, known: T.StructType) -> DataFrame:
    """A file with a header line: its known columns in the layout's order. A line
    with too few or too many cells, or a value that its type cannot hold, keeps
    ``_corrupt_record`` and never ends the job. Every file of a folder must have
    the header of the first."""
    schema = header_schema(first_cells(spark, path), known)
    df = _csv(spark, path, schema, True)
    return df.select(*[f"`{f.name}`" for f in known.fields if f.name in df.columns], CORRUPT)


def scan_kdd(spark: SparkSession, path: str, header: bool | None = None) -> DataFrame:
    """42 named columns (+ header detection) -> + is_attack; bad rows keep
    ``_corrupt_record``. With a header, columns are read by name in any order and
    columns that the layout does not know (as a trailing label) are left out."""
    if header is None:
        header = looks_like_header(spark, path)
    if header:
        return _finish(_by_header(spark, path, kdd_schema()))
    return _finish(_csv(spark, path, kdd_schema(with_corrupt=True), False))


def scan_nsl(spark: SparkSession, train_path: str, test_path: str | None = None):
    """43 columns; ``difficulty_level`` is dropped. Returns (train, test); bad rows
    of either keep ``_corrupt_record``."""
    def one(path):
        if looks_like_header(spark, path):
            df = _by_header(spark, path, nsl_schema())
        else:
            df = _csv(spark, path, nsl_schema(with_corrupt=True), False)
        return _finish(df, drop=("difficulty_level",))

    return one(train_path), one(test_path) if test_path else None


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             **options) -> DataFrame:
    """Generic CSV with pass-through options (``inferSchema`` only when asked).
    With ``schema`` and ``_corrupt_record`` among its columns, bad lines are kept
    there."""
    r = spark.read.options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return nan_to_null(r.csv(path))


SAMPLE_ROWS = 10_000


def sampled_schema(spark: SparkSession, path: str, rows: int = SAMPLE_ROWS) -> T.StructType:
    """Column names of the header line, types inferred from the first ``rows`` lines
    only. Later values that a type cannot hold are kept as bad lines by the scan,
    so the sample decides types, never which rows are read."""
    head = spark.read.text(path).limit(rows + 1)
    lines = [r[0] for r in head.collect()]
    found = spark.read.option("header", True).option("inferSchema", True).csv(
        spark.sparkContext.parallelize(lines, 1)).schema if lines else T.StructType()
    return T.StructType([*found.fields, T.StructField(CORRUPT, T.StringType())])


def scan_json_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per connection (many records), KDD schema by default."""
    s = schema or kdd_schema(with_corrupt=True)
    df = spark.read.schema(s).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return _finish(df)


def scan_auto(spark: SparkSession, path: str, dataset_type: str = "auto") -> DataFrame:
    """Pick the layout from the file or folder name ('nsl' before 'kdd'; parent
    folders do not count), else generic CSV with a header; fail on
    empty input; derive the label when only the type exists."""
    kind = dataset_type
    if kind == "auto":
        low = path.rstrip("/").rsplit("/", 1)[-1].lower()
        kind = "nsl" if "nsl" in low else "kdd" if "kdd" in low else "csv"
    if kind == "nsl":
        df, _ = scan_nsl(spark, path)
    elif kind == "kdd":
        df = scan_kdd(spark, path)
    else:
        df = scan_csv(spark, path, sampled_schema(spark, path), header=True, mode="PERMISSIVE")
    if df.isEmpty():
        raise ScanError(f"no rows in {path}")
    if "is_attack" not in df.columns:
        if "attack_type" not in df.columns:
            raise ScanError("neither is_attack nor attack_type present")
        df = df.withColumn("is_attack", derive_label("attack_type"))
    return df


def quarantine(df: DataFrame, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``error``) — the per-chunk skip of the
    reference becomes a per-row split that keeps every rejected line.

    Spark refuses queries on a raw CSV/JSON scan that reference only the
    corrupt-record column (e.g. counting rejected rows), so the parsed scan is
    saved once (reliable checkpoint in the shared folder) and both outputs
    read that. A single aggregate over the raw scan (as ``scan_chunked``'s
    report does) needs no save."""
    if CORRUPT not in df.columns:
        return df, df.limit(0).withColumn("error", F.lit(None).cast("string"))
    if materialize:
        from ..session import cut_lineage
        df = cut_lineage(df)
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # rejected rows keep every parsed field next to the raw line (a scan may
    # not reference the corrupt-record column alone)
    bad = df.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw") \
        .withColumn("error", F.lit("malformed record"))
    return good, bad


def scan_chunked(spark: SparkSession, path: str, header: bool | None = None):
    """Large-file mode: a partitioned scan (partitions replace chunks) plus the
    quarantine of malformed lines."""
    return quarantine(scan_kdd(spark, path, header))
