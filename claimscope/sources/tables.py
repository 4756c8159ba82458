"""Load the ten claims tables with their declared schema.

``load_tables`` reads Parquet (default) or CSV with a header from one folder,
one sub-path per table (``<dir>/<table>`` or ``<dir>/<table>.parquet``).
CSV and JSON are parsed by the declared schema, never inferred, and records that
do not fit it are reported (:mod:`claimscope.sources.text_records`).
Every other table goes through :func:`conform`: declared columns only, cast to the
declared type, CHAR columns right-trimmed (a blank-padded ``'TX '`` must equal
``'TX'``), and columns absent from the input filled with their declared
default (see :mod:`claimscope.sources.defaults`) or NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.functions.dates import in_window
from claimscope.params import Window
from claimscope.schema import TABLE_NAMES, TABLES, Table
from claimscope.sources.defaults import apply_defaults
from claimscope.sources.text_records import TEXT_FORMATS, as_delivered, loaded, rejected, text_records


#: Partition column of tables that are laid out by year (:mod:`claimscope.sources.layout`).
YEAR_COLUMN = "data_year"


class ClaimsTables(Mapping):
    """The ten claims tables by name, also reachable as attributes.

    ``yearly``: those that are laid out by year, with ``YEAR_COLUMN`` as a further column.
    """

    def __init__(self, frames: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None = None, yearly: Mapping[str, DataFrame] | None = None):
        missing = [n for n in TABLE_NAMES if n not in frames]
        if missing:
            raise KeyError(f"missing tables: {missing}")
        self._frames = {n: frames[n] for n in TABLE_NAMES}
        # the tables as delivered, before the cast to the declared schema (conformance checks)
        self.raw = dict(raw) if raw is not None else dict(self._frames)
        self._yearly = dict(yearly or {})
        self._shared: dict[tuple, DataFrame] = {}
        self._memo: dict[tuple, object] = {}

    def memo(self, key: tuple, measure: Callable[[], object]) -> object:
        """A measured fact about these tables (a size, a bound), computed once per table set."""
        if key not in self._memo:
            self._memo[key] = measure()
        return self._memo[key]

    def shared(self, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        """An intermediate derived from these tables, computed once and reused by later jobs.

        The first use writes it to the session's checkpoint folder (a plain
        Parquet table, so its lineage is cut and it survives executor loss);
        later jobs on the same tables read it instead of recomputing it.
        """
        if key not in self._shared:
            from claimscope.operators.materialize import materialize

            self._shared[key] = materialize(build(), "-".join(str(k) for k in key))
        return self._shared[key]

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["_frames"][name]
        except KeyError:
            raise AttributeError(name) from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def dated(self, name: str, day: str, w: Window) -> DataFrame:
        """Rows of ``name`` whose ``day`` lies in the window; of a table laid out by year, only the window's years are listed."""
        frame = self._frames[name]
        if name in self._yearly:
            year = F.col(YEAR_COLUMN).between(w.start.year, w.end.year)
            frame = self._yearly[name].where(year).drop(YEAR_COLUMN)
        return frame.where(in_window(day, w))

    def replace(self, **frames: DataFrame) -> "ClaimsTables":
        merged = dict(self._frames)
        merged.update(frames)
        yearly = {name: df for name, df in self._yearly.items() if name not in frames}
        return ClaimsTables(merged, {**self.raw, **frames}, yearly)

    def by_year(self, **yearly: DataFrame) -> "ClaimsTables":
        """These tables, some of them read from a layout by year (declared columns and ``YEAR_COLUMN``)."""
        plain = {name: df.drop(YEAR_COLUMN) for name, df in yearly.items()}
        return ClaimsTables({**self._frames, **plain}, self.raw, {**self._yearly, **yearly})


def conform(df: DataFrame, table: Table | str) -> DataFrame:
    """Project ``df`` onto the declared columns of ``table`` with declared types."""
    table = TABLES[table] if isinstance(table, str) else table
    df = apply_defaults(df, table)
    present = set(df.columns)
    out = []
    for c in table.cols:
        if c.name in present:
            col = F.col(c.name).cast(c.dtype)
            if c.char:
                col = F.rtrim(col)
        else:
            col = F.lit(None).cast(c.dtype)
        out.append(col.alias(c.name))
    return df.select(*out)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the Hadoop FileSystem of the session (local, HDFS, S3, ...)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def _table_path(spark: SparkSession, base: str, name: str, fmt: str) -> str:
    """``<base>/<name>.<fmt>`` if it exists, else ``<base>/<name>`` (a folder of part files)."""
    with_ext = f"{base.rstrip('/')}/{name}.{fmt}"
    return with_ext if _exists(spark, with_ext) else f"{base.rstrip('/')}/{name}"


def read_raw(spark: SparkSession, path: str, table: Table | str, fmt: str = "parquet") -> DataFrame:
    """One table as delivered.  Text formats: the declared columns, values still text."""
    table = TABLES[table] if isinstance(table, str) else table
    if fmt in TEXT_FORMATS:
        return as_delivered(text_records(spark, path, table, fmt), table)
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, path: str, table: Table | str, fmt: str = "parquet") -> DataFrame:
    """Read one table in its declared schema.  Text records that do not fit it are left out (see ``read_rejected``)."""
    table = TABLES[table] if isinstance(table, str) else table
    if fmt in TEXT_FORMATS:
        return loaded(text_records(spark, path, table, fmt), table)
    return conform(spark.read.format(fmt).load(path), table)


def read_rejected(spark: SparkSession, base: str, fmt: str) -> DataFrame:
    """Text records of all tables below ``base`` that were not loaded: table_name, reason, record."""
    parts = [rejected(text_records(spark, _table_path(spark, base, n, fmt), TABLES[n], fmt), TABLES[n]) for n in TABLE_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> ClaimsTables:
    """Load all ten tables from ``base`` in format ``fmt`` (parquet, csv, orc, json)."""
    frames, raw = {}, {}
    for name in TABLE_NAMES:
        path, table = _table_path(spark, base, name, fmt), TABLES[name]
        if fmt in TEXT_FORMATS:
            records = text_records(spark, path, table, fmt)
            frames[name], raw[name] = loaded(records, table), as_delivered(records, table)
        else:
            raw[name] = spark.read.format(fmt).load(path)
            frames[name] = conform(raw[name], table)
    return ClaimsTables(frames, raw)


def from_frames(frames: Mapping[str, DataFrame]) -> ClaimsTables:
    """Conform already-built DataFrames (tests, views) to the declared schema."""
    return ClaimsTables({n: conform(frames[n], n) for n in TABLE_NAMES}, frames)


def table_counts(tables: ClaimsTables) -> DataFrame:
    """One row per table: table_name, row_count (one aggregate per table, unioned)."""
    parts = [tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in TABLE_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
