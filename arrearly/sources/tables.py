"""The five input tables of a collections run, and where they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearly import schemas

TABLE_NAMES = ("loan_master", "installments", "calls", "bucket_flow", "contacts")


# Stored type -> type it may be read as without losing anything.
_WIDER = {
    (T.ByteType, T.IntegerType), (T.ShortType, T.IntegerType), (T.ByteType, T.LongType), (T.ShortType, T.LongType),
    (T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.TimestampType, T.TimestampNTZType), (T.DateType, T.TimestampNTZType),
}


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of table ``name`` in their fixed order and types. Money may be
    double or decimal and stays as it is; narrower types are widened; a missing column or
    another type is an error that names it."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schemas.SCHEMAS[name].fields:
        if f.name not in have:
            raise TypeError(f"{name}: no column {f.name}")
        t = have[f.name]
        if t == f.dataType or (f.name in schemas.MONEY and isinstance(t, T.DecimalType)):
            out.append(F.col(f.name))  # as stored, so filters reach the scan
        elif (type(t), type(f.dataType)) in _WIDER:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            raise TypeError(f"{name}.{f.name}: {t.simpleString()}, expected {f.dataType.simpleString()}")
    return df.select(out)


@dataclass(frozen=True)
class LoanTables:
    """Lazy DataFrames of the five inputs. Operators select only the columns
    they use, so column pruning reaches each scan."""

    loan_master: DataFrame
    installments: DataFrame
    calls: DataFrame
    bucket_flow: DataFrame
    contacts: DataFrame

    @staticmethod
    def from_fixtures(spark: SparkSession, sf_dir: str) -> "LoanTables":
        """Derive the tables from the driver's test tables (see FIXTURES.md)."""
        from arrearly.sources import fixtures

        return LoanTables(**fixtures.derive_all(spark, sf_dir))

    @staticmethod
    def from_parquet(spark: SparkSession, root: str) -> "LoanTables":
        """Read ``<root>/<table>`` Parquet datasets (see ``conform``)."""
        root = root.rstrip("/")
        return LoanTables(**{n: conform(spark.read.parquet(f"{root}/{n}"), n) for n in TABLE_NAMES})

    @staticmethod
    def from_catalog(spark: SparkSession, names: dict[str, str] | None = None) -> "LoanTables":
        """Read catalog tables (``names`` maps our table name to a table
        identifier; see ``conform``)."""
        names = names or {n: n for n in TABLE_NAMES}
        return LoanTables(**{n: conform(spark.table(names[n]), n) for n in TABLE_NAMES})

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in TABLE_NAMES}

    def write_parquet(self, root: str, mode: str = "overwrite", num_files: int | None = None) -> None:
        """Materialise all five tables (e.g. once per fixture size). With
        ``num_files`` each table is spread evenly over that many files, so a
        later scan has at least that many splits."""
        root = root.rstrip("/")
        for n, df in self.as_dict().items():
            if num_files:
                df = df.repartition(num_files)
            df.write.mode(mode).parquet(f"{root}/{n}")
