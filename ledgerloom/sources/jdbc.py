"""Relational databases through Spark's JDBC source.

Connection settings come from the caller only. Filters and column selections on
the frames read here are pushed into the database by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """``extra`` goes to the driver as it is, e.g. ``{"connectTimeout": "60"}``."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, **options) -> dict[str, str]:
        named = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        merged = {**self.extra, **named, **options}
        return {k: str(v) for k, v in merged.items() if v is not None}


@dataclass(frozen=True)
class Split:
    """Parallel read: ranges of a numeric or date column. Without the bounds a
    JDBC read is one task, whatever ``numPartitions`` says."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_options(
    db: Database, source: str, split: Split | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    return db.options(dbtable=source, fetchsize=fetch_size, **(split.options() if split else {}))


def read_table(spark: SparkSession, db: Database, table: str, split: Split | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(db, table, split)).load()


def read_query(spark: SparkSession, db: Database, query: str, split: Split | None = None) -> DataFrame:
    """A SELECT that the database runs."""
    return read_table(spark, db, f"({query}) T1", split)


def read_batch_id(spark: SparkSession, db: Database, query: str) -> int:
    """The one number that ``query`` returns; it must be positive."""
    row = spark.read.format("jdbc").options(**db.options(query=query)).load().first()
    return check_batch_id(None if row is None else row[0])


def check_batch_id(value) -> int:
    if value is None or int(value) <= 0:
        raise ValueError(f"batch id must be positive, not {value}")
    return int(value)


def write_options(
    db: Database, table: str, writers: int = 20, batch_size: int = 10_000, isolation: str | None = None
) -> dict[str, str]:
    return db.options(
        dbtable=table, numPartitions=writers, batchsize=batch_size, isolationLevel=isolation
    )


def append(df: DataFrame, db: Database, table: str, **options) -> None:
    """Appends through at most ``writers`` connections.

    The last stage of ``df`` runs in as many tasks; one that does much work there
    is better checkpointed first.

    A writer that runs again after a lost executor starts its own transaction
    again; rows carry the batch id, by which a failed batch can be removed.
    """
    df.write.format("jdbc").options(**write_options(db, table, **options)).mode("append").save()


def create(df: DataFrame, db: Database, table: str, **options) -> None:
    """Writes a new table; an existing one is an error."""
    df.write.format("jdbc").options(**write_options(db, table, **options)).mode(
        "errorifexists"
    ).save()
