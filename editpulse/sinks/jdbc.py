"""JDBC writes of count rows (e.g. into PostgreSQL).

Only rows that are final per key belong in an append into a keyed table:
the append-mode stream's output, or the latest view of the versioned table
for closed windows.  ``num_partitions`` bounds the number of concurrent
connections.  The rows are repartitioned (one round-robin shuffle of the
result) rather than coalesced: a coalesce would also run the work that
produces them, e.g. the final aggregate, on only that many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from editpulse.config import DEFAULT_JDBC_BATCH_SIZE


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = DEFAULT_JDBC_BATCH_SIZE,
                 **extra: str) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(int(batch_size))}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               num_partitions: int | None = None, **kwargs) -> None:
    out = df.repartition(int(num_partitions)) if num_partitions else df
    out.write.format("jdbc").options(**jdbc_options(url, table, **kwargs)).mode(mode).save()
