"""Tables bucketed alike by row id, so that they are joined again and again without a shuffle.

Labels and scores of the same claims are written once each into the same number of buckets, one
sorted file per bucket; that write is the only shuffle. Joins on the row id then read bucket by
bucket. Row ids are spread by their hash, so buckets are even as long as ids are few times repeated.

Cases: ids of different types would be hashed differently and are refused; null ids share a
bucket and match nothing; an empty table has no files and joins as empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import staging_folder

ROWS_PER_BUCKET = 2_000_000


def bucket_count(rows: int, least: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that tables of different counts still fit: at least ``least`` and enough for ``rows``."""
    wanted = max(least, -(-rows // rows_per_bucket), 1)
    return 1 << (wanted - 1).bit_length()


def write_colocated(tables: dict[str, DataFrame], row_id: str, buckets: int, folder: str | None = None) -> dict[str, DataFrame]:
    """The tables as read back from their buckets, under the names given; files go below ``folder``.

    ``folder`` must be shared storage; unset, it is the staging folder. The tables are known to the
    session's catalog by a name of their own and stay until they are dropped there.
    """
    types = {df.schema[row_id].dataType.simpleString() for df in tables.values()}
    if len(types) > 1:
        raise ValueError(f"{row_id} has different types: {sorted(types)}")
    out = {}
    for name, df in tables.items():
        spark, unique = df.sparkSession, f"colocated_{uuid.uuid4().hex}"
        path = f"{folder or staging_folder(spark)}/{unique}"
        (df.repartition(buckets, row_id).write.bucketBy(buckets, row_id).sortBy(row_id)
         .option("path", path).format("parquet").saveAsTable(unique))
        out[name] = spark.table(unique)
    return out
