"""Broadcasting only what has been seen to be small."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

SMALL_ROWS = 10_000


def small_side(df, max_rows=SMALL_ROWS):
    """Evaluate a table expected to be tiny and hand it back as a broadcast local relation.

    At most ``max_rows + 1`` rows ever reach the driver. A larger table is returned as it
    was, without a hint, so the join falls back to a shuffle.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df
    local = pa.Table.from_pylist(
        [row.asDict(recursive=True) for row in rows], schema=to_arrow_schema(df.schema)
    )
    return F.broadcast(df.sparkSession.createDataFrame(local, schema=df.schema))
