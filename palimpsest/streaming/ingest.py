"""Releases dropped into a folder are put as they are closed.

A release is a folder ``version=N`` with any number of part files, and is closed by a marker file
``K.done`` in it, K being how many parts it has; as Spark passes over empty files, it holds any text, and
parts are not empty either. The stream follows names alone: it keeps, for each
release, how many parts it has seen and how many there are to be, and gives the version when all are
there. The release is then read whole, by the reader that puts use, so it is what a put of the folder is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..store import Store

_FILE = "path string, modificationTime timestamp, length long, content binary"


def closed_releases(spark: SparkSession, folder: str, per_trigger: int = 10_000) -> DataFrame:
    """A stream of (version, parts, bytes) of the releases under ``folder``, each when its last part is there.

    A part that comes to a closed release gives it again, with the new counts.
    """
    found = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_trigger).load(folder)
    version = F.regexp_extract("path", r"/version=(\d+)/", 1)
    promised = F.regexp_extract("path", r"/(\d+)\.done$", 1)
    names = found.where(version != "").select(version.cast("long").alias("version"), F.when(promised != "", promised.cast("long")).alias("promised"), "length")

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts, size, whole = state.get if state.exists else (0, 0, -1)
        for rows in batches:
            marks = rows["promised"].dropna()
            parts, size = parts + int(rows["promised"].isna().sum()), size + int(rows["length"].sum())
            whole = max(whole, *map(int, marks)) if len(marks) else whole
        state.update((parts, size, whole))
        if 0 <= whole <= parts:
            yield pd.DataFrame({"version": [key[0]], "parts": [parts], "bytes": [size]})

    schema = "version long, parts long, bytes long"
    return names.groupBy("version").applyInPandasWithState(follow, schema, "parts long, bytes long, promised long", "update", GroupStateTimeout.NoTimeout)


def ingest(store: Store, folder: str, collection: str, format: str, checkpoint: str, **put_options) -> StreamingQuery:
    """Put each closed release of the folder, then stop. Versions may come in any order.

    The commit of a put names the release with its parts and bytes, so a batch that is run again after a
    failure finds what it has put already and changes nothing. The driver sees one row a release.
    """

    def put(batch: DataFrame, _: int) -> None:
        for row in sorted(batch.collect()):
            ledger = f"{folder}|{collection}|{row.version}|{row.parts}|{row.bytes}"
            store.put(f"{folder.rstrip('/')}/version={row.version}", collection, row.version, format, ledger=ledger, **put_options)

    stream = closed_releases(store.spark, folder).writeStream.outputMode("update").foreachBatch(put)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
