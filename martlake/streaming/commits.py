"""A streaming sink that commits whole micro-batches (Python Data Source).

Tasks write Parquet files, one for each key bucket they hold rows of, under a name
nobody reads. When all tasks are done the batch gets one small file
``_batches/<batch id>.json`` that names them; a batch whose file exists already (the
driver died after it, before Spark's own log) is not committed again, and its new
files go. An aborted batch deletes what its tasks wrote. Readers take the files of
committed batches only, so every delivered row is in the sink exactly once.

No ``foreachBatch`` and no callback server: the writer runs in Spark's own Python
workers and reaches the sink through Arrow's file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from martlake.operators.dedup import latest_by_key
from martlake.sinks import snapshots as SN

FORMAT, BATCHES, BUCKET = "martlake_batches", "_batches", "_bucket"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


def _store(path: str):
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file:///"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


class BatchWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        store, root = _store(self.path)
        open_: dict[int, tuple[str, pq.ParquetWriter]] = {}
        name, rows = uuid.uuid4().hex, 0
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                rows += table.num_rows
                for bucket in pc.unique(table.column(BUCKET)).to_pylist():
                    if bucket not in open_:
                        folder = f"data/{bucket}"
                        store.create_dir(f"{root}/{folder}", recursive=True)
                        file = f"{folder}/{name}.parquet"
                        open_[bucket] = file, pq.ParquetWriter(f"{root}/{file}", table.schema.remove(table.schema.get_field_index(BUCKET)), filesystem=store)
                    open_[bucket][1].write_table(table.filter(pc.equal(table.column(BUCKET), bucket)).drop_columns([BUCKET]))
        finally:
            for _, writer in open_.values():
                writer.close()
        return Written([f for f, _ in open_.values()], rows)

    def _delete(self, messages) -> None:
        store, root = _store(self.path)
        for m in messages:
            for f in (m.files if m is not None else []):
                store.delete_file(f"{root}/{f}")

    def commit(self, messages, batchId: int) -> None:  # noqa: N803 - Spark's name
        from pyarrow.fs import FileType
        store, root = _store(self.path)
        final = f"{root}/{BATCHES}/{batchId:020d}.json"
        if store.get_file_info(final).type != FileType.NotFound:  # committed before a restart
            self._delete(messages)
            return
        store.create_dir(f"{root}/{BATCHES}", recursive=True)
        text = json.dumps({"batch": batchId, "files": [f for m in messages for f in m.files], "rows": sum(m.rows for m in messages)})
        waiting = f"{final}.{uuid.uuid4().hex}"
        with store.open_output_stream(waiting) as out:
            out.write(text.encode())
        store.move(waiting, final)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self._delete(messages)


class BatchSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> BatchWriter:  # noqa: N802
        return BatchWriter(self.options["path"])


def write_batches(stream: DataFrame, sink: str, checkpoint: str, keys: list[str], buckets: int = 8,
                  available_now: bool = True) -> StreamingQuery:
    """Start ``stream`` into the sink; rows go to files by the bucket of their key."""
    stream.sparkSession.dataSource.register(BatchSink)
    w = stream.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).writeStream \
        .format(FORMAT).option("path", sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


@dataclass(frozen=True)
class Batch:
    batch: int
    files: tuple[str, ...]
    rows: int


def committed(spark: SparkSession, sink: str) -> list[Batch]:
    """The committed micro-batches, by id."""
    names = sorted(n for n, _ in SN.listing(spark, f"{sink}/{BATCHES}") if n.endswith(".json"))
    found = (json.loads(SN.read_text(spark, f"{sink}/{BATCHES}/{n}")) for n in names)
    return [Batch(f["batch"], tuple(f["files"]), f["rows"]) for f in found]


def read_deliveries(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """Every delivered row of the committed batches, repeated deliveries included."""
    files = [f"{sink}/{f}" for b in committed(spark, sink) for f in b.files]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_latest(spark: SparkSession, sink: str, schema: T.StructType, keys: list[str], order_by: list[str]) -> DataFrame:
    """The upserted state: one row per key, the one delivered with the greatest order."""
    return latest_by_key(read_deliveries(spark, sink, schema), keys, order_by)
