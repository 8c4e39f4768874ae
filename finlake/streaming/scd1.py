"""SCD-1 upsert from an append stream, as a log-structured table.

Each micro-batch is reduced to one winner per key (``scd1_upsert``) and written
as a batch of the log ``<root>/changes`` (``finlake.storage.BatchLog``); a
replayed batch replaces its own, so the sink is exactly-once without row-level
table operations. A table without batches has no rows, and the columns of
``schema`` where that is declared. The current
state is the SCD-1 winner over the latest compacted base plus later change
batches; :meth:`Scd1Table.compact` folds the log into a new base version.
Sequence ordering is global, so a late row with an older sequence never wins,
whatever batch it arrives in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from finlake.operators.cdc import scd1_upsert
from finlake.storage import BatchLog, read_notes, write_note


@dataclass
class Scd1Table:
    root: str
    keys: list
    sequence_by: list
    tiebreak: list | None = None
    cluster_by: str | None = None   # key column the compacted base is clustered on
    schema: StructType | None = None

    @property
    def log(self) -> BatchLog:
        return BatchLog(f"{self.root}/changes", self.schema)

    @property
    def changes(self) -> str:
        return self.log.rows

    @property
    def base(self) -> str:
        return f"{self.root}/base"

    def _upsert(self, df: DataFrame) -> DataFrame:
        return scd1_upsert(df, self.keys, self.sequence_by, self.tiebreak)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` sink: dedupe the batch and write it as change set ``batch_id``
        (sorted by the cluster column inside each file, so month-filtered reads
        skip row groups of the log as they do for the base)."""
        out = self._upsert(batch)
        if self.cluster_by:
            out = out.sortWithinPartitions(self.cluster_by)
        self.log.write(out, batch_id)

    def run(self, stream: DataFrame, checkpoint: str, available_now: bool = True):
        q = (stream.writeStream.foreachBatch(self.write_batch)
             .option("checkpointLocation", checkpoint))
        q = q.trigger(availableNow=True) if available_now else q
        h = q.start()
        if available_now:
            h.awaitTermination()
            if h.exception() is not None:
                raise h.exception()
        return h

    def _base(self, spark: SparkSession) -> tuple[int, DataFrame | None]:
        """Newest base whose write was completed (-1 when none); a base without its mark is never read."""
        notes = read_notes(spark, f"{self.base}_published", "v")
        if not notes:
            return -1, None
        v, note = notes[-1]
        return v, spark.read.schema(StructType.fromJson(note["schema"])).parquet(f"{self.base}/v={v}")

    def read(self, spark: SparkSession, where=None) -> DataFrame:
        """Current state: winner per key over base (latest version) + newer changes.

        ``where`` may restrict the state to some keys; it must reference key
        columns only, so it is applied below the SCD-1 aggregate and reaches
        the Parquet scans (row groups outside the keys are skipped).
        """
        newest, base = self._base(spark)
        u = self.log.read(spark, after=newest)
        if base is not None:
            types = dict(u.dtypes)
            wider = {c: base[c].try_cast(types[c]) for c, t in base.dtypes if c in types and types[c] != t}
            u = base.withColumns(wider).unionByName(u, allowMissingColumns=True)
        if where is not None:
            u = u.where(where)
        return self._upsert(u)

    def base_version(self, spark: SparkSession) -> int:
        return self._base(spark)[0]

    def last_batch(self, spark: SparkSession) -> int:
        """Id of the newest change batch (-1 when none)."""
        return self.log.last(spark)

    def changes_since(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Change rows of the batches after ``batch_id`` (partition-pruned)."""
        return self.log.read(spark, after=batch_id)

    def compact(self, spark: SparkSession) -> None:
        """Fold the change log into base version ``v = <last batch id>``."""
        last = self.last_batch(spark)
        if last <= self.base_version(spark):
            return
        state = self.read(spark)
        kept = state.schema.jsonValue()
        if self.cluster_by:  # files hold few key ranges each: min/max statistics prune well
            state = state.hint("rebalance", self.cluster_by).sortWithinPartitions(self.cluster_by)
        state.write.mode("overwrite").parquet(f"{self.base}/v={last}")
        write_note(spark, f"{self.base}_published/v={last}", {"schema": kept})
