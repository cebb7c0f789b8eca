"""The streaming gold detail: ordered admission, append by batch, repair of late rows.

The detail is a table in cells of business date and load part. Each micro-batch of the
join appends its rows as a part of its own, so nothing is rewritten. Late rows can't
enter the join: their match keys are re-matched in batch from the upsert tables, and the
cells that hold these keys are replaced (part -1 holds the repaired rows). From then on
the keys are the batch's: what the stream still emits for them is left out, and they are
re-matched when it does, or when a silver row of theirs changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import incremental
from reconlake.session import stream_state
from reconlake.streaming import runner
from reconlake.streaming.cells import CellTable, rows_of
from reconlake.streaming.keyed import KeyedTable
from reconlake.streaming.ordered import OrderedInput
from reconlake.streaming.upsert import listing

PART = "load_part"
KEYS = "call_id string, msisdn_normalized string"
USAGE, CHARGES = "usage", "charges"
# The join's state is small once its watermark has passed a group, the changes that led there are
# not: it is kept as it is, so that the next run doesn't go through those again.
JOIN_STATE = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}


class GoldStream:
    def __init__(self, table: CellTable, source: OrderedInput, usage: KeyedTable, charges: KeyedTable,
                 join: Callable[[DataFrame, DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame],
                 max_files: int = 100):
        """``join`` makes detail rows of the two streams, ``finish`` of matched batch rows."""
        self.spark: SparkSession = table.spark
        self.table, self.source, self.usage, self.charges = table, source, usage, charges
        self.join, self.finish, self.max_files = join, finish, max_files

    def refresh(self, usage: DataFrame, charges: DataFrame) -> int:
        """Admit new staging rows, run the join over them in order of time, repair late ones; their number."""
        for side, staging in ((USAGE, usage), (CHARGES, charges)):
            self.source.admit(side, staging, f"{self.source.root}/{side}/checkpoint")
        self._run()                                # what a stopped run had handed over
        for group in self.source.groups(self.max_files):
            self.source.hand_over(group)
            self._run()
        return self._repair()

    # --- the join -----------------------------------------------------------------------

    def _run(self) -> None:
        rows = self.join(self.source.stream(USAGE), self.source.stream(CHARGES))
        w = (rows.writeStream.foreachBatch(self._append).option("checkpointLocation", f"{self.source.root}/join-checkpoint")
                 .trigger(availableNow=True))
        with stream_state(self.spark, JOIN_STATE):
            q = w.start()
        runner.wait(q)

    def _append(self, batch: DataFrame, batch_id: int) -> None:
        state = self.table.state()
        if batch_id <= state.get("batch", -1):
            return
        # the join runs once; its rows are used several times
        path = f"{self.source.root}/emitted"
        batch.withColumn(PART, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(path)
        rows = self.spark.read.schema(self.table.schema).parquet(path)
        repaired = self._repaired(state)
        if repaired is not None:
            incremental.keys_of(incremental.rows_with_keys(rows, repaired)).write.mode("overwrite").parquet(
                f"{self.source.root}/hits/batch={batch_id}")
            rows = incremental.rows_with_keys(rows, repaired, "left_anti")
        if rows.isEmpty():
            return
        none = self.table.cells().where(F.col(PART) == batch_id)
        self.table.commit(rows, none, {**state, "batch": batch_id})

    # --- late rows ----------------------------------------------------------------------

    def _repaired(self, state: dict) -> DataFrame | None:
        """The match keys that are the batch's."""
        if "repaired" not in state:
            return None
        return self.spark.read.schema(KEYS).parquet(f"{self.source.root}/repaired/v={state['repaired']}")

    def _repair(self) -> int:
        state = self.table.state()
        seen = {side: self.source.last_batch(side) for side in (USAGE, CHARGES)}
        late = {side: self.source.late(side, state.get(f"late_{side}", -1)) for side in seen}
        n = {side: rows.count() for side, rows in late.items()}
        repaired = self._repaired(state)
        if not any(n.values()) and repaired is None:
            return 0
        new = incremental.touched_keys(late[USAGE], late[CHARGES])
        now = {USAGE: self.usage.version(), CHARGES: self.charges.version()}
        again, every = new, new
        if repaired is not None:
            changed = incremental.touched_keys(self.usage.changes(state[USAGE], now[USAGE]),
                                               self.charges.changes(state[CHARGES], now[CHARGES]))
            again = new.unionByName(rows_of(changed, repaired, incremental.MATCH_KEY)).unionByName(self._hits(state)).distinct()
            every = new.unionByName(repaired).distinct()
        version = self.table.version() + 1
        every.write.mode("overwrite").parquet(f"{self.source.root}/repaired/v={version}")
        hits = [int(b.split("=")[1]) for b in self._hit_batches(state)]
        done = {**state, **now, "repaired": version, "hits": max(hits, default=state.get("hits", -1)),
                **{f"late_{side}": b for side, b in seen.items()}}
        incremental.replace_keys(self.table, again, lambda keys: self._matched(keys, now), done)
        for side, b in seen.items():
            self.source.forget(side, b - 1)          # the last folder names the last batch
        return sum(n.values())

    def _matched(self, keys: DataFrame, now: dict[str, int]) -> DataFrame:
        own = {c: c for c in incremental.MATCH_KEY}
        rows = incremental.rematched(self.usage.matching(keys, own, now[USAGE]),
                                     self.charges.matching(keys, incremental.CHARGE_KEY, now[CHARGES]), self.finish)
        return rows.withColumn(PART, F.lit(-1).cast("long"))

    def _hit_batches(self, state: dict) -> list[str]:
        return [b for b in listing(self.spark, f"{self.source.root}/hits")
                if b.startswith("batch=") and int(b.split("=")[1]) > state.get("hits", -1)]

    def _hits(self, state: dict) -> DataFrame:
        folders = [f"{self.source.root}/hits/{b}" for b in self._hit_batches(state)]
        if not folders:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(*folders)
