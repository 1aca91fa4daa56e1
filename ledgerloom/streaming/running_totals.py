"""Exact running totals of executions: a stateful processor that keeps the codes of each execution.

A change is an error event of an execution with the codes that it reports, repeats included, or the removal of its links
to some codes. State is a map of codes, so distinct counts are exact, a code that is reported again counts once, and
removals shrink what is open. Spark keeps it in RocksDB, a code at a time; a batch that is run again starts from the
state of the batch before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship

CHANGES = "execution_id string, pos long, kind string, codes array<string>"
TOTALS = "execution_id string, total_occurrences long, unique_errors long, open_errors long, error_type string, n_events long"
#: Kinds of changes.
ERROR, REMOVED = "error", "removed"
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Totals(StatefulProcessor):
    """Totals of one execution; `additive` counts the codes of each event anew, as counters that only add do."""

    def __init__(self, additive: bool):
        self.additive = additive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.codes = handle.getMapState("codes", "code string", "open boolean")
        self.totals = handle.getValueState("totals", "total long, n_unique long, n_open long, error_type string, n_events long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        seen = self.totals.exists()
        total, unique, open_, kind, events = self.totals.get() if seen else (0, 0, 0, None, 0)
        read, wrote = {}, {}  # codes of this batch: each is read from the state once at most, and written once

        def state_of(code: str) -> bool | None:
            if code not in read:
                read[code] = bool(self.codes.getValue((code,))[0]) if seen and self.codes.containsKey((code,)) else None
            return wrote.get(code, read[code])

        changes = [c for part in rows for c in zip(part["pos"], part["kind"], part["codes"])]
        for _, what, codes in sorted(changes, key=lambda c: c[0]):
            codes = [] if codes is None else [c for c in codes if c is not None]
            names = list(dict.fromkeys(codes))
            if what == ERROR and codes:
                total, events, kind = total + len(codes), events + 1, codes[0][:2]
                if self.additive:
                    unique, open_ = unique + len(names), open_ + len(names)
            for code in names:
                is_open = state_of(code)
                if what == ERROR and not is_open:
                    unique, open_ = (unique, open_) if self.additive else (unique + (is_open is None), open_ + 1)
                    wrote[code] = True
                elif what == REMOVED and is_open:
                    open_ = max(0, open_ - 1)
                    wrote[code] = False
        for code, is_open in wrote.items():
            if is_open != read[code]:
                self.codes.updateValue((code,), (is_open,))
        self.totals.update((total, unique, open_, kind, events))
        yield pd.DataFrame({"execution_id": [key[0]], "total_occurrences": [total], "unique_errors": [unique], "open_errors": [open_], "error_type": [kind], "n_events": [events]})

    def close(self) -> None:
        pass


def execution_totals(changes: DataFrame, additive: bool = False) -> DataFrame:
    """Running TOTALS of a stream of CHANGES, one row for each execution of a batch (update mode).

    Changes of one batch count in the order of pos. An error without codes changes nothing; null codes are none; changes
    without an execution are left out. A removal of a code that isn't open changes nothing. error_type is that of the
    latest event. additive=True adds the distinct codes of every event to unique_errors and open_errors, even if they
    are known, as the counters of a key-value store would; a removal still takes one off, never below zero.
    """
    spark = changes.sparkSession
    ship(spark)
    if spark.conf.get(PROVIDER[0]) != PROVIDER[1]:
        spark.conf.set(*PROVIDER)  # map state needs it
    known = changes.where("execution_id is not null and pos is not null").select(*[c.split(" ")[0] for c in CHANGES.split(", ")])
    return known.groupBy("execution_id").transformWithStateInPandas(Totals(additive), TOTALS, "Update", "None")


def batch_totals(changes: DataFrame) -> DataFrame:
    """The same TOTALS (additive=False) of a whole table of CHANGES."""
    rows = changes.where("execution_id is not null and pos is not null").withColumn("codes", F.filter("codes", lambda c: c.isNotNull()))
    events = rows.where((F.col("kind") == ERROR) & (F.size("codes") > 0))
    totals = events.groupBy("execution_id").agg(F.sum(F.size("codes")).alias("total_occurrences"), F.max_by(F.substring(F.col("codes")[0], 1, 2), "pos").alias("error_type"), F.count("*").alias("n_events"))
    each = rows.select("execution_id", "pos", "kind", F.explode(F.array_distinct("codes")).alias("code")).where(F.col("kind").isin(ERROR, REMOVED))
    last = each.groupBy("execution_id", "code").agg(F.max_by("kind", "pos").alias("last"), F.count_if(F.col("kind") == ERROR).alias("n"))
    codes = last.where("n > 0").groupBy("execution_id").agg(F.count("*").alias("unique_errors"), F.count_if(F.col("last") == ERROR).alias("open_errors"))
    return totals.join(codes, "execution_id").select(*[c.split(" ")[0] for c in TOTALS.split(", ")])


def run_to_end(spark: SparkSession, changes: DataFrame, folder: str, n: int = 16, additive: bool = False) -> DataFrame:
    """Run a stream of CHANGES until its source has no more, and return the table of totals that it keeps below folder.

    A second call goes on where the first one ended."""
    from ..operators.upsert import TableSpec
    from .event_state import Buckets

    table = Buckets(f"{folder}/totals", TableSpec(("execution_id",), None), n)
    query = execution_totals(changes, additive).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(table.apply).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.table(spark, TOTALS)
