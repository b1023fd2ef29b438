"""Counter rates as a stream with keyed state: what the batch gives, however the samples are cut into files, and across restarts.

Of each node the state holds its last ``KEEP`` samples, summed over interfaces. A new row changes its sample's sum and the rises of that
sample and the next, which are sent on again; a later batch's row of a sample replaces an earlier one. A batch is
written to a folder of its own number, so a batch that runs again replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Samples of a node that may still change; earlier ones that come are sent on as late, without a rise.
KEEP = 4096
CHANGED = "node long, seq long, rx long, rise long, late boolean"


class Rises(StatefulProcessor):
    """Rows of CHANGED for the samples that a batch changes."""

    def __init__(self, keep: int = KEEP):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.samples = handle.getValueState("samples", "seqs array<bigint>, sums array<bigint>, full boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        seqs, sums, full = (np.zeros(0, np.int64), np.zeros(0, np.int64), False)
        if self.samples.exists():
            seqs, sums, full = self.samples.get()
            seqs, sums = np.array(seqs, np.int64), np.array(sums, np.int64)
        new = pd.concat(rows).groupby("seq").rx.sum()
        late = new[new.index < seqs[0]] if full else new[:0]
        new = new[~new.index.isin(late.index)]
        whole = pd.Series(sums, seqs).add(new, fill_value=0).astype(np.int64).sort_index()
        at = whole.index.get_indexer(new.index)
        at = np.unique(np.concatenate([at, at + 1]))
        at = at[at < len(whole)]
        rise = pd.Series(whole).diff().astype("Int64").to_numpy()[at]
        # the oldest one kept has lost its predecessor: its rise stands
        rise_known = ~(full & (at == 0))
        out = pd.DataFrame({"node": key[0], "seq": whole.index[at], "rx": whole.to_numpy()[at], "rise": pd.array(rise, "Int64"), "late": False})[rise_known]
        if len(late):
            out = pd.concat([out, pd.DataFrame({"node": key[0], "seq": late.index, "rx": late.to_numpy(), "rise": pd.array([pd.NA] * len(late), "Int64"), "late": True})])
        kept = whole[-self.keep :]
        self.samples.update((kept.index.tolist(), kept.tolist(), bool(full or len(kept) < len(whole))))
        yield out

    def close(self) -> None:
        pass


def follow(counters: DataFrame, out: str, checkpoint: str, keep: int = KEEP) -> StreamingQuery:
    """Process what the stream counters(node, seq, interface, rx) has now, from where ``checkpoint`` left off, into the folder ``out``."""
    spark = counters.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    changed = counters.select("node", "seq", "rx").groupBy("node").transformWithStateInPandas(Rises(keep), CHANGED, "Update", "None")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rates(spark: SparkSession, out: str, interval: int = 600) -> DataFrame:
    """(node, seq, rx, mbps): the last word on each sample."""
    last = spark.read.parquet(out).where("NOT late").groupBy("node", "seq").agg(F.max_by(F.struct("rx", "rise"), "batch").alias("s"))
    return last.select("node", "seq", "s.rx", F.expr(f"s.rise div {interval} div 1024 div 1024").alias("mbps"))


def replayed(counters: DataFrame, folder: str, cuts: list[int], keep: int = KEEP) -> DataFrame:
    """The rates of counters that are delivered in parts, by ``seq``, with a restart of the stream after each part."""
    spark = counters.sparkSession
    place = f"{folder}/rates-{uuid.uuid4().hex}"
    bounds = [None, *cuts, None]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        part = counters if low is None else counters.where(F.col("seq") >= low)
        (part if high is None else part.where(F.col("seq") < high)).write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(counters.schema).option("maxFilesPerTrigger", 8).parquet(f"{place}/in")
        follow(stream, f"{place}/out", f"{place}/state", keep).awaitTermination()
    return rates(spark, f"{place}/out")

