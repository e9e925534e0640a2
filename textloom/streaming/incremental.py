"""Streaming extension: stateless operators on streams, windowed counters, and incremental near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators import dedup, quality


def filtered_stream(docs: DataFrame, **limits) -> DataFrame:
    """The quality filter is stateless: the batch operator as it is."""
    return quality.quality_filter(docs, **limits)


def reason_counts(docs: DataFrame, time_col: str, window: str = "10 minutes", late: str = "10 minutes", **limits) -> DataFrame:
    """Drop reasons by event-time window; rows later than the watermark are left out."""
    marked = quality.with_drop_reason(docs, **limits).withWatermark(time_col, late)
    reason = F.coalesce("drop_reason", F.lit("passed")).alias("reason")
    return marked.groupBy(F.window(time_col, window), reason).agg(F.count("*").alias("documents"))


class IncrementalDedup:
    """Near-duplicate removal against everything kept so far, for ``foreachBatch``.

    Kept documents' bands and signatures are Parquet tables at ``state_path``, one folder a batch, so a batch that is
    run again replaces its own part. Order is (batch, order key): a batch is deduplicated in itself and against
    earlier batches' kept documents.
    """

    def __init__(self, out_path: str, state_path: str, ord_col: str = "doc_id", text_col: str = "text", threshold: float = 0.85, num_perm: int = 128, num_bands: int = 16, rows: int = 8):
        self.out_path, self.state_path, self.ord_col, self.text_col = out_path, state_path, ord_col, text_col
        self.threshold, self.num_perm, self.num_bands, self.rows = threshold, num_perm, num_bands, rows

    def _earlier(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        jvm = batch.sparkSession.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.state_path)
        if batch_id == 0 or not root.getFileSystem(batch.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return None
        return batch.sparkSession.read.schema("band int, key long, signature array<bigint>, batch long").parquet(self.state_path).where(F.col("batch") < batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        signed = dedup.with_signatures(batch.select(F.col(self.ord_col).alias("ord"), self.text_col), self.num_perm, text_col=self.text_col).persist()
        try:
            fresh = signed
            earlier = self._earlier(batch, batch_id)
            if earlier is not None:
                mine = signed.select("ord", "signature", F.inline(dedup.bands(F.col("signature"), self.num_bands, self.rows)))
                known = earlier.select("band", "key", F.col("signature").alias("other"))
                near = mine.join(known, ["band", "key"]).where(dedup.jaccard_estimate(F.col("signature"), F.col("other")) >= self.threshold)
                fresh = signed.join(near.select("ord").distinct(), "ord", "left_anti")
            links = dedup.similar_pairs(fresh, self.threshold, self.num_bands, self.rows, "ord")
            gone = dedup.removed_by_greedy(links)
            kept = fresh.join(gone, "ord", "left_anti")
            state = kept.select(F.inline(dedup.bands(F.col("signature"), self.num_bands, self.rows)), "signature")
            state.write.mode("overwrite").parquet(f"{self.state_path}/batch={batch_id}")
            batch.join(kept.select("ord"), batch[self.ord_col] == kept["ord"], "left_semi").write.mode("overwrite").parquet(f"{self.out_path}/batch={batch_id}")
        finally:
            signed.unpersist()

    def start(self, docs: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = docs.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()
