"""A search index that follows its documents: segments of postings with vectors beside them, changed by commits.

Each batch of changes becomes one commit: what is new or different is encoded and indexed as a segment of its own, and the
entry of each document says which segment holds it. Postings of other segments are dead without being touched; a merge
drops them. Lexical and dense search read one version, so they never see half a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillon.operators import retrieval
from quillon.operators.committed import GONE, LAYERS, KeyedTable, Snapshot, Store
from quillon.operators.keyed import latest

#: More segments than this are merged.
SEGMENTS = 6


class MaintainedIndex:
    """An index over documents (id, content). `encode` gives (id, vector) for (id, content), and is given only what changed."""

    def __init__(self, spark: SparkSession, path: str, encode: Callable[[DataFrame], DataFrame]):
        self.store, self.encode = Store(spark, path), encode
        self.entries = KeyedTable(self.store, "entries", ["id"])

    def refresh(self, changes: DataFrame, *order: Column, stream: str | None = None, epoch: int = 0) -> Snapshot:
        """Apply changes (id, content); null content drops the document. Of several changes of an id the first in the order given.

        A document whose content is what the index holds is neither encoded nor indexed again. The notes of a commit count
        what was encoded, kept and dropped. A batch of a stream that has been applied already is passed over.
        """
        newest = latest(changes, ["id"], *order)

        def made(base: Snapshot):
            applied = dict(base.notes.get("applied", {}))
            if stream is not None and applied.get(stream, -1) >= epoch:
                return None
            told = newest.withColumn("digest", F.sha2("content", 256))
            if base.of("entries"):
                held = self.entries.read(base).select("id", F.col("digest").alias("was"))
                told = told.join(held, "id", "left")
            else:
                told = told.withColumn("was", F.lit(None).cast("string"))
            change = F.when(F.col("digest").isNull() & F.col("was").isNull(), "none").when(F.col("digest").isNull(), "dropped").when(F.col("digest").eqNullSafe(F.col("was")), "kept").otherwise("encoded")
            work = self.store.write(told.withColumn("change", change).filter("change <> 'none'"))
            judged = self.store.spark.read.parquet(work)
            counts = {r["change"]: r["count"] for r in judged.groupBy("change").count().collect()}  # at most three rows
            notes = {k: counts.get(k, 0) for k in ("encoded", "kept", "dropped")} | {"applied": applied | ({stream: epoch} if stream is not None else {})}
            layers = {}
            if notes["encoded"] or notes["dropped"]:
                segment = uuid.uuid4().hex
                fresh = judged.filter("change = 'encoded'")
                vectors = self.encode(fresh.select("id", "content"))
                shown = fresh.join(vectors, "id").select("id", "digest", "vector", F.lit(segment).alias("segment"), F.lit(False).alias(GONE))
                gone = judged.filter("change = 'dropped'").select("id", "digest", F.lit(None).cast(shown.schema["vector"].dataType).alias("vector"), F.lit(segment).alias("segment"), F.lit(True).alias(GONE))
                layers["entries"] = [*base.of("entries"), self.store.write(shown.unionByName(gone))]
                if notes["encoded"]:
                    postings = retrieval.index_of_texts(fresh.select("id", F.col("content").alias("text"))).withColumn("segment", F.lit(segment))
                    layers["postings"] = [*base.of("postings"), self.store.write(postings.sortWithinPartitions("term"))]
            self.store.discard(work)
            return layers, notes

        after = self.store.change(made)
        if len(after.of("postings")) > SEGMENTS or len(after.of("entries")) > LAYERS:
            return self.merge()
        return after

    def _postings(self, at: Snapshot) -> DataFrame:
        folders = at.of("postings")
        if not folders:
            raise ValueError("nothing has been indexed")
        return self.store.spark.read.parquet(*folders)

    def merge(self) -> Snapshot:
        """One segment of the living postings and one layer of entries, in one commit; of batches committed meanwhile it starts anew."""

        def made(base: Snapshot):
            if len(base.of("postings")) < 2 and len(base.of("entries")) < 2:
                return None
            entries = self.store.write(self.entries.merged(base.of("entries")).filter(~F.col(GONE)))
            held = self.store.spark.read.parquet(entries).select("id", "segment")
            living = self._postings(base).join(held, ["id", "segment"], "left_semi")
            parts = living.repartitionByRange(F.col("term"), F.col("id")).sortWithinPartitions("term", "id")
            return {"entries": [entries], "postings": [self.store.write(parts)]}, base.notes | {"merged": len(base.of("postings"))}

        return self.store.change(made)

    def documents(self, at: Snapshot | None = None) -> DataFrame:
        """(id, digest, vector, segment) of the documents of a version."""
        return self.entries.read(at)

    def lexical(self, queries: DataFrame, n: int = retrieval.POOL, at: Snapshot | None = None) -> DataFrame:
        """(query, id, score, rank), as retrieval.lexical gives over an index that is built whole."""
        at = at or self.store.snapshot()
        return retrieval.lexical(self._postings(at), queries, n, living=self.documents(at).select("id", "segment"))

    def dense(self, queries: DataFrame, n: int = retrieval.POOL, at: Snapshot | None = None) -> DataFrame:
        """(query, id, distance, rank), as retrieval.dense gives over all vectors."""
        return retrieval.dense(self.documents(at).select("id", "vector"), queries, n)

    def follow(self, stream: DataFrame, name: str, checkpoint: str, *order: Column) -> StreamingQuery:
        """Apply each micro-batch of a stream of changes (id, content, ...) once, and stop when all that is there has been applied."""

        def apply(rows: DataFrame, epoch: int) -> None:
            self.refresh(rows, *order, stream=name, epoch=epoch)

        return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
