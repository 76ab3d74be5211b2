"""The upsert applied to arriving changes, exactly once: each micro-batch becomes the next version of a stored layer.

The batch's number and the stream's identity are part of the manifest row that makes the
version visible, so a batch that is run again after a stop is found there and left out:
it either has its version or has changed nothing. Rows are only ever added as changes to
the buckets of their keys.

Defined results: within a batch the row of a key with the greatest order counts (of equals
any one); a row that comes late, with a smaller order than the stored row of its key, is
left out, one with an equal order takes its place; a null order is the smallest; rows with
a null key are all kept. So the layer holds the latest row of every key, however the rows
were dealt to batches, as long as orders are distinct.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayside.sources.snapshots import Layer


def latest_per_key(changes: DataFrame, key: str, order: str) -> DataFrame:
    """Within a batch the last change of a key counts; rows without a key stay."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    ranked = changes.filter(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    return ranked.unionByName(changes.filter(F.col(key).isNull()))


def without_late(rows: DataFrame, stored: DataFrame, key: str, order: str) -> DataFrame:
    """Rows that are not older than the stored row of their key."""
    if order not in stored.columns:
        return rows
    name = F.col(key).cast("string").alias("__key")
    have = stored.filter(F.col(order).isNotNull()).select(name, F.col(order).alias("__have")).groupBy("__key").agg(F.max("__have").alias("__have"))
    both = rows.withColumn("__key", name).join(have, "__key", "left")
    return both.filter(F.col("__have").isNull() | (F.col(order) >= F.col("__have"))).drop("__key", "__have")


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps over restarts from its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def apply_batch(layer: Layer, batch: DataFrame, batch_id: int, stream: str, key: str, order: str, modified: str | None) -> bool:
    """Make a batch the layer's next version; False if it was before."""
    meta = layer.meta()
    if meta is None and layer.newest() is not None:
        raise ValueError(f"{layer.folder} holds versions of another url or filter; changes alone would replace the layer")
    if meta is not None and meta["stream"] == stream and meta["batch_id"] >= batch_id:
        return False
    rows = latest_per_key(batch, key, order)
    if meta is None:
        layer.store(rows, key, modified, stream=stream, batch_id=batch_id)
    else:
        rows = without_late(rows, layer.read(layer.touched(rows, key)), key, order)
        layer.upsert(rows, key, modified, stream=stream, batch_id=batch_id)
    return True


def refresh_stream(changes: DataFrame, folder: str, key: str, order: str, url: str, where: str, checkpoint: str, modified: str | None = None) -> StreamingQuery:
    """Start the stream over what is there now; started again it goes on from its checkpoint.
    modified: the column whose latest value is the layer's watermark (the order, if it is a plain column)."""
    plain = changes.schema[order].dataType.typeName() not in ("struct", "array")
    mark = modified or (order if plain else None)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        apply_batch(Layer(spark, folder, url, where), batch, batch_id, stream_identity(spark, checkpoint), key, order, mark)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
