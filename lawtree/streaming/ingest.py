"""Registration of files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lawtree.plans.ingest import ingest
from lawtree.plans.warehouse import Warehouse


def merge_micro_batches(warehouse: Warehouse, name: str, epoch: int, every: int) -> None:
    """Rewrite micro-batches as one as soon as there are ``every`` of them, ``every`` of these again, and so on.

    Readers then scan a number of folders that grows with the logarithm of the micro-batches, and a
    row is rewritten as many times. A merge that a repeated micro-batch comes upon is not made again.
    """
    done, width = warehouse.committed_ids(), 1
    while (epoch + 1) % (width * every) == 0:
        parts = range(epoch + 1 - width * every, epoch + 1, width)
        merged = _batch_name(name, parts[0], width * every)
        if merged not in done:
            warehouse.compact(merged, [_batch_name(name, first, width) for first in parts])
        width *= every


def _batch_name(name: str, first: int, width: int) -> str:
    return f"{name}-{first}" if width == 1 else f"{name}-{first}-to-{first + width - 1}"


def ingest_stream(
    files: DataFrame, root: str, checkpoint: str, *, trigger: dict | None = None, merge_every: int | None = None,
    **options,
) -> StreamingQuery:
    """Register the files of a stream (``corpus_stream`` or any other source of ``FILES`` rows).

    By default what is there now, then stop. The checkpoint remembers the files seen; a
    micro-batch repeated after a failure has the same batch id and is registered once, and
    files seen again under a new checkpoint are skipped as known. With ``merge_every`` that many
    micro-batches are merged into one; ``Warehouse.vacuum`` deletes what merges replaced.
    """
    if merge_every is not None and merge_every < 2:
        raise ValueError("merge_every must be at least 2")

    def register(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest(session, batch, root, f"stream-{query}-{epoch}", **options)
        if merge_every is not None:
            merge_micro_batches(Warehouse(session, root), f"stream-{query}", epoch, merge_every)

    return (
        files.writeStream.foreachBatch(register)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
