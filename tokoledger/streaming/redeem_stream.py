"""Redemption requests as a stream.

The reference handles one request per procedure call, each seeing the
balance left by the calls before it. As Structured Streaming: requests arrive
as files (or any streaming source); every micro-batch is one redemption batch
(``plans.batches.run_redemption_batch``) over tables opened anew, and decides
all its requests. Micro-batch ``n`` is round ``first_round + n``, so a micro-batch that
is run again after a failure replaces its own round. With a maintained balance store it
reads the changes since the last micro-batch instead of the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..params import RedeemParams
from ..plans.balances import BalanceStore
from ..plans.batches import run_redemption_batch
from ..sources.sinks import Sink
from ..session import checkpoint_dir
from ..sources.tables import Tables

REQUEST_SCHEMA = ("outlet_id string, giftcode string, qty int, year int, redeemno string, "
                  "request_ts timestamp_ntz")
REQUEST_COLUMNS = ("outlet_id", "giftcode", "qty", "year", "redeemno", "request_ts")


def redemption_round_writer(tables: Tables, sink: Sink, p: RedeemParams = RedeemParams(), first_round: int = 0,
                            balances: BalanceStore | None = None):
    """``foreachBatch`` function: micro-batch ``n`` is round ``first_round + n``."""

    def process(batch: DataFrame, batch_id: int) -> None:
        if balances is not None:
            balances.refresh()
        run_redemption_batch(tables.reloaded(), sink, batch.select(*REQUEST_COLUMNS), first_round + batch_id, p, balances)

    return process


def start_redemption_stream(
    spark: SparkSession,
    tables: Tables,
    sink: Sink,
    source_dir: str,
    checkpoint_location: str | None = None,
    p: RedeemParams = RedeemParams(),
    files_per_trigger: int | None = None,
    available_now: bool = False,
    first_round: int = 0,
    balances: BalanceStore | None = None,
) -> StreamingQuery:
    """Start the stream over Parquet request files in ``source_dir``.

    ``checkpoint_location`` must be on shared storage; by default it is a
    folder below the session's ``spark.checkpoint.dir``. Micro-batch ids
    restart at 0 with a new checkpoint: a new stream writing into a sink that
    already holds rounds must start after them (``first_round``), or it would
    replace them.
    """
    if checkpoint_location is None:
        checkpoint_location = f"{checkpoint_dir(spark).rstrip('/')}/tokoledger-redeem-stream"
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    writer = (reader.parquet(source_dir).writeStream
              .foreachBatch(redemption_round_writer(tables, sink, p, first_round, balances))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
