"""Topic records (D1).

Two readers share one schema (``topic, partition, offset, timestamp, key,
value``):

* :func:`topic_log` - a bounded topic view derived from the ``events`` table
  (the stand-in for a Kafka topic; no broker exists here), with the number of
  topic partitions and the records per partition per batch as parameters;
* :func:`kafka_reader_options` - the ``readStream.format("kafka")`` options for
  a real broker (SRC-1..4), including ``startingOffsets`` built from the
  stored offsets.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table

DEFAULT_TOPIC = "events"
DEFAULT_PARTITIONS = 4
DEFAULT_BATCH_RECORDS = 250  # records per partition per micro-batch


def topic_log(spark: SparkSession, sf_dir: str, topic: str = DEFAULT_TOPIC,
              partitions: int = DEFAULT_PARTITIONS,
              batch_records: int = DEFAULT_BATCH_RECORDS) -> DataFrame:
    """Records of ``events`` as a topic: ``event_id`` is dense and follows
    ``ts``, so the record at ``event_id`` sits in partition
    ``event_id % partitions`` at offset ``event_id div partitions``. Batch ``b``
    holds offsets ``[b*batch_records, (b+1)*batch_records)`` of every
    partition. Pure projection: no shuffle, pruned scan."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.expr(f"event_id div {int(partitions)}").cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.expr(f"event_id div {int(partitions * batch_records)}").cast("bigint").alias("batch_id"),
    )


# The old consumer's reset names and the source's names.
RESET_NAMES = {"smallest": "earliest", "largest": "latest", "earliest": "earliest", "latest": "latest"}


def default_start(auto_offset_reset: str) -> str:
    """``auto.offset.reset`` (old ``smallest``/``largest`` or new names) ->
    the source's default start."""
    try:
        return RESET_NAMES[auto_offset_reset.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown auto.offset.reset value {auto_offset_reset!r}") from None


def select_topics(df: DataFrame, topics: str | list[str]) -> DataFrame:
    """SRC-4: the ``kafka.topics`` setting is a comma list."""
    names = [t.strip() for t in topics.split(",")] if isinstance(topics, str) else list(topics)
    return df.filter(F.col("topic").isin(names))


EARLIEST = -2  # Kafka source JSON: start of the partition
LATEST = -1    # Kafka source JSON: end of the partition


def starting_offsets_json(offsets: list[tuple[str, int, int]],
                          partition_counts: dict[str, int] | None = None,
                          default_start: str = "earliest") -> str:
    """``startingOffsets`` JSON for the Kafka source from (topic, partition,
    offset) rows. The Kafka source needs every partition named, so with
    ``partition_counts`` (the topics' current partition counts) partitions
    without a stored offset are added at the default position: that is the
    new-partition rule (OFF-7) for a live topic."""
    out: dict[str, dict[str, int]] = {}
    for t, p, o in offsets:
        out.setdefault(t, {})[str(int(p))] = int(o)
    fill = EARLIEST if default_start == "earliest" else LATEST
    for t, n in (partition_counts or {}).items():
        d = out.setdefault(t, {})
        for p in range(n):
            d.setdefault(str(p), fill)
    return json.dumps(out, sort_keys=True)


def kafka_reader_options(bootstrap: str, topics: str, start: list[tuple[str, int, int]] | None = None,
                         assign: bool = False, default_start: str = "earliest",
                         min_partitions: int | None = None,
                         partition_counts: dict[str, int] | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")`` (SRC-1..4).

    * no stored offsets -> ``subscribe`` + ``startingOffsets=<default_start>``;
    * stored offsets, Subscribe mode -> ``subscribe`` + JSON offsets;
    * stored offsets, Assign mode (SRC-3) -> ``assign`` only the stored partitions.

    ``failOnDataLoss=false`` lets the source move past offsets that expired
    (OFF-8 clamps them in the bounded form)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "failOnDataLoss": "false"}
    if start:
        if assign:
            parts: dict[str, list[int]] = {}
            for t, p, _ in start:
                parts.setdefault(t, []).append(int(p))
            opts["assign"] = json.dumps({t: sorted(v) for t, v in parts.items()}, sort_keys=True)
            opts["startingOffsets"] = starting_offsets_json(start)
        else:
            opts["subscribe"] = topics
            opts["startingOffsets"] = starting_offsets_json(start, partition_counts, default_start)
    else:
        opts["subscribe"] = topics
        opts["startingOffsets"] = default_start
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def kafka_records(raw: DataFrame) -> DataFrame:
    """Kafka source rows (key/value BINARY) -> the topic record schema."""
    return raw.select("topic", "partition", "offset",
                      F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))
