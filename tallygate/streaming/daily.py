"""Daily metrics of a Silver stream, equal to the batch's at every moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallygate.operators import gold
from tallygate.plans import lake
from tallygate.sources import snapshots, tables


def publish(
    silver: DataFrame,
    root: str,
    checkpoint: str,
    until_drained: bool = False,
    date_basis: str = "written",
) -> StreamingQuery:
    """Keep Gold in ``root`` up to date with every row of a Silver stream, however late it comes.

    No watermark: each micro-batch leaves its sums by event day, and the days it touched are put
    together anew, in one snapshot that carries the batch's number (see ``plans.lake``). A batch
    that comes again is already in and is left out. Another stream, or this one from a new
    checkpoint, would count its messages a second time: it is refused. Rows without a readable
    time are the group of the null day, as in batch.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        base = snapshots.latest(spark, root)
        lake.refuse_other_use(base, lake.STREAM, date_basis)
        if base.facts.get("stream", stream) != stream:
            raise ValueError(
                f"{root} is kept by a stream with another checkpoint; start with an empty place"
            )
        if base.facts.get("last_batch", -1) >= batch_id:
            return
        name = snapshots.new_load()
        sums = gold.partial_metrics(batch, date_basis).withColumn("day", F.col("event_date"))
        schemas = {"sums": snapshots.schema_of(sums)}
        new_sums = snapshots.write(sums, root, "sums", name, "day")
        all_sums, new_gold, schemas["gold"] = lake.regild(
            spark, root, name, base, schemas, new_sums, set(new_sums)
        )
        facts = {"stream": stream, "last_batch": batch_id}
        facts |= {"use": lake.STREAM, "date_basis": date_basis}
        changed = {"sums": all_sums, "gold": {**base.parts("gold"), **new_gold}}
        snapshots.publish(spark, root, base.following(changed, schemas, facts))

    return tables.each_batch(silver, refresh, checkpoint, until_drained)
