"""Candidate pairs of records that arrive in files, met with all records that arrived before."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched, chain

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

from linkwell.functions.text import name_prefix
from linkwell.schema import CANDIDATE_ID, S1_ID

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
MEMORY = "spark.sql.streaming.stateStore.rocksdb"
RECORDS = "array<struct<id: string, name: string>>"
MET = f"by_name boolean, ones {RECORDS}, others {RECORDS}"
AT_ONCE = 1_000
STORED = "id string", "name string"


def block_keys(records: DataFrame, prefix_length: int = 4, cells: int = 1) -> DataFrame:
    """A row for each block key of each named record: its exact name, and its country with a prefix of its name.

    With ``cells``, each key is a grid of so many rows and columns: an S1 record is in
    one row and all columns, a target in one column and all rows, so that a pair meets
    once and no task and no state has more than its share of a hot key.
    """
    key = lambda by, k, country: F.struct(F.lit(by).alias("by"), country.alias("country"), k.alias("key"))
    keys = F.array(
        key(0, F.col("name_norm"), F.lit("")), key(prefix_length, name_prefix(F.col("name_norm"), prefix_length), F.col("country_norm"))
    )
    own, ours = F.pmod(F.xxhash64("entity_id"), F.lit(cells)).cast("int"), F.col("source") == "S1"
    every = F.sequence(F.lit(0), F.lit(cells - 1))
    grid = F.transform(every, lambda i: F.struct(F.when(ours, own).otherwise(i).alias("row"), F.when(ours, i).otherwise(own).alias("column")))
    named = records.filter((F.col("name_norm") != "") & F.col("entity_id").isNotNull())
    return named.select("entity_id", "name_norm", ours.alias("ours"), F.explode(keys).alias("k"), grid.alias("grid")).select(
        "entity_id", "name_norm", "ours", "k.*", F.explode("grid").alias("cell")
    )


def _meeting() -> StatefulProcessor:
    """Made in a function, so that workers get it by value."""

    class Meeting(StatefulProcessor):
        """Ids and names of both sides of a block key that have arrived."""

        def init(self, handle) -> None:
            self.ours = handle.getMapState("ours", *STORED)
            self.theirs = handle.getMapState("theirs", *STORED)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
            new = {True: {}, False: {}}
            for r in rows:
                state = self.ours if r.ours else self.theirs
                if r.entity_id not in new[r.ours] and not state.containsKey((r.entity_id,)):
                    new[r.ours][r.entity_id] = r.name_norm
            by_name = key[0] == 0
            both = {o: [*new[o].items()] for o in (True, False)}
            if new[True]:
                yield from self._met(by_name, both[True], chain(self._known(self.theirs), both[False]))
            if new[False]:
                yield from self._met(by_name, self._known(self.ours), both[False])
            for ours, state in ((True, self.ours), (False, self.theirs)):
                for i, name in new[ours].items():
                    state.updateValue((i,), (name,))

        def _known(self, state) -> Iterator[tuple[str, str]]:
            return ((i, name) for (i,), (name,) in state.iterator())

        def _met(self, by_name, ones, others) -> Iterator[Row]:
            """Both sides, some records at a time: a key's rows are held until its last one, so their pairs are made later."""
            ones = [*batched(({"id": i, "name": n} for i, n in ones), AT_ONCE)]
            for some in batched(({"id": i, "name": n} for i, n in others), AT_ONCE):
                for group in ones:
                    yield Row(by_name=by_name, ones=[*group], others=[*some])

        def close(self) -> None:
            pass

    return Meeting()


def link_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    schema: StructType,
    prefix_length: int = 4,
    cells: int = 1,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append to ``output_path`` all new pairs of the Parquet files of normalized records not yet taken.

    A pair has equal non-empty names, or equal countries and name prefixes. Keyed state,
    in RocksDB under the checkpoint, holds which ids of either side each block key has
    met; it survives restarts. However the records are cut into files and batches, and
    in whatever order they arrive, the pairs of all runs together are those of one
    batch job, each once. A record that arrives again changes nothing; of records with
    one id the first counts. Records without an id or name meet nothing. Returns the
    query, which ends by itself once all files are taken.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(input_path)
    keyed = block_keys(arriving, prefix_length, cells).groupBy("by", "country", "key", "cell")
    # All stores of an executor share one bounded cache; else each of the many keeps buffers of its own.
    wanted = {PROVIDER: ROCKSDB, f"{MEMORY}.boundedMemoryUsage": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        met = keyed.transformWithState(_meeting(), MET, "Append", "None")
        one = met.select("by_name", "others", F.explode("ones").alias("one"))
        pairs = one.select("by_name", "one", F.explode("others").alias("other")).filter("by_name OR one.name != other.name")
        pairs = pairs.select(F.col("one.id").alias(S1_ID), F.col("other.id").alias(CANDIDATE_ID))
        return (
            pairs.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint_path)
            .option("path", output_path)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
