"""A keyed changelog on shared storage: a base in hash buckets, and the batches after it.

    <path>/tail/batch=N     what batch N appended; a replay replaces it
    <path>/base/upto=N      all batches up to N, folded; sorted by key within buckets

A folder counts once Spark's writer has finished it (`_SUCCESS`), so a new base takes effect at once
and as a whole. A reader takes the newest base and the batches after it; batch N takes the newest base
before N, so that a replay of it reads what its first run read. The driver lists folders, never
rows.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.sinks.topics import latest_per_key

FINISHED = "_SUCCESS"


def folder_of(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def finished(spark, path, name):
    """The numbers N of the finished folders `name=N` in `path`, ascending; none where it is missing."""
    fs, place = folder_of(spark, path)
    if not fs.exists(place):
        return []
    numbers = []
    for status in fs.listStatus(place):
        folder, _, number = status.getPath().getName().partition("=")
        mark = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), FINISHED)
        if folder == name and number.lstrip("-").isdigit() and fs.exists(mark):
            numbers.append(int(number))
    return sorted(numbers)


def sortable(*columns):
    """Keys as one text that sorts whole numbers by value: each with its length before it."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat_ws("/", *[F.concat(F.lpad(F.length(t).cast("string"), 5, "0"), F.lit(":"), t) for t in texts])


#: From so many keys on, a filter of them spares other rows the shuffle of a join.
MANY_KEYS = 10_000
#: Slots in a block of the filter.
BLOCK = 1 << 15


def may_be_of(rows, column, keys, count, bits_per_key=12, max_bits=1 << 28):
    """The rows whose `column` may be one of `keys` (one column, about `count` rows): all that are, and a few others.

    A blocked Bloom filter as a table: a hash picks a block and two slots in it. It has at most `max_bits`, so it may
    be broadcast; from some 20 M keys on it separates less, and more rows are kept.
    """
    blocks = -(-min(max_bits, max(BLOCK, count * bits_per_key)) // BLOCK)

    def places(name):
        h = F.xxhash64(name)
        slots = [F.shiftrightunsigned(h, 49), F.shiftrightunsigned(F.shiftleft(h, 15), 49)]
        return F.pmod(h, F.lit(blocks)).alias("_block"), F.array(*[x.cast("int") for x in slots]).alias("_slots")

    listed = keys.select(*places(keys.columns[0])).select("_block", F.explode("_slots").alias("slot"))
    words = listed.groupBy("_block", F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("mask"))
    filled = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("_set"))
    # An array: each look-up would walk through a map.
    filled = filled.select("_block", F.transform(F.sequence(F.lit(0), F.lit((BLOCK >> 6) - 1)), lambda i: F.coalesce(F.col("_set")[i], F.lit(0))).alias("_words"))
    found = rows.select("*", *places(column)).join(F.broadcast(filled), "_block")
    for i in range(2):
        found = found.where(F.expr(f"shiftrightunsigned(_words[shiftright(_slots[{i}], 6)], _slots[{i}] & 63) & 1") == 1)
    return found.select(*rows.columns)


class Store:
    """Rows by key, appended in batches; what they mean is up to the reader.

    `schema` has the key columns and any others but those of `OWN`. Keys that it does not have are read from the
    rows appended, and only their bucket and place are stored. `buckets` of a base should hold about a task's worth of rows each.
    """

    OWN = "batch_id bigint, bucket int, place string"

    def __init__(self, path, schema, keys, buckets=32):
        from pyspark.sql import types as T
        self.path, self.keys, self.buckets = path.rstrip("/"), list(keys), buckets
        given = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self.schema = T.StructType([*given.fields, *T._parse_datatype_string(self.OWN).fields])

    def _placed(self, df):
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumns({"bucket": bucket, "place": sortable(*self.keys)}).select(*self.schema.fieldNames())

    def append(self, df, batch_id):
        """Write the rows of a batch, in place of what an earlier run of it wrote.

        Rows are not shuffled for it: each task writes its own, sorted, so that pages have short ranges of buckets and keys.
        """
        rows = self._placed(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        self._write(rows, f"{self.path}/tail/batch={batch_id}")

    @staticmethod
    def _write(rows, path):
        rows.sortWithinPartitions("bucket", "place").write.mode("overwrite").parquet(path)

    def create(self, spark):
        """An empty base, where there is nothing yet: readers by path find a schema."""
        if not finished(spark, f"{self.path}/base", "upto"):
            spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.path}/base/upto=-1")

    def _paths(self, spark, upto=None, replay=None):
        """The base that counts for batch `replay` (or the newest one) and the batches after it."""
        bases = [n for n in finished(spark, f"{self.path}/base", "upto") if replay is None or n < replay]
        base = bases[-1:]
        tail = [n for n in finished(spark, f"{self.path}/tail", "batch") if (not base or n > base[0]) and (upto is None or n <= upto)]
        return [*(f"{self.path}/base/upto={n}" for n in base), *(f"{self.path}/tail/batch={n}" for n in tail)]

    def read(self, spark, upto=None, replay=None):
        """All rows, or those of the batches up to `upto`, as batch `replay` sees them."""
        paths = self._paths(spark, upto, replay)
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def batch(self, spark, batch_id):
        """The rows that a batch appended."""
        return spark.read.schema(self.schema).parquet(f"{self.path}/tail/batch={batch_id}")

    def before(self, spark, batch_id):
        """The rows before a batch, of the buckets and the range of keys that it holds.

        Both prune the scan: at most `buckets` numbers and two keys go through the driver.
        """
        buckets, low, high = self.batch(spark, batch_id).agg(F.collect_set("bucket"), F.min("place"), F.max("place")).first()
        rows = self.read(spark, upto=batch_id - 1, replay=batch_id)
        if low is None:
            return rows.limit(0)
        near = rows.where(F.col("place").between(low, high))
        return near.where(F.col("bucket").isin(buckets)) if len(buckets) < self.buckets else near

    @staticmethod
    def of_places(rows, places, count):
        """Of `rows` those of the given places (one column, so many rows), and where there are many also a few others."""
        if not count:
            return rows.limit(0)
        if count >= MANY_KEYS:
            return may_be_of(rows, "place", places, count)
        return rows.join(places.distinct(), "place", "left_semi")

    def around(self, spark, batch_id):
        """The rows, up to and with a batch, of the keys that the batch holds."""
        own = self.batch(spark, batch_id)
        return own.unionByName(self.before(spark, batch_id).join(own.select("place").distinct(), "place", "left_semi"))

    def fold(self, spark, upto, merge=None):
        """Write the base of all batches up to `upto`; `merge` may leave rows out that no reader needs.

        Readers go on with the older base until this one is finished. Batches that the base before
        this one already holds, and bases before that, are removed: a reader may run as long as
        the time between two folds.
        """
        bases = finished(spark, f"{self.path}/base", "upto")
        if upto in bases:
            return
        rows = self.read(spark, upto=upto, replay=upto + 1)
        merged = merge(rows) if merge else rows
        if merge and set(self.keys) <= set(self.schema.fieldNames()):
            merged = self._placed(merged)
        # One exchange, whose small partitions adaptive execution joins and whose large ones (a hot
        # key) it splits: few files, each with a short range of buckets and keys.
        self._write(merged.hint("rebalance", "bucket"), f"{self.path}/base/upto={upto}")
        held = [n for n in bases if n < upto][-1:]
        if held:
            fs, _ = folder_of(spark, self.path)
            old = [*(f"base/upto={n}" for n in bases if n < held[0]),
                   *(f"tail/batch={n}" for n in finished(spark, f"{self.path}/tail", "batch") if n <= held[0])]
            for folder in old:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}"), True)


class KeyedTable(Store):
    """Current rows by key: upserts and, by a true `_deleted`, deletes.

    `order` orders the changes of a key within a batch (else one of them counts), and with `across` also
    those of different batches; without it the later batch counts. Reads aggregate the base, which has
    a row for each key, and the batches after it; folding keeps deletes, so that an older batch that is
    run again stays outranked. Readers keep the path of the table.
    """

    def __init__(self, path, schema, keys, order=(), across=False, buckets=32, fold_every=20):
        super().__init__(path, schema, keys, buckets)
        self.order, self.fold_every = [order] if isinstance(order, str) else list(order), fold_every
        self.rank = [*self.order, "batch_id"] if across else ["batch_id", *self.order]

    def _newest(self, rows):
        return latest_per_key(rows, self.keys, self.rank, drop_deleted=False)

    def upsert(self, batch, batch_id):
        """Batch writer: the newest change of each key."""
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(batch.sparkSession, batch_id - 1, self._newest)
        order = self.order or [c for c in batch.columns if c not in self.keys][:1]
        self.append(latest_per_key(batch, self.keys, order, drop_deleted=False), batch_id)

    def current(self, spark):
        """The newest row of every key that is not deleted."""
        newest = latest_per_key(self.read(spark), self.keys, self.rank)
        return newest.drop("batch_id", "bucket", "place")

    def among(self, spark, keys):
        """The current rows of the keys in `keys` (a DataFrame with the key columns): look-ups that
        scan only the buckets, and the range of keys, that are asked for."""
        asked = self._placed(keys.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct().select(
            *[F.col(k) if k in self.keys else F.lit(None).cast(self.schema[k].dataType).alias(k) for k in self.schema.fieldNames() if k not in ("bucket", "place")]))
        buckets, low, high = asked.agg(F.collect_set("bucket"), F.min("place"), F.max("place")).first()
        rows = self.read(spark).where(F.col("place").between(F.lit(low), F.lit(high)))
        if len(buckets) < self.buckets:
            rows = rows.where(F.col("bucket").isin(buckets))
        newest = latest_per_key(rows.join(asked.select("place"), "place", "left_semi"), self.keys, self.rank)
        return newest.drop("batch_id", "bucket", "place")
