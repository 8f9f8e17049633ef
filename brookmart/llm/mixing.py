"""Mixing sources to target weights by Sainte-Lague apportionment. [native]

1. Sizes in words are summed per source. Targets come from the weights, under a ceiling, by
   filling up evenly (`targets`).
2. Blocks of equal size are apportioned: first among the sources, then each source's quota
   among its shards, both times to the highest quotients target / (2k - 1).
3. In every shard the blocks are put in a seeded order; whole rounds through the shard come
   first, then the blocks of the last round until the quota is used up.

A source is cut into shards of about `shard_rows` documents, so a source with a third of all
rows is many groups. Nothing but sums per source or shard passes a single task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

WEIGHTS = (5, 2, 1)


def seeded(*parts) -> Column:
    """32 bits of a digest of the parts, the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def sizes(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, source, size (words; null text: 0) and the columns `carried` of every row."""
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"), *carried)


def targets(sized: DataFrame, weights=WEIGHTS, share=1.5, ceiling=2) -> DataFrame:
    """source, source_size, source_rows and target of every source.

    Sources in code point order, null last, have the weights in turn. Their targets share
    `share` of all sizes by weight, none above `ceiling` times its size: a target is
    min(ceiling * size, weight * level), with the level at which the targets use the share up.
    Sources are sorted by ceiling / weight; once the first n of them are full, the level is what
    is left, divided by the weight that is left.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    full = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = (per.withColumn("weight", weight)
              .withColumn("left_size", F.sum("source_size").over(whole) * share
                          - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * ceiling)
              .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("level", F.col("left_size") / F.col("left_weight")))
    # The first source that its share at the current level does not fill fixes the level.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("source_size") * ceiling, F.struct(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level")))).over(whole)
    target = F.least((F.col("source_size") * ceiling).cast("double"),
                     F.coalesce(level["level"] * F.col("weight"), (F.col("source_size") * ceiling).cast("double")))
    return filled.withColumn("target", target).select("source", "source_size", "source_rows", "target")


def apportion(parties: DataFrame, votes: str, seats: str, name: list[str], within: list[str]) -> DataFrame:
    """Column `quota`: the `seats` of each group `within`, given to the highest quotients.

    The seats that a party has for certain are given first: a party's number of seats differs
    from its exact share by less than half a seat plus half a seat for each party times its
    share. Only the few seats between the two bounds are ranked.
    """
    group = Window.partitionBy(*within)
    exact = F.col(votes) / F.col("_all") * F.col(seats)  # null where nobody has votes
    slack = F.ceil(F.col("_n") / 2 * F.col(votes) / F.col("_all")) + 2
    bounds = (parties.withColumn("_all", F.nullif(F.sum(votes).over(group), F.lit(0)))
              .withColumn("_n", F.count(F.lit(1)).over(group))
              .withColumn("_sure", F.greatest(F.lit(0), F.coalesce(F.floor(exact) - slack, F.lit(0))).cast("long"))
              .withColumn("_most", F.coalesce(F.ceil(exact) + slack, F.lit(0)).cast("long")))
    open_seats = bounds.withColumn("_open", F.col(seats) - F.sum("_sure").over(group)).where("_most > _sure and " + votes + " > 0")
    offers = open_seats.select("*", F.explode(F.expr("sequence(_sure + 1, _most)")).alias("_seat"))
    best = Window.partitionBy(*within).orderBy((F.col(votes) / (2 * F.col("_seat") - 1)).desc(),
                                               *[F.col(c).asc_nulls_last() for c in name], "_seat")
    won = offers.withColumn("_rank", F.row_number().over(best)).where("_rank <= _open")
    extra = won.groupBy(*within, *[c for c in name if c not in within]).agg(F.count(F.lit(1)).alias("_won"))
    keys = list(dict.fromkeys([*within, *name]))
    left, right = bounds.alias("l"), extra.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return left.join(right, condition, "left").select(
        *[F.col(f"l.{c}") for c in parties.columns],
        (F.col("l._sure") + F.coalesce(F.col("r._won"), F.lit(0))).alias("quota"))


def mix(docs: DataFrame, weights=WEIGHTS, share=1.5, ceiling=2, seed=42, shard_rows=5000,
        blocks_per_source=200, max_block=512) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and spans of every row of `docs`.

    `taken` is the number of words that the mix takes of the row: `taken div size` whole copies
    and, from one more, the word ranges `spans` ([from, to), numbered from 0). A row is never
    taken more than `ceiling` times. Rows without words are not taken. Rows with the same doc_id
    are told apart by their order in the shard, and the whole is the same on every run.

    Sources are apportioned in blocks of the smallest target of a source with words, divided by
    `blocks_per_source`, at least 1 and at most `max_block`. A source's words are cut into blocks of
    its own target divided likewise, so a tiny source makes only its own blocks small; what a source
    takes differs from its target by the rounding to either size.
    """
    return _mix(sizes(docs), weights, share, ceiling, seed, shard_rows, blocks_per_source, max_block)


def _mix(sized, weights=WEIGHTS, share=1.5, ceiling=2, seed=42, shard_rows=5000, blocks_per_source=200, max_block=512, carried=()):
    """`mix` of rows with their sizes; the columns `carried` stay, and tell rows of one doc_id and size apart."""
    sized = materialise(sized, "sizes")
    per_source = materialise(targets(sized, weights, share, ceiling), "targets")
    whole = Window.partitionBy()
    block = F.greatest(F.lit(1), F.least(F.lit(max_block), F.floor(
        F.min(F.when(F.col("target") > 0, F.col("target"))).over(whole) / blocks_per_source))).cast("long")
    sources = (per_source.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
               .withColumn("shards", F.ceil(F.col("source_rows") / shard_rows))
               .withColumn("seats", F.round(F.sum("target").over(whole) / F.col("block")).cast("long"))
               .withColumn("everything", F.lit(0)))
    sources = apportion(sources, "target", "seats", ["source"], ["everything"])
    own = F.greatest(F.lit(1), F.least(F.lit(max_block), F.floor(F.col("target") / blocks_per_source))).cast("long")
    sources = sources.withColumn("words", F.col("quota") * F.col("block")).withColumn("block", F.coalesce(own, F.lit(1).cast("long")))
    sources = sources.withColumn("source_quota", F.round(F.col("words") / F.col("block")).cast("long"))
    sources = materialise(sources.drop("everything", "seats", "source_rows", "quota", "words"), "source-quotas")

    key = F.coalesce(F.col("d.doc_id").cast("string"), F.lit("null"))
    # The sources' table is read from a file: it is broadcast only if its size allows.
    rows = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left").select(
        "d.doc_id", "d.source", "d.size", *[f"d.{c}" for c in carried], "s.source_size", "s.target", "s.block", "s.source_quota",
        F.pmod(seeded(F.lit(seed), F.lit("shard"), key), F.col("s.shards")).alias("shard"),
        seeded(F.lit(seed), F.lit("place"), key).alias("place"))
    per_shard = rows.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block"))
    quotas = apportion(per_shard, "shard_size", "source_quota", ["source", "shard"], ["source"])
    quotas = materialise(quotas.select("source", "shard", "shard_size", F.least(
        F.col("quota") * F.col("block"), F.col("shard_size") * ceiling).alias("shard_quota")), "shard-quotas")

    placed = rows.alias("d").join(quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source"))
                                  & (F.col("d.shard") == F.col("q.shard"))).select("d.*", "q.shard_size", "q.shard_quota")
    shard = ["source", "shard"]
    in_place = Window.partitionBy(*shard).orderBy("place", "doc_id", "size", *carried).rowsBetween(Window.unboundedPreceding, 0)
    placed = (placed.withColumn("begin", F.sum("size").over(in_place) - F.col("size"))
              .withColumn("nth", F.row_number().over(Window.partitionBy(*shard).orderBy("place", "doc_id", "size", *carried)))
              .withColumn("rounds", F.expr("if(shard_size > 0, shard_quota div shard_size, 0L)"))
              .withColumn("last", F.col("shard_quota") - F.col("rounds") * F.col("shard_size")))
    # The pieces of a row lie between the borders of blocks; a row without words is one empty piece.
    first, final = F.expr("begin div block"), F.expr("greatest(begin, begin + size - 1) div block")
    pieces = (placed.select("*", F.explode(F.sequence(first, final)).alias("piece"))
              .withColumn("from", F.greatest(F.col("begin"), F.col("piece") * F.col("block")))
              .withColumn("length", F.least(F.col("begin") + F.col("size"), (F.col("piece") + 1) * F.col("block")) - F.col("from"))
              .withColumn("draw", seeded(F.lit(seed), F.lit("block"), F.coalesce("source", F.lit("")), "shard", "piece")))
    drawn = Window.partitionBy(*shard).orderBy("draw", "piece", "from", "nth").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("part", F.greatest(F.lit(0), F.least(
        F.col("length"), F.col("last") - (F.sum("length").over(drawn) - F.col("length")))))
    span = F.when(F.col("part") > 0, F.struct((F.col("from") - F.col("begin")).alias("from"),
                                              (F.col("from") - F.col("begin") + F.col("part")).alias("to")))
    return pieces.groupBy(*shard, "nth").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target", *carried)],
        (F.first("rounds") * F.first("size") + F.sum("part")).alias("taken"),
        F.array_sort(F.collect_list(span)).alias("spans")).select(
            "doc_id", "source", "size", "source_size", "target", "taken", "spans", *carried)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of `docs`.

    A row is repeated as often as it is taken whole; what is taken of one more copy is one more
    row whose text holds the words of `spans`, a space between words. Rows not taken go. Each row
    is mixed by itself, also where its doc_id is null or that of other rows; `n_chars` follows the
    text.
    """
    # The whole row in one column, so that no name of its columns is in the way; written with its
    # key, so that both reads of it see the same keys.
    keyed = materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "keyed")
    sized = sizes(keyed.select("row", "doc.doc_id", "doc.source", "doc.text"), "row")
    taken = _mix(sized, carried=("row",), **options).where("taken > 0").select("row", "size", "taken", "spans")
    rows = keyed.join(taken, "row")
    copies = rows.select("doc", F.explode(F.expr(
        "sequence(if(taken >= size, 1, 0), if(taken >= size, taken div size, 0))")).alias("copy")).where("copy > 0")
    cut = rows.where("taken % size > 0").withColumn("words", F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0)))
    text = F.array_join(F.flatten(F.expr("transform(spans, s -> slice(words, int(s.from + 1), int(s.to - s.from)))")), " ")
    cut = cut.withColumn("doc", F.col("doc").withField("text", text))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("doc", F.col("doc").withField("n_chars", F.length("doc.text").cast(docs.schema["n_chars"].dataType)))
    return copies.select("doc.*").unionByName(cut.select("doc.*"))
