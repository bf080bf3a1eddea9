"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

All words the mix takes are dealt out as equal blocks: first to the sources, whose votes are their
targets, then within a source to its shards, whose votes are their sizes. A seat goes to the
highest quotient votes / (2 * seats + 1). A shard lays its documents out in seeded order, and its
quota of blocks is a number of whole rounds plus a run of blocks from a seeded place on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
# Words of a block: the step in which quotas are given.
BLOCK = 16
# Words of a shard: bounds what one task sorts.
SHARD = 1 << 19


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """Target words of every source of (source, size): source, source_size, target.

    Sources by code point, null last, weigh ``weights`` in turn. The excess over ``most`` times a
    source's size goes to the others by weight until none is above: sources fill up in the order
    of size by weight, and the level at which the rest share is the greatest of all steps.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1
    )
    full = Window.orderBy(most * F.col("source_size") / F.col("weight"), "place")
    before = F.coalesce(
        F.sum(most * F.col("source_size")).over(full.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    weight_left = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("level", (share * F.col("all_words") - before) / weight_left)
        .withColumn("level", F.max("level").over(every))
        .withColumn(
            "target",
            F.least(
                (most * F.col("source_size")).cast("double"), F.col("weight") * F.col("level")
            ),
        )
        .select("source", "source_size", "target")
    )


def sainte_lague(parties: DataFrame, group: list[str], key: str) -> DataFrame:
    """``parties`` with ``given``, how many of the group's ``seats`` a party gets for its ``votes``.

    With S parties no party's number is further than 1 + S / 2 times its share of the votes from
    its exact quota, so only seats within that reach compete, about four a party in all. Equal
    quotients go to the smaller key. Groups without votes must have no seats.
    """
    of_group = Window.partitionBy(*group)
    votes = F.sum("votes").over(of_group)
    part = F.when(votes > 0, F.col("votes") / votes).otherwise(0.0)
    reach = part * F.count("*").over(of_group) / 2 + 1
    near = (
        parties.withColumn("quota", F.col("seats") * part)
        .withColumn("reach", reach)
        .withColumn("low", F.greatest(F.lit(0), F.floor(F.col("quota") - F.col("reach"))))
        .withColumn("rest", F.col("seats") - F.sum("low").over(of_group))
        .withColumn("high", F.ceil(F.col("quota") + F.col("reach")))
    )
    best = Window.partitionBy(*group).orderBy(F.desc("quotient"), key)
    won = (
        near.withColumn("seat", F.explode(F.sequence("low", "high")))
        .withColumn("quotient", F.col("votes") / (2 * F.col("seat") + 1))
        .withColumn("won", (F.row_number().over(best) <= F.col("rest")).cast("long"))
    )
    return won.groupBy(*parties.columns, "low").agg(
        (F.col("low") + F.sum("won")).cast("long").alias("given")
    ).drop("low")


def source_mix(
    docs: DataFrame,
    keep: tuple[str, ...] = (),
    seed: int = 7,
    block: int = BLOCK,
    shard_words: int = SHARD,
) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken, first, rounds.

    ``taken`` counts words with repeats: ``rounds`` whole copies and a part, whose first word is
    ``first`` (null without a part; a part that meets the end of the shard's row of documents goes
    on at its start, so it may begin in a document's last words and end in its first).
    Null and empty texts have size 0 and are not taken. Null sources are one source, the last.
    Repeated rows are documents of their own; rows without doc_id are dealt to shards by their
    text, so that only equal ones of them meet in one. ``keep`` names columns to carry along.

    The word counts are stored once; a hot source is spread over shards of about ``shard_words``
    words, the number of which comes from its size, so no task sorts more.
    """
    # Rows without doc_id are told apart by their text, so that they spread as well.
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit("")).alias("name")
    mark = F.md5(F.concat_ws("|", F.lit(seed), "name"))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), name)
    sized = stored(sized, "mix-sizes")
    targets = source_targets(sized)
    seats = targets.withColumn("votes", F.col("target")).withColumn(
        "seats", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    )
    quotas = stored(
        sainte_lague(seats.withColumn("every", F.lit(0)), ["every"], "source").select(
            "source",
            "source_size",
            "target",
            F.ceil(F.col("source_size") / shard_words).alias("n_shards"),
            F.col("given").alias("quota"),
        ),
        "mix-quotas",
    )

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with their source's figures and their shard."""
        shard = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % F.col("n_shards")
        return (
            rows.withColumn("mark", mark)
            .withColumnRenamed("source", "from")
            .join(quotas, F.col("from").eqNullSafe(F.col("source")))
            .drop("from")
            .withColumn("shard", F.when(F.col("size") > 0, shard))
        )

    shards = (
        placed(sized)
        .where("size > 0")
        .groupBy("source", "shard")
        .agg(F.sum("size").alias("votes"), F.max("quota").alias("seats"))
    )
    shards = sainte_lague(shards, ["source"], "shard").select(
        F.col("source").alias("in_source"),
        F.col("shard").alias("in_shard"),
        F.col("votes").alias("shard_size"),
        F.least(F.col("given") * block, 2 * F.col("votes")).alias("words"),
    )
    shards = (
        shards.withColumn("rounds", F.floor(F.col("words") / F.col("shard_size")))
        .withColumn("run", F.col("words") - F.col("rounds") * F.col("shard_size"))
        .withColumn(
            "start",
            F.conv(
                F.substring(
                    F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("in_source", F.lit("")), "in_shard")),
                    1,
                    8,
                ),
                16,
                10,
            ).cast("long")
            % F.ceil(F.col("shard_size") / block)
            * block,
        )
    )
    rows = sized
    if keep:
        rows = docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), name,
            *(F.col(c).alias(f"kept_{c}") for c in keep),
        )
    rows = placed(rows)
    carried = [f"kept_{c}" for c in keep]
    order = Window.partitionBy("source", "shard").orderBy("mark", "doc_id", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    stop = F.col("start") + F.col("run")

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(
            F.lit(0), F.least(F.col("end"), b) - F.greatest(F.col("end") - F.col("size"), a)
        )

    taken = (
        rows.where("size > 0")
        .withColumn("end", end)
        .join(
            shards,
            F.col("source").eqNullSafe(F.col("in_source")) & (F.col("shard") == F.col("in_shard")),
        )
        .withColumn("here", overlap(F.col("start"), stop))
        .withColumn(
            "wrapped", overlap(F.lit(0), stop - F.col("shard_size"))
        )
        .withColumn("taken", F.col("rounds") * F.col("size") + F.col("here") + F.col("wrapped"))
        .withColumn(
            "first",
            F.when(
                F.col("here") > 0,
                F.greatest(F.col("start") - (F.col("end") - F.col("size")), F.lit(0)),
            ).when(F.col("wrapped") > 0, F.lit(0)),
        )
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", "first", "rounds"]
    empty = (
        rows.where("size = 0")
        .withColumn("taken", F.lit(0).cast("long"))
        .withColumn("first", F.lit(None).cast("long"))
        .withColumn("rounds", F.lit(0).cast("long"))
    )
    return taken.select(*columns, *carried).unionByName(empty.select(*columns, *carried))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    Of each document there is a row for every whole copy that the mix takes, and one with the
    words of a part, joined by spaces; documents that it does not take are gone, so null, empty and
    blank texts are. Where n_chars is a column it counts the text given. Rows without doc_id or
    source are kept like others, repeated rows are documents of their own, and no documents give
    none; all other columns, of any name, are carried along.
    """
    columns = docs.columns
    mix = source_mix(docs, keep=tuple(columns))
    words = F.regexp_extract_all("kept_text", F.lit(WORD), F.lit(0))
    part = F.col("taken") - F.col("rounds") * F.col("size")
    ring = F.concat(words, words)
    cut = F.when(
        part > 0, F.array_join(F.slice(ring, (F.col("first") + 1).cast("int"), part.cast("int")), " ")
    )
    whole = F.array_repeat(F.col("kept_text"), F.col("rounds").cast("int"))
    texts = F.concat(whole, F.when(part > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    out = mix.where("taken > 0").withColumn("given", F.explode(texts))
    instead = {"text": F.col("given"), "n_chars": F.length("given").cast("long")}
    return out.select(*(instead.get(c, F.col(f"kept_{c}")).alias(c) for c in columns))
