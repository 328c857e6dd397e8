"""Ways up trees of any depth, by doubling.

Each row holds a node's way up as far as it is known. A round joins it with the way of the node at its end, so ways double and a tree of
depth d takes log2(d) rounds; a round is written, so plans stay small. A round in which no way reaches its top while some are still open means that
those lead in circles: of all ways into a tree, the next longer ones end in each round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import generations
from shelfwise.sources.catalog import shared_folder


def _stored(rows: DataFrame, at: str) -> DataFrame:
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def ways_up(nodes: DataFrame, value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Of nodes (id, parent_id, and a value column if named): (id, top, above, ids, values) with the topmost node, what stands as its parent, and the
    way from it down to the node; and (id) of nodes whose way leads in a circle. Without a value there are no ids and values.

    A null id is no node; a parent that isn't a node, or is null, makes a top. Of rows that share an id one stays, the least."""
    spark = nodes.sparkSession
    at = f"{shared_folder(spark)}/ways-{uuid.uuid4().hex}"
    carried = [F.col(value).alias("value")] if value else []
    each = nodes.filter("id is not null").select("id", "parent_id", *carried)
    one = each.groupBy("id").agg(F.min(F.struct(*[c for c in each.columns if c != "id"])).alias("n")).select("id", "n.*")
    known = one.select(F.col("id").alias("known"))
    lists = [F.array("id").alias("ids"), F.array("value").alias("values")] if value else []
    up = F.col("known").alias("up")  # the node above the way so far; null at the top
    now = _stored(one.join(known, one["parent_id"] == known["known"], "left").select("id", F.col("id").alias("top"), F.col("parent_id").alias("above"), up, *lists), f"{at}/0")
    done, open_, k = now.filter("up is null"), now.filter("up is not null"), 0
    left = open_.count()
    while left:
        k += 1
        ahead = done.union(open_).select(F.col("id").alias("at"), F.col("top").alias("top_"), F.col("above").alias("above_"), F.col("up").alias("up_"), *([F.col("ids").alias("ids_"), F.col("values").alias("values_")] if value else []))
        lists = [F.concat("ids_", "ids").alias("ids"), F.concat("values_", "values").alias("values")] if value else []
        longer = open_.join(ahead, open_["up"] == ahead["at"]).select("id", F.col("top_").alias("top"), F.col("above_").alias("above"), F.col("up_").alias("up"), *lists)
        now = _stored(longer, f"{at}/{k}")
        done, open_ = done.union(now.filter("up is null")), now.filter("up is not null")
        before, left = left, open_.count()
        if left == before:
            break
    return done.drop("up"), open_.select("id")


def tops(nodes: DataFrame) -> DataFrame:
    """(id, top) of nodes (id, parent_id); nodes in or below a circle are an error."""
    done, circles = ways_up(nodes)
    if (first := circles.agg(F.min("id")).first()[0]) is not None:
        raise ValueError(f"{first} leads in a circle")
    return done.select("id", "top")


def forget(nodes: DataFrame) -> None:
    """Deletes the rounds behind a result of `ways_up`, once it is written elsewhere."""
    spark = nodes.sparkSession
    for path in {f.rsplit("/", 2)[0] for f in nodes.inputFiles()}:
        generations.removed(spark, path)
