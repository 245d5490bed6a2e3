"""Problem 4: splits in which all records linked by a speaker or a recording stay together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..runtime import cut
from .ids import language_code, recording_key, speaker_key, split_name, tidy
from .skew import looked_up

RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}
SALT = "split-v1"
#: Rounds after which components that do not settle raise an error; the number needed grows with the logarithm of the longest chain.
MAX_ROUNDS = 60


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpointed rows and their number, counted as they are written (a task that runs twice may count twice)."""
    seen = Observation()
    df = cut(df.observe(seen, F.count("*").alias("n")))
    return df, seen.get["n"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the smallest node linked to it.

    Alternating large-star and small-star over edges that point from the larger
    node to the smaller: the large star links every node to the smallest
    neighbour of the node it points to; the small star links all that a node
    points to, and the node, to the smallest of them; until the edges are stars.
    A node's smallest neighbour is a partially aggregated minimum, and hubs are
    told theirs by broadcast (`looked_up`), so no group is gathered. A round is
    one job, which writes the edges to the checkpoint folder and counts on the
    way what it changed. Loops and repeated edges are allowed.
    """
    a, b = F.col("a"), F.col("b")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).where(F.col("node").isNotNull()).distinct()
    current, total = _counted(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    for _ in range(MAX_ROUNDS):
        if not total:
            break
        kept = Observation()
        least = current.groupBy(a.alias("b")).agg(F.min("b").alias("m"))
        large = looked_up(current, "b", least, total).select("a", F.coalesce("m", "b").alias("b"), F.col("m").isNotNull().alias("moved"))
        star = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        # A node that is not the least one its edge's owner points to is linked to that one, and so is the owner.
        pair = F.when(b == F.col("m"), F.struct("a", "b")).otherwise(F.struct(b.alias("a"), F.col("m").alias("b")))
        changed = F.count_if(F.col("moved") | (b != F.col("m"))).alias("n")
        current, total = _counted(star.select(pair.alias("x"), "b", "m", "moved").observe(kept, changed).select("x.*").distinct())
        if not kept.get["n"]:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(current.select(a.alias("node"), b.alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def keyed_rows(manifest: DataFrame) -> DataFrame:
    """(line_number, split, dataset, language, r, s, entity) of every row: its recording and real speaker, and one of them (else the row) as entity."""
    return manifest.select(
        "line_number",
        split_name(F.col("split")).alias("split"),
        tidy(F.col("dataset")).alias("dataset"),
        F.coalesce(language_code(F.col("language")), F.lit("?")).alias("language"),
        F.concat(F.lit("r:"), recording_key(F.col("audio_id"))).alias("r"),
        F.concat(F.lit("a:"), speaker_key(F.col("speaker_id"))).alias("s"),
    ).withColumn("entity", F.coalesce("r", "s", F.concat(F.lit("l:"), F.col("line_number").cast("string"))))


def entity_components(rows: DataFrame) -> DataFrame:
    """(entity, component) of every entity of keyed rows that another is linked to.

    Rows are related by a real speaker or by the source recording read from
    audio_id. The graph is built over entities, not rows: a row is an edge
    between its recording and its speaker, and equal edges collapse before the
    components are sought. Speakers sort before recordings, so the hubs of the
    first round are what edges point to.
    """
    edges = rows.where(F.col("r").isNotNull() & F.col("s").isNotNull()).select(F.col("r").alias("a"), F.col("s").alias("b"))
    return connected_components(edges).select(F.col("node").alias("entity"), "component")


def grouped_rows(manifest: DataFrame) -> DataFrame:
    """(line_number, split, dataset, language, component) of every row; a row with neither recording nor speaker is a component of its own."""
    rows, total = _counted(keyed_rows(manifest))
    of = entity_components(rows).withColumnRenamed("component", "m")
    return looked_up(rows.drop("r", "s"), "entity", of, total).select(
        "line_number", "split", "dataset", "language", F.coalesce("m", "entity").alias("component")
    )


def straddling(manifest: DataFrame) -> DataFrame:
    """(line_number, group_line) of every row of a group that now stands in two or more splits.

    group_line is the group's smallest line number. Rows without a split are
    given with their group but do not make it straddle. An empty table gives no
    rows. Rows are summed up to their entities first and components to their
    entities, so rows are joined once.
    """
    rows, total = _counted(keyed_rows(manifest))
    least = (F.min("line").alias("line"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    entities = rows.groupBy("entity").agg(F.min("line_number").alias("line"), F.min("split").alias("lo"), F.max("split").alias("hi"))
    known, number = _counted(entities.join(entity_components(rows), "entity", "left").withColumn("component", F.coalesce("component", "entity")))
    groups = known.groupBy("component").agg(*least).where(F.col("lo") < F.col("hi")).select("component", F.col("line").alias("m"))
    told = looked_up(known.select("entity", "component"), "component", groups, number)
    chosen = told.where(F.col("m").isNotNull()).select("entity", "m")
    return looked_up(rows.select("line_number", "entity"), "entity", chosen, total).where(F.col("m").isNotNull()).select(
        "line_number", F.col("m").alias("group_line"))


def _checked(ratios: dict[str, float] | None) -> dict[str, float]:
    ratios = ratios or RATIOS
    if list(ratios) != ["train", "val", "test"] or abs(sum(ratios.values()) - 1) > 1e-6 or min(ratios.values()) <= 0:
        raise ValueError("ratios of train, val and test must be positive and sum to 1")
    return ratios


def _by_component(rows: DataFrame, total: int, chosen: DataFrame) -> DataFrame:
    """(line_number, component, split) from each component's split."""
    told = looked_up(rows.select("line_number", "component"), "component", chosen.select("component", F.col("split").alias("m")), total)
    return told.select("line_number", "component", F.col("m").alias("split"))


def assign(manifest: DataFrame, ratios: dict[str, float] | None = None, salt: str = SALT) -> DataFrame:
    """(line_number, component, split): whole components to train, val and test in the given proportions.

    The hash of a component's identifier is a place in [0, 1), and the ranges of
    the splits cut that interval. A component's place never changes while its
    identifier does not, whatever rows come; large numbers keep the proportions,
    overall and in every dataset and language. Only components of more rows than
    half of the smallest split has are not left to chance: they go to train,
    whose range gives up as much for them, so the ranges move as little as the
    share of the giants does.
    """
    ratios = _checked(ratios)
    rows, number = _counted(grouped_rows(manifest))
    groups = cut(rows.groupBy("component").agg(F.count("*").alias("n")))
    total = F.sum("n")
    all_rows = groups.agg(F.coalesce(total, F.lit(0)).alias("rows"))
    giant = F.col("n") > F.col("rows") * (min(ratios["val"], ratios["test"]) / 2)
    sized = groups.crossJoin(F.broadcast(all_rows)).withColumn("giant", giant)
    plain = sized.agg(F.coalesce(F.sum(F.when(~F.col("giant"), F.col("n"))), F.lit(0)).alias("plain"))
    place = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}|"), F.col("component")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    # Of the rows that are no giants', so many are still train's; one row is broadcast.
    train = F.greatest(F.col("plain") - F.col("rows") * (1 - ratios["train"]), F.lit(0.0)) / F.greatest(F.col("plain"), F.lit(1))
    val = train + (1 - train) * (ratios["val"] / (ratios["val"] + ratios["test"]))
    chosen = sized.crossJoin(F.broadcast(plain)).select(
        "component", F.when(F.col("giant") | (place < train), "train").when(place < val, "val").otherwise("test").alias("split"))
    return _by_component(rows, number, chosen)


def assign_by_quota(manifest: DataFrame, ratios: dict[str, float] | None = None, salt: str = SALT) -> DataFrame:
    """(line_number, component, split) as `assign` does, but with proportions as near as can be in every dataset and language.

    Components are ordered by the hash of their identifier within their
    stratum, the dataset and language of most of their rows, and the running
    count of rows is cut into proportional ranges, so new rows may move a
    component. A component larger than half the smallest range goes to train
    first and the ranges shrink accordingly; what a giant takes beyond its
    stratum's train share is spared in the other strata. The running count is
    taken over hash buckets first, so no stratum is sorted in one task. Strata
    are joined by shuffles, as `dataset` is free text.
    """
    ratios = _checked(ratios)
    rows, number = _counted(grouped_rows(manifest))
    cells = rows.groupBy("component", "dataset", "language").agg(F.count("*").alias("n"))
    groups = cells.groupBy("component").agg(
        F.sum("n").alias("n"),
        F.max(F.struct("n", "dataset", "language")).alias("most"),
    ).select("component", "n", F.col("most.dataset").alias("dataset"), F.col("most.language").alias("language"))
    key = ["dataset", "language"]
    groups = cut(groups.select(
        *[F.coalesce(F.col(k), F.lit("?")).alias(k) for k in key], "component", "n",
        F.sha2(F.concat(F.lit(f"{salt}|"), F.col("component")), 256).alias("h"),
    ))
    totals = groups.groupBy(*key).agg(F.sum("n").alias("total"))
    small = min(ratios["val"], ratios["test"])
    groups = groups.join(totals, key).withColumn("giant", F.col("n") > F.greatest(F.col("total") * small / 2, F.lit(1)))
    groups = groups.withColumn("bucket", F.substring("h", 1, 2))
    buckets = groups.groupBy(*key, "bucket").agg(
        F.sum(F.when(~F.col("giant"), F.col("n")).otherwise(0)).alias("rows"),
        F.sum(F.when(F.col("giant"), F.col("n")).otherwise(0)).alias("giants"),
    )
    # At most 256 rows a stratum, and one row a stratum for the quotas.
    ordered = Window.partitionBy(*key).orderBy("bucket")
    strata = buckets.groupBy(*key).agg(F.sum("rows").alias("plain"), F.sum("giants").alias("giants"))
    wanted = (F.col("plain") + F.col("giants")) * ratios["train"]
    strata = strata.withColumn("quota", F.greatest(wanted - F.col("giants"), F.lit(0.0))).withColumn("excess", F.greatest(F.col("giants") - wanted, F.lit(0.0)))
    # Rows that giants bring to train beyond their own stratum's share are taken off the other strata's shares; one row is broadcast.
    spared = strata.agg(F.least(F.sum("excess") / F.greatest(F.sum("quota"), F.lit(1.0)), F.lit(1.0)).alias("spared"))
    strata = strata.crossJoin(F.broadcast(spared)).select(*key, "plain", (F.col("quota") * (1 - F.col("spared"))).alias("train"))
    buckets = buckets.select(*key, "bucket", (F.sum("rows").over(ordered) - F.col("rows")).alias("before")).join(strata, key)
    inner = Window.partitionBy(*key, "bucket").orderBy("h", "component")
    plain = F.when(~F.col("giant"), F.col("n")).otherwise(0)
    middle = F.col("before") + F.sum(plain).over(inner) - plain / 2.0
    train = F.col("train")
    rest = F.col("plain") - train
    val = train + rest * (ratios["val"] / (ratios["val"] + ratios["test"]))
    split: Column = F.when(F.col("giant") | (middle < train), "train").when(middle < val, "val").otherwise("test")
    chosen = groups.join(buckets, [*key, "bucket"]).select("component", split.alias("split"))
    return _by_component(rows, number, chosen)
