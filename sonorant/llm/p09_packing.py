"""Problem 9: items of varying length into containers of fixed capacity, by a grouping genetic algorithm."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import cut
from .p08_tokenize import TOKENIZERS, VOCABULARY, sizes as token_sizes

CAPACITY = 2048
#: Items of a shard on average. Shards are filled by the hash of unique ids, so no shard is much larger.
SHARD_ITEMS = 1024
ISLANDS, EPOCHS, POPULATION = 3, 2, 6
#: An epoch of an island ends after so many children without a better one, and after so many at most.
STAGNATION, GENERATIONS = 20, 400
#: Share of the best-filled containers a crossover injects, and the fill from which a container counts as well filled.
INJECT, WELL_FILLED = 0.25, 0.98
#: Containers, the emptiest ones, whose items a child exchanges for displaced ones.
EXCHANGED = 24
#: Island states of a task.
STATES = 4

Bin = tuple[int, list[int]]  # load and items
Bins = list[Bin]


def best_fit(items: list[int], size: list[int], capacity: int, bins: Bins) -> Bins:
    """`bins` with `items` added in the given order, each where it leaves least room, else in a new one."""
    room = sorted((capacity - load, k) for k, (load, _) in enumerate(bins))
    for i in items:
        at = bisect_left(room, (size[i], -1))
        if at == len(room):
            bins.append((size[i], [i]))
            insort(room, (capacity - size[i], len(bins) - 1))
        else:
            left, k = room.pop(at)
            load, held = bins[k]
            bins[k] = (load + size[i], [*held, i])
            insort(room, (left - size[i], k))
    return bins


def fitness(bins: Bins, capacity: int) -> float:
    """Fewer containers first; of as many, those with fuller ones: what is unused then lies in few containers."""
    return sum((load / capacity) ** 2 for load, _ in bins) / len(bins) - len(bins) if bins else 0.0


def exchange(child: Bins, displaced: list[int], size: list[int], capacity: int) -> list[int]:
    """What is displaced after the emptiest containers have taken larger items for smaller ones, where that fits.

    A container first gives one item for a larger displaced one, then two for
    one displaced item that fills it better; it never gets emptier.
    """
    if not displaced:
        return displaced
    pool = sorted((size[i], i) for i in displaced)
    order = sorted(range(len(child)), key=lambda k: (child[k][0], k))[:EXCHANGED]
    for k in order:
        load, held = child[k]
        for _ in range(3):
            slack = capacity - load
            if not slack:
                break
            best = (0, None, None)
            for n, i in enumerate(held):
                at = bisect_right(pool, (size[i] + slack, 1 << 60)) - 1
                if at >= 0 and pool[at][0] - size[i] > best[0]:
                    best = (pool[at][0] - size[i], (n,), at)
                if best[0] == slack:
                    break
                for m in range(n):
                    both = size[i] + size[held[m]]
                    at = bisect_right(pool, (both + slack, 1 << 60)) - 1
                    if at >= 0 and pool[at][0] - both > best[0]:
                        best = (pool[at][0] - both, (m, n), at)
            gain, out, at = best
            if not gain:
                break
            new = pool.pop(at)[1]
            for n in out:
                insort(pool, (size[held[n]], held[n]))
            held = [x for n, x in enumerate(held) if n not in out] + [new]
            load += gain
        child[k] = (load, held)
    return [i for _, i in reversed(pool)]


def crossover(a: Bins, b: Bins, size: list[int], capacity: int, rng: random.Random) -> Bins:
    """A child of a with whole well-filled containers of b.

    Containers of a that share an item with an injected one are broken up; their
    other items are exchanged for smaller ones of the emptiest containers, and
    what is then displaced goes, largest first, where it fits best.
    """
    ranked = sorted(range(len(b)), key=lambda k: (-b[k][0], k))
    full = [k for k in ranked if b[k][0] >= WELL_FILLED * capacity] or ranked[: max(1, len(b) // 5)]
    chosen = rng.sample(full, max(1, int(len(full) * INJECT * rng.random())))
    child = [b[k] for k in chosen]
    taken = {i for _, x in child for i in x}
    displaced: list[int] = []
    for load, x in a:
        if taken.isdisjoint(x):
            child.append((load, x))
        else:
            displaced += [i for i in x if i not in taken]
    return best_fit(exchange(child, displaced, size, capacity), size, capacity, child)


def mutate(a: Bins, size: list[int], capacity: int, rng: random.Random) -> Bins:
    """The emptiest containers and a few others broken up, their items exchanged and placed anew."""
    order = sorted(range(len(a)), key=lambda k: (a[k][0], k))
    few = max(1, len(a) // 40)
    broken = set(order[:few]) | set(rng.sample(range(len(a)), min(len(a), few + 1)))
    child = [x for k, x in enumerate(a) if k not in broken]
    items = exchange(child, [i for k in sorted(broken) for i in a[k][1]], size, capacity)
    items.sort(key=lambda i: (-size[i] * rng.uniform(0.9, 1.1), i))
    return best_fit(items, size, capacity, child)


def evolve(size: list[int], capacity: int, population: list[Bins], rng: random.Random, stagnation: int = STAGNATION,
           generations: int = GENERATIONS) -> tuple[list[Bins], int]:
    """The population, best first, and the children born, after STAGNATION children without a better one.

    It starts from best-fit packings in random order, the larger items rather
    first, where it has too few. All full but one container is the best there is.
    """
    n = len(size)
    if not n:
        return [[]], 0
    while len(population) < POPULATION:
        noise = 0.15 * len(population)
        order = sorted(range(n), key=lambda i: (-size[i] * (1 + rng.uniform(-noise, noise)), i))
        population.append(best_fit(order, size, capacity, []))
    total = sum(size)
    rest = total - (max(1, -(-total // capacity)) - 1) * capacity
    most = fitness([(capacity, [])] * (max(1, -(-total // capacity)) - 1) + [(rest, [])], capacity)
    pool = sorted(((-fitness(p, capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])[:POPULATION]
    born, idle, first = len(pool), 0, len(pool)
    while idle < stagnation and born - first < generations and -pool[0][0] < most - 1e-12:
        a, b = (min(rng.sample(range(len(pool)), 2)) for _ in range(2))
        child = crossover(pool[a][2], pool[b][2], size, capacity, rng) if a != b else mutate(pool[a][2], size, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, size, capacity, rng)
        worth = -fitness(child, capacity)
        idle = 0 if worth < pool[0][0] else idle + 1
        born += 1
        if all(worth != x[0] for x in pool):
            pool = sorted([*pool, (worth, born, child)], key=lambda x: x[:2])[:POPULATION]
    return [x[2] for x in pool], born - first


def _coded(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for k, (_, b) in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _decoded(codes: list[int], size: list[int]) -> Bins:
    bins: list[list[int]] = [[] for _ in range(max(codes, default=-1) + 1)]
    for i, k in enumerate(codes):
        bins[k].append(i)
    return [(sum(size[i] for i in b), b) for b in bins if b]


_STATE = "shard bigint, island int, ids array<bigint>, pieces array<int>, sizes array<int>, population array<array<int>>, worth double, born int"
_NAMES = [c.split()[0] for c in _STATE.split(", ")]


def _epoch(state: DataFrame, capacity: int, level: int, epoch: int, tasks: int) -> DataFrame:
    """Each island's state one epoch further; as many tasks as asked for, whatever the bytes of the states."""

    def run(frames):
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                rng = random.Random(f"{level}/{r.shard}/{r.island}/{epoch}")
                size = [int(x) for x in r.sizes]
                start = [_decoded([int(x) for x in p], size) for p in r.population]
                grown, born = evolve(size, capacity, start, rng)
                rows.append((r.shard, r.island, r.ids, r.pieces, r.sizes, [_coded(p, len(size)) for p in grown], fitness(grown[0], capacity), r.born + born))
            yield pd.DataFrame(rows, columns=_NAMES)

    return state.repartition(tasks, "shard", "island").mapInPandas(run, _STATE)


def _level(items: DataFrame, shards: int, capacity: int, level: int) -> DataFrame:
    """(shard, doc_id, piece, tokens, bin, load) of the best packing of every shard."""
    tasks = -(-shards * ISLANDS // STATES)
    placed = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(shards)))
    grouped = placed.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("doc_id", "piece", "tokens"))).alias("x"))
    state = grouped.select(
        "shard", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.col("x.doc_id").alias("ids"), F.col("x.piece").alias("pieces"), F.col("x.tokens").alias("sizes"),
        F.array().cast("array<array<int>>").alias("population"), F.lit(0.0).alias("worth"), F.lit(0).alias("born"),
    )
    state = cut(_epoch(state, capacity, level, 0, tasks))
    for epoch in range(1, EPOCHS):
        elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("population")[0].alias("elite"))
        met = state.join(elite, ["shard", "island"]).withColumn(
            "population", F.concat(F.slice("population", 1, POPULATION - 1), F.array("elite"))).drop("elite")
        state = cut(_epoch(met.select(*_NAMES), capacity, level, epoch, tasks))
    best = state.groupBy("shard").agg(F.max(F.struct("worth", (-F.col("island")).alias("i"), "ids", "pieces", "sizes", F.col("population")[0].alias("bins"))).alias("b"))
    # The load of each container beside its items: a sum over the shard's own arrays.
    loads = F.transform(
        F.sequence(F.lit(0), F.array_max("b.bins")),
        lambda k: F.aggregate(F.zip_with("b.bins", "b.sizes", lambda c, s: F.when(c == k, s).otherwise(0)), F.lit(0), lambda x, y: x + y))
    out = best.select("shard", "b", loads.alias("loads")).select("shard", "loads", F.explode(F.arrays_zip("b.ids", "b.pieces", "b.sizes", "b.bins")).alias("x"))
    return out.select(
        "shard", F.col("x.ids").alias("doc_id"), F.col("x.pieces").alias("piece"), F.col("x.sizes").alias("tokens"),
        F.col("x.bins").alias("bin"), F.get("loads", F.col("x.bins")).alias("load"))


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, tokens, container) for items (doc_id, tokens).

    Every item lies whole in one container, unless it is larger than the
    capacity: then it is cut into full pieces, each its own container, and a
    rest that is packed like other items. Null sizes count as 0; items of size 0
    have a place too, so none is lost. doc_id must be unique. An empty table
    gives no rows.

    Items are hashed into shards of about SHARD_ITEMS. Each shard is evolved on
    several islands, one row of state each, spread over a stated number of
    tasks; between epochs the best packing of every island migrates to the next
    one by a join on (shard, island). The best island's packing is the shard's.
    Containers of it that are not well filled are opened again and their items
    packed once more across shards, level by level, until one shard is left or
    half of a level's items or more would be opened: so what the shards leave
    unused does not add up.
    """
    if capacity <= 0:
        raise ValueError("capacity must be positive")
    tokens = F.coalesce(F.col("tokens"), F.lit(0)).cast("bigint")
    full = F.floor(tokens / capacity).cast("int")
    rest = (tokens - full * capacity).cast("int")
    pieces = F.when(tokens > capacity, F.concat(
        F.transform(F.when(full > 0, F.sequence(F.lit(0), full - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(i.cast("int").alias("piece"), F.lit(capacity).alias("tokens"))),
        F.when(rest > 0, F.array(F.struct(full.alias("piece"), rest.alias("tokens")))).otherwise(F.array().cast("array<struct<piece:int,tokens:int>>")),
    )).otherwise(F.array(F.struct(F.lit(0).alias("piece"), tokens.cast("int").alias("tokens"))))
    cut_items = cut(items.select("doc_id", F.explode(pieces).alias("x")).select("doc_id", "x.piece", "x.tokens"))
    out = cut_items.where(F.col("tokens") >= capacity).select(
        "doc_id", "piece", "tokens", F.concat_ws("-", F.lit("full"), "doc_id", "piece").alias("container"))
    left = cut_items.where(F.col("tokens") < capacity)
    count, level = left.count(), 0
    while count:
        shards = -(-count // SHARD_ITEMS)
        packed = _level(left, shards, capacity, level)
        if shards > 1:
            packed = cut(packed)
        named = packed.withColumn("container", F.concat_ws("-", F.lit(level), "shard", "bin"))
        done = ["doc_id", "piece", "tokens", "container"]
        again = packed.where(F.col("load") < WELL_FILLED * capacity)
        opened = again.count() if shards > 1 else 0
        if not opened or 2 * opened > count:
            return out.unionByName(named.select(*done))
        out = out.unionByName(named.where(F.col("load") >= WELL_FILLED * capacity).select(*done))
        left, count, level = again.select("doc_id", "piece", "tokens"), opened, level + 1
    return out


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Containers of documents sized in tokens of a public tokenizer."""
    return pack(token_sizes(documents, "doc_id", "text", path), capacity)


def check(packing: DataFrame, documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(documents, missing, strange, repeated, split, overfull): documents, and how many break each rule of a packing, all 0.

    missing: without a container; strange: packed but no document; repeated: a
    piece that comes twice; split: in several containers though not larger than
    the capacity; overfull: containers above the capacity.
    """
    parts = packing.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("piece").alias("k"), F.sum("tokens").alias("size"))
    met = documents.select("doc_id", F.lit(True).alias("here")).join(parts, "doc_id", "full")
    rules = met.agg(
        F.count("here").alias("documents"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("here").isNull()).alias("strange"),
        F.count_if(F.col("n") > F.col("k")).alias("repeated"), F.count_if((F.col("n") > 1) & (F.col("size") <= capacity)).alias("split"))
    loads = packing.groupBy("container").agg(F.sum("tokens").alias("load")).agg(F.count_if(F.col("load") > capacity).alias("overfull"))
    return rules.crossJoin(F.broadcast(loads))


def fill(packing: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, least, fill): containers used, the fewest any packing needs, and the mean fill."""
    loads = packing.groupBy("container").agg(F.sum("tokens").alias("load"))
    return loads.agg(
        F.count("*").alias("containers"),
        F.ceil(F.coalesce(F.sum("load"), F.lit(0)) / capacity).alias("least"),
        F.round(F.avg(F.col("load") / capacity), 6).alias("fill"),
    )
