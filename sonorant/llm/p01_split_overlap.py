"""Problem 1: evaluation rows that repeat, exactly or almost, a train row."""

from __future__ import annotations

from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import cut
from .ids import clip_key, split_name, tidy
from .plain import comparable_words

#: Words both texts need. Four in five words of the longer one must agree in order: their longest common subsequence counts, so that a
#: word that changed its place is one word that does not agree. The segment arithmetic below is that of this share.
MIN_WORDS = 6


def prepared(manifest: DataFrame) -> DataFrame:
    """(line, part, dataset, clip, words, key): rows of a split with their clip key, comparable words and the words' 128-bit digest.

    words and key are null where a text has too few; part is `train` or the
    evaluation split. Rows without a split or line number take no part.
    """

    def run(batches):
        for batch in batches:
            words, keys = [], []
            for text in batch.column(4).to_pylist():
                found = comparable_words(text) if text else ()
                whole = " ".join(found) if len(found) >= MIN_WORDS else None
                words.append(whole)
                keys.append(None if whole is None else blake2b(whole.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            columns = [*batch.columns[:4], pa.array(words, pa.string()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["line", "part", "dataset", "clip", "words", "key"])

    rows = manifest.select(
        F.col("line_number").cast("bigint").alias("line"), split_name(F.col("split")).alias("part"),
        tidy(F.col("dataset")).alias("dataset"), clip_key(F.col("audio_id")).alias("clip"), F.col("text").cast("string").alias("t"),
    ).where(F.col("part").isNotNull() & F.col("line").isNotNull())
    return rows.mapInArrow(run, "line bigint, part string, dataset string, clip string, words string, key binary")


def most_apart(n: int, m: int) -> int:
    """Words that two texts of n and m words may have unmatched together if four in five of the longer one agree in order; negative if never."""
    return n + m - 2 * (-(-4 * max(n, m) // 5))


def within(a: list[str], b: list[str], apart: int) -> bool:
    """Whether at most `apart` words must be left out of two word lists together to make them equal.

    Equal ends are cut off; then dynamic programming in a band, first a narrow
    one that doubles, so near texts cost little however long they are.
    """
    if abs(len(a) - len(b)) > apart:
        return False
    start, stop = 0, min(len(a), len(b))
    while start < stop and a[start] == b[start]:
        start += 1
    end = 0
    while end < stop - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    band = max(1, abs(len(a) - len(b)))
    while band < apart:
        if _banded(a, b, band):
            return True
        band *= 2
    return _banded(a, b, apart)


def _banded(a: list[str], b: list[str], apart: int) -> bool:
    n, m = len(a), len(b)
    if abs(n - m) > apart:
        return False
    far = apart + 1
    row = [j if j <= apart else far for j in range(m + 1)]
    for i in range(1, n + 1):
        low, high = max(1, i - apart), min(m, i + apart)
        last = row[low - 1]
        row[low - 1] = i if low == 1 and i <= apart else far
        word, least = a[i - 1], row[low - 1]
        for j in range(low, high + 1):
            up = row[j] if j < i + apart else far
            best = last if word == b[j - 1] else 1 + min(up, row[j - 1])
            last = row[j]
            row[j] = best if best < far else far
            least = min(least, row[j])
        if least > apart:
            return False
    return row[m] <= apart


#: Runs of words that segments stand for: of two words, or of one.
WIDTHS = (2, 1)
#: Runs of words that the sketch of frequent ones tracks, and from which count and share of all runs one is hot.
#: No more than HOT_PARTS runs can reach that share, which bounds what is broadcast.
TRACKED, HOT_LEAST, HOT_PARTS = 20_000, 1_000, 5_000
#: Texts of up to so many words are compared by place and length word by word where a hot run must be used; longer ones in coarser steps.
STEP_WORDS = 16


def _grams(width: int) -> Column:
    """Hashes of all runs of `width` words of the array w, in order."""
    words, n = F.col("w"), F.size("w")
    gram = lambda j: F.xxhash64(F.lit(width), *[F.get(words, j + i) for i in range(width)])
    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), gram)).otherwise(F.array().cast("array<bigint>"))


def _bits() -> list[Column]:
    """128 bits in two columns, one of them set for each different word of the array w."""
    places = F.transform(F.array_distinct("w"), lambda x: F.pmod(F.xxhash64(F.lit("bit"), x), F.lit(128)).cast("int"))
    half = lambda low: F.aggregate(
        F.filter(places, lambda x: (x >= low) & (x < low + 64)), F.lit(0).cast("bigint"),
        lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x - low)))
    return [half(0), half(64)]


def hot_grams(train: DataFrame) -> list[int]:
    """Runs of words that very many texts (w) share, from a mergeable sketch over all of them; at most HOT_PARTS."""
    each = train.select(F.explode(F.concat(*[_grams(w) for w in WIDTHS])).alias("g"))
    found = each.agg(F.expr(f"approx_top_k(g, {HOT_PARTS}, {TRACKED})").alias("top"), F.count("*").alias("n")).first()
    least = max(HOT_LEAST, found.n // HOT_PARTS)
    return sorted(x.item for x in found.top or () if x["count"] >= least)


def segments(n: int, grams: dict[int, list[int]], hot: frozenset[int]) -> list[tuple[int, int, bool]]:
    """Width, start and whether it is hot of 2 (n // 5) + 1 disjoint runs of words of a text, as few of them hot as can be.

    The text is cut evenly and each segment stands for its first two words that
    are not hot. Where hot runs get in the way, others are sought between them,
    of two words and then of one. What is missing then is filled up with hot
    runs of two words between those.
    """
    need = 2 * (n // 5) + 1
    two, one = grams[2], grams[1]
    cuts = [i * n // need for i in range(need + 1)]
    even = []
    for low, high in zip(cuts, cuts[1:]):
        start = next((j for j in range(low, high - 1) if two[j] not in hot), None)
        if start is None:
            break
        even.append((2, start, False))
    if len(even) == need:
        return even
    pairs, j = [], 0
    while j < len(two):
        if two[j] in hot:
            j += 1
        else:
            pairs.append((2, j, False))
            j += 2
    if len(pairs) >= need:
        return [pairs[i * len(pairs) // need] for i in range(need)]
    words = [(1, j, False) for j in range(n) if one[j] not in hot]
    if len(words) >= need:
        return [words[i * len(words) // need] for i in range(need)]
    chosen = max(pairs, words, key=len)
    used = {j + i for width, j, _ in chosen for i in range(width)}
    j = 0
    while len(chosen) < need and j < n:
        width = 2 if j + 1 < n and not {j, j + 1} & used else 1
        if j not in used:
            chosen.append((width, j, True))
            used |= set(range(j, j + width))
        j += width
    return chosen


def step(n: int) -> int:
    """Words that a place or a length is rounded to for a hot run of a text of n words."""
    return 1 << max(0, n.bit_length() - STEP_WORDS.bit_length())


def _places(n: int, p: int) -> set[tuple[int, int]]:
    """Rounded places and lengths at which a run at p of a text of n words may stand in a partner."""
    by, out = step(n), set()
    for m in range(-(-4 * n // 5), 5 * n // 4 + 1):
        apart = most_apart(n, m)
        for j in range(max(0, p - apart), min(m - 1, p + apart) + 1):
            if abs(j - p) + abs(m - n - j + p) <= apart:
                out.add((j // by, m // by))
    return out


def candidate_pairs(evaluation: DataFrame, train: DataFrame) -> DataFrame:
    """(e, t): distinct texts of (id, words) that may be near, by the segment filter.

    Let four in five words of the longer of two texts of n and m words agree in
    order. Then at most d(n, m) = n + m - 2 ceil(4/5 max(n, m)) words of both are
    not matched, and d is largest, 2 floor(n / 5), at m = n. A word left out of
    either text spoils one of the evaluation text's disjoint segments at most,
    so of its 2 floor(n / 5) + 1 segments all but d appear unchanged in the
    partner; and where one starts is bounded: the shift before it and the
    difference of lengths left after it are words left out. Segments are hashed
    and joined with the train texts' runs of as many words.

    A word of one text that the other lacks is not matched either: a bit for
    each word's hash, carried with the keys, tells most strangers apart inside
    the join. Runs that very many texts share are avoided, for any disjoint
    segments find every pair; where a text has too few others, such a run is
    joined together with its rounded place and the text's rounded length, which
    parts its rows into many keys. Nothing is capped.
    """
    train = train.select(F.col("id").alias("t"), F.split("words", " ").alias("w")).withColumn("m", F.size("w"))
    hot = evaluation.sparkSession.sparkContext.broadcast(frozenset(hot_grams(train)))

    def pick(batches):
        known = hot.value
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(10))
            for e, n, low, high, two, one in zip(*[c.to_pylist() for c in batch.columns]):
                grams = {2: two, 1: one}
                for i, (width, p, is_hot) in enumerate(segments(n, grams, known)):
                    places = sorted(_places(n, p)) if is_hot else [(None, None)]
                    for j, m in places:
                        for column, value in zip(out, (grams[width][p], e, n, i, p, low, high, j, m, width)):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["gram", "e", "n", "i", "p", "e0", "e1", "at", "long", "width"])

    e = evaluation.select("id", F.split("words", " ").alias("w")).select("id", F.size("w").alias("n"), *_bits(), *[_grams(w) for w in WIDTHS])
    e = cut(e.mapInArrow(pick, "gram bigint, e bigint, n int, i int, p int, e0 bigint, e1 bigint, at int, long int, width int"))
    # The widths in use, and the hot runs that had to be used: no more than there are hot ones.
    used = e.agg(F.collect_set("width").alias("widths"), F.collect_set(F.when(F.col("at").isNotNull(), F.col("gram"))).alias("hot")).first()
    key = lambda gram, by, j, m: F.xxhash64(gram, by, j, m)
    by_length = lambda n: F.call_function(
        "shiftleft", F.lit(1), F.greatest(F.floor(F.log2(n.cast("double") + 0.5)).cast("int") + 1 - STEP_WORDS.bit_length(), F.lit(0)))
    e = e.withColumn("gram", F.when(F.col("at").isNotNull(), key(F.col("gram"), by_length(F.col("n")), F.col("at"), F.col("long"))).otherwise(F.col("gram"))).drop("at", "long", "width")
    # One row a run. The bits are made before, or they would be made for every run.
    low, high = _bits()
    t = train.select("t", "m", "w", low.alias("t0"), high.alias("t1"))
    if 1 in used.widths:
        runs = F.concat(*[F.transform(_grams(width), lambda g, j: F.struct(g.alias("gram"), j.alias("j"))) for width in WIDTHS])
        t = t.select("t", "m", "t0", "t1", F.explode(runs).alias("x")).select("t", "m", "t0", "t1", "x.gram", "x.j")
    else:
        t = t.select("t", "m", "t0", "t1", F.posexplode(_grams(2)).alias("j", "gram"))
    if used.hot:
        hot_rows = evaluation.sparkSession.createDataFrame([(g,) for g in sorted(used.hot)], "gram bigint")
        told = t.join(F.broadcast(hot_rows.withColumn("hot", F.lit(True))), "gram", "left")
        # The rounding is that of the evaluation text, which is at most a quarter longer or a fifth shorter.
        steps = F.array_distinct(F.array(by_length(F.ceil(F.col("m") * 4 / 5)), by_length(F.col("m")), by_length(F.floor(F.col("m") * 5 / 4))))
        parted = F.transform(steps, lambda by: key(F.col("gram"), by, F.floor(F.col("j") / by).cast("int"), F.floor(F.col("m") / by).cast("int")))
        keys = F.when(F.col("hot"), F.concat(F.array("gram"), parted)).otherwise(F.array("gram"))
        t = told.withColumn("gram", F.explode(keys)).drop("hot")
    longer = F.greatest("n", "m")
    least = F.ceil(F.col("longer") * 4 / 5).cast("int")
    shift, delta = F.col("j") - F.col("p"), F.col("m") - F.col("n")
    lacks = lambda x, y: sum(F.bit_count(F.col(f"{x}{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}{k}")))) for k in (0, 1))
    met = e.join(t, "gram").where(F.col("e") != F.col("t")).withColumn("longer", longer).withColumn("least", least).where(
        (F.col("n") >= F.col("least")) & (F.col("m") >= F.col("least"))
        & (F.abs(shift) + F.abs(delta - shift) <= F.col("n") + F.col("m") - 2 * F.col("least"))
        & (lacks("e", "t") <= F.col("n") - F.col("least")) & (lacks("t", "e") <= F.col("m") - F.col("least")))
    # Which segments were met, in four times 62 bits; those beyond share the last one, which only weakens the count.
    words = F.least(F.floor(F.col("i") / 62), F.lit(3))
    bits = [F.bit_or(F.when(words == k, F.expr("shiftleft(1L, least(i, 247) % 62)")).otherwise(F.lit(0).cast("bigint"))).alias(f"b{k}") for k in range(4)]
    count = sum(F.bit_count(f"b{k}") for k in range(4))
    segs = 2 * F.floor(F.col("n") / 5) + 1
    wanted = segs - (F.col("n") + F.col("m") - 2 * F.col("least"))
    return (
        met.groupBy("e", "t").agg(*bits, F.first("n").alias("n"), F.first("m").alias("m"), F.first("least").alias("least"))
        .where(count >= F.when(segs <= 248, wanted).otherwise(1))
        .select("e", "t")
    )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (e, t) of which at least four in five words of the longer text agree in order."""
    whole = (
        pairs.join(texts.select(F.col("id").alias("e"), F.col("words").alias("we")), "e")
        .join(texts.select(F.col("id").alias("t"), F.col("words").alias("wt")), "t")
        .select("e", "t", "we", "wt")
    )

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = a.split(" "), b.split(" ")
                keep.append(within(a, b, most_apart(len(a), len(b))))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return whole.mapInArrow(run, "e bigint, t bigint")


def overlaps(manifest: DataFrame) -> DataFrame:
    """(line_lo, line_hi) of every train row and evaluation row that share their clip or nearly their text.

    Texts agree when both have six words and at least four in five words of the
    longer one agree in order (edit distance of words without substitutions). Equal texts form one
    class, so copies, however many, are compared once and meet only in the
    result, where every pair of rows is wanted. Null texts and ids match
    nothing; an empty table gives no rows.
    """
    rows = cut(prepared(manifest))
    train = F.col("part") == "train"
    classes = cut(
        rows.where(F.col("words").isNotNull()).groupBy("key", "words")
        .agg(F.min("line").alias("id"), F.max(train).alias("t"), F.max(~train).alias("e"))
    )
    near = verified(candidate_pairs(classes.where("e"), classes.where("t")), classes)
    same = classes.where(F.col("e") & F.col("t")).select(F.col("id").alias("e"), F.col("id").alias("t"))
    met = cut(near.unionByName(same))
    # Only the rows of classes that met anything are joined back.
    members = rows.where(F.col("key").isNotNull()).select("key", "line", "part").join(classes.select("key", "id"), "key").select("line", "id", train.alias("train"))
    by_text = (
        met.join(members.where(~F.col("train")).select(F.col("id").alias("e"), F.col("line").alias("x")), "e")
        .join(members.where(F.col("train")).select(F.col("id").alias("t"), F.col("line").alias("y")), "t")
        .select("x", "y")
    )
    clips = rows.where(F.col("clip").isNotNull())
    by_clip = (
        clips.where(~train).select("clip", F.col("line").alias("x"))
        .join(clips.where(train).select("clip", F.col("line").alias("y")), "clip").select("x", "y")
    )
    both = by_text.unionByName(by_clip)
    return both.select(F.least("x", "y").alias("line_lo"), F.greatest("x", "y").alias("line_hi")).distinct()


def report(manifest: DataFrame) -> DataFrame:
    """(split, dataset, rows, overlapping, pairs) of the evaluation rows, zeros included; dataset null where unknown."""
    rows = manifest.select(
        F.col("line_number").cast("bigint").alias("line"), split_name(F.col("split")).alias("split"), tidy(F.col("dataset")).alias("dataset")
    ).where(F.col("split").isin("val", "test"))
    found = overlaps(manifest).select(F.explode(F.array("line_lo", "line_hi")).alias("line"))
    hits = found.groupBy("line").agg(F.count("*").alias("met"))
    return rows.join(hits, "line", "left").groupBy("split", "dataset").agg(
        F.count("*").alias("rows"), F.count("met").alias("overlapping"), F.coalesce(F.sum("met"), F.lit(0)).alias("pairs")
    )
