"""Mixing sources to target weights with DataFrame operations only.

Each source gets a target number of words by weight, at most ``CEILING`` times its own size, what is cut off being shared again by weight.
Its documents, permuted by a keyed hash and laid end to end, are a tape; the source contributes the first ``target`` words of the tape,
read again from the start when it ends, in blocks of ``BLOCK_WORDS``.  The exact block quotas of all sources are split over the output
shards by a binary tree of multivariate hypergeometric draws: a node gives half of its blocks to its left child, as if drawn without
replacement.  Each shard then owns a stretch of every source's permuted blocks that no other shard has, and orders its draws by a hash.

Positions on a tape are sums over hash ranges plus a sum inside one range, so a source with a third of all rows is spread over as many
groups as its rows need.  The tree holds one row a shard.  Draws depend on keys and the seed alone; reruns agree.

Null and empty texts have no words and are never drawn, a null source is a source of its own (the last), null keys and repeated rows are
documents like others.  An empty table gives an empty result.  Only key, text and source are read; other columns may have any name.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import running_total
from .common import free_name, prepare, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CEILING = 3
BLOCK_WORDS = 1024
SHARD_BLOCKS = 4096
STRETCH = 1024  # draws of a shard that are written together
RANGE_ROWS = 1000
DEAL_LEVELS = 8  # levels of the tree between which its nodes are dealt out again
SEED = 17


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """key, source, seal (hash of the text), size: words of the whole text."""
    return docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.xxhash64(text).alias("seal"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """sid, source, rows, source_size, target for every source; one row a source meets in the windows, never a document."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy(F.lit(0))
    named = totals.withColumn("sid", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = named.withColumn("weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
    # the level at which the targets sum to the whole: sources below it in cap / weight are full
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), "sid")
    full = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - full) / open_weight
    tried = named.withColumn("level", level).withColumn("spot", F.row_number().over(by_level))
    holds = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("spot", "level"))
    chosen = F.min(holds).over(everything)["level"]
    return tried.withColumn("target", F.least("cap", F.coalesce(F.col("weight") * chosen, "cap"))).select("sid", "source", "rows", "source_size", "target")


def on_tape(sizes: DataFrame, sources: DataFrame, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document's words before it on its source's tape (``before``), with the source's columns.

    ``row`` numbers the documents of one source and hash range; it tells apart equal keys without words, which share their ``before``. ``copy`` numbers
    the rows that agree in key, text and source.
    """
    known = sources.withColumnRenamed("source", "_source")
    placed = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    spot = F.xxhash64(F.lit(seed), F.col("key"), F.col("seal"))
    unit = (F.shiftrightunsigned(spot, 11).cast("double")) / float(1 << 53)
    ranges = F.greatest(F.lit(1), F.ceil(F.col("rows") / range_rows))
    placed = placed.withColumn("spot", F.shiftrightunsigned(spot, 11)).withColumn("range", F.floor(unit * ranges))
    by_spot = Window.partitionBy("sid", "range").orderBy("spot", "key", "seal", "size")
    inside = by_spot.rowsBetween(Window.unboundedPreceding, -1)
    # one row a range in this window
    earlier = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("sid", "range").agg(F.sum("size").alias("n")).select("sid", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn("row", F.row_number().over(by_spot))
    summed = summed.withColumn("copy", F.row_number().over(Window.partitionBy("sid", "range", "spot", "key", "seal").orderBy("size")))
    return summed.join(offsets, ["sid", "range"]).withColumn("before", F.col("before") + F.col("offset")).drop("range", "offset", "spot")


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among ``draws`` without replacement, from one uniform number.

    The probabilities are summed from the mode outwards, as ratios to the mode's, over eight standard deviations to either side.
    """
    def limits(a: Column) -> Column:
        whole = a["good"] + a["bad"]
        low, high = F.greatest(F.lit(0.0), a["draws"] - a["bad"]), F.least(a["draws"], a["good"])
        mode = F.least(high, F.greatest(low, F.floor((a["draws"] + 1) * (a["good"] + 1) / (whole + 2)).cast("double")))
        spread = F.ceil(8 * F.sqrt(a["draws"] * a["good"] * a["bad"] * (whole - a["draws"]) / F.greatest(F.lit(1.0), whole * whole * (whole - 1)))).cast("double") + 8
        return F.struct(a["good"].alias("good"), a["draws"].alias("draws"), (a["bad"] - a["draws"]).alias("slack"), a["u"].alias("u"), mode.alias("mode"),
                        F.least(high - mode, spread).cast("int").alias("up"), F.least(mode - low, spread).cast("int").alias("down"))

    def ratio(p: Column, sign: int, i: Column) -> Column:
        """Probability of the value i + 1 steps from the mode over that of the value i steps from it; no longer needed at the last step."""
        k = p["mode"] + sign * i
        if sign > 0:
            return F.coalesce(F.try_divide((p["good"] - k) * (p["draws"] - k), (k + 1) * (p["slack"] + k + 1)), F.lit(0.0))
        return F.coalesce(F.try_divide(k * (p["slack"] + k), (p["good"] - k + 1) * (p["draws"] - k + 1)), F.lit(0.0))

    def mass(p: Column, sign: int, steps: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"))
        return F.aggregate(F.sequence(F.lit(0), steps), start, lambda s, i: F.struct((s["p"] * ratio(p, sign, i)).alias("p"), (s["sum"] + s["p"]).alias("sum")))["sum"]

    def search(p: Column, sign: int, steps: Column, goal: Column) -> Column:
        """Steps from the mode at which the sum reaches the goal."""
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), F.lit(0).alias("short"))
        done = F.aggregate(F.sequence(F.lit(0), steps), start, lambda s, i: F.struct(
            (s["p"] * ratio(p, sign, i)).alias("p"), (s["sum"] + s["p"]).alias("sum"), (s["short"] + F.when(s["sum"] + s["p"] < goal, 1).otherwise(0)).alias("short")))
        return p["mode"] + sign * F.least(done["short"], steps)

    def pick(p: Column) -> Column:
        def with_masses(m: Column) -> Column:
            goal = p["u"] * (m["up"] + m["down"] - 1)          # the mode stands in both sums
            return F.when(goal <= m["up"], search(p, 1, p["up"], goal)).otherwise(search(p, -1, p["down"], goal - m["up"] + 1))

        return _let(F.struct(mass(p, 1, p["up"]).alias("up"), mass(p, -1, p["down"]).alias("down")), with_masses)

    given = F.struct(good.cast("double").alias("good"), bad.cast("double").alias("bad"), draws.cast("double").alias("draws"), u.alias("u"))
    return _let(given, lambda a: _let(limits(a), pick)).cast("long")


def _tasks(df: DataFrame, depth: int) -> int:
    """Tasks for the nodes of a level of the tree: no more than there are nodes, or than an exchange has."""
    return max(1, min(1 << depth, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def split_quotas(sources: DataFrame, depth: int, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """sid, shard, first, blocks: the stretch of each source's blocks that a shard owns."""
    quota = F.ceil(F.round("target") / block_words).cast("long")
    root = sources.agg(F.array_sort(F.collect_list(F.struct("sid", quota.alias("n")))).alias("quotas"))
    nodes = root.select(F.lit(0).cast("long").alias("node"), "quotas")
    for level in range(depth):
        if level and level % DEAL_LEVELS == 0:
            nodes = nodes.repartition(_tasks(sources, level), "node")
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda s, q: s + q["n"])
        start = F.struct(((total + 1) / 2).cast("long").alias("left"), total.alias("rest"), F.array().cast("array<bigint>").alias("out"))

        def draw(s: Column, q: Column) -> Column:  # built at once, so the level is this one
            k = hypergeometric(q["n"], s["rest"] - q["n"], s["left"], _uniform(F.lit(seed), F.lit(level), F.col("node"), q["sid"]))
            return _let(k, lambda x: F.struct((s["left"] - x).alias("left"), (s["rest"] - q["n"]).alias("rest"), F.concat(s["out"], F.array(x)).alias("out")))

        drawn = nodes.select("node", "quotas", F.aggregate("quotas", start, draw)["out"].alias("left"))
        left = F.zip_with("quotas", "left", lambda q, x: F.struct(q["sid"].alias("sid"), x.alias("n")))
        right = F.zip_with("quotas", "left", lambda q, x: F.struct(q["sid"].alias("sid"), (q["n"] - x).alias("n")))
        both = F.array(F.struct((F.col("node") * 2).alias("node"), left.alias("quotas")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")))
        nodes = drawn.select(F.inline(both))
    owned = nodes.select(F.col("node").alias("shard"), F.inline("quotas")).withColumnRenamed("n", "blocks")
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return owned.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """One row for every draw, and one with ``words`` 0 for a document that is not drawn.

    Columns: key, source, seal, copy, size, source_size, target, before, row (tells apart documents without words of one key), epoch (which reading of
    the tape), words (taken by this draw; fewer than ``size`` only where the quota ends inside the document), shard and position (in the shard, from 0).
    """
    prepare(docs.sparkSession)
    sizes = stored(sized(docs, key, text, source))
    sources = stored(source_targets(sizes, weights, ceiling))
    total = sources.agg(F.sum(F.ceil(F.round("target") / block_words))).first()[0] or 0
    depth = max(0, (-(-int(total) // shard_blocks) - 1).bit_length())
    tape = on_tape(sizes, sources, seed)
    quota, whole = F.round("target").cast("long"), F.col("source_size")

    def reading(e: int) -> Column:
        at = whole * e + F.col("before")
        words = F.greatest(F.lit(0), F.least(F.col("size"), quota - at))
        return F.struct(F.lit(e).alias("epoch"), words.alias("words"), F.floor(at / block_words).alias("block"))

    readings = F.filter(F.array(*[reading(e) for e in range(ceiling)]), lambda r: (r["words"] > 0))
    drawn = tape.select("*", F.inline_outer(readings))
    # dealt out before the blocks are made: a shard's blocks are made where the shard is
    owned = split_quotas(sources, depth, block_words, seed).repartition(_tasks(docs, depth), "shard")
    blocks = owned.where("blocks > 0").select(F.col("sid").alias("_sid"), "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("_block"))
    # the blocks grow with the corpus and Spark cannot foresee how many an explode makes, so a broadcast is ruled out
    dealt = drawn.join(blocks.hint("merge"), (F.col("sid") == F.col("_sid")) & (F.col("block") == F.col("_block")), "left")
    spot = F.xxhash64(F.lit(seed), F.lit("spot"), "key", "seal", "copy", "epoch")
    names = ["key", "source", "seal", "copy", "size", "source_size", "target", "before", "row", "epoch", "words", "shard", "position"]
    dealt = stored(dealt.withColumn("spot", spot).withColumn("words", F.coalesce("words", F.lit(0))))
    # places in a shard are ranks over sorted ranges, so a shard of very many short documents is no task of its own
    placed = running_total(dealt.where("shard IS NOT NULL"), ["shard"], "spot", ties=["key", "seal", "copy", "epoch"], name="position")
    return placed.select(*names).unionByName(dealt.where("shard IS NULL").withColumn("position", F.lit(None).cast("long")).select(*names))


def taken(draws: DataFrame) -> DataFrame:
    """One row a document: how many words of it the mix takes, in how many draws, and where these stand (shard, position; at most one for each epoch)."""
    place = F.when(F.col("shard").isNotNull(), F.struct("shard", "position"))
    return draws.groupBy("key", "source", "size", "source_size", "target", "before", "row").agg(
        F.sum("words").alias("taken"), F.count("shard").alias("draws"), F.array_sort(F.collect_list(place)).alias("places"))


def drawn_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", length: str | None = "n_chars", **options) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, shard by shard in the order of the mix; a text on which the quota ends is cut behind its last word taken."""
    mark = free_name(docs.columns, "_mix")
    draws = mix(docs, key, text, source, **options).where("words > 0")
    draws = draws.select(*[F.col(c).alias(f"{mark}_{c}") for c in ("key", "source", "seal", "copy", "size", "words", "shard", "position")])
    # rows that agree in key, text and source are numbered on both sides, so each meets its own draws
    same = Window.partitionBy(key, f"{mark}_own", source).orderBy(F.xxhash64(*docs.columns))
    numbered = docs.withColumn(f"{mark}_own", F.xxhash64(text)).withColumn(f"{mark}_nth", F.row_number().over(same))
    pairs = [(key, "key"), (source, "source"), (f"{mark}_own", "seal"), (f"{mark}_nth", "copy")]
    found = numbered.join(draws, functools.reduce(operator.and_, [F.col(a).eqNullSafe(F.col(f"{mark}_{b}")) for a, b in pairs]))
    words, shard, position = (F.col(f"{mark}_{c}") for c in ("words", "shard", "position"))
    head = F.rtrim(F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1)), F.lit(1), words.cast("int")), ""))
    new = F.when(words < F.col(f"{mark}_size"), head).otherwise(F.col(text))
    columns = [new.alias(c) if c == text else F.length(new).cast(docs.schema[c].dataType).alias(c) if c == length else F.col(c) for c in docs.columns]
    # a task writes stretches of shards in their order
    return found.repartition(shard, F.floor(position / STRETCH)).sortWithinPartitions(shard, position).select(*columns)
