"""Mixing sources to target weights: pivotal dependent rounding.

Every source gets a target number of words; each of its documents should then be
taken ``target / source size`` times. The whole part is taken outright. The
fractional parts are rounded by the pivotal method: two documents are paired,
the words at stake are shifted from one to the other, at random but without bias,
until one of the two probabilities is 0 or 1, and the other document goes on to
the next pair. The shift conserves words (not documents), so a source's taken
words miss the target by at most one document.

The pairing runs as a reduction tree: documents fall into small groups by hash,
each group leaves at most one undecided document, those residuals are grouped
again, and so on until one per source is left, which is drawn. No group is ever
larger than a few hundred rows, whatever the size of the source. All randomness
is a hash of the documents concerned, so reruns agree.

DataFrame and SQL functions only.

Defined cases: a NULL text has size 0; a NULL source is a source (last in
order); a document of size 0 is taken 0 words; a NULL doc_id is a document like
any other; repeated rows are separate documents, rounded on their own; an empty
table gives an empty result; columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, fingerprint, hash_unit, stage, table

CYCLE = (5, 2, 1)
MAX_COPIES = 3.0
GROUP = 128
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def running_sums(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` plus ``place`` (from 0) and, for every new name, the sum of a column over the rows before, in ``order``.

    Sorted by range over all tasks; what is summed up in one place is one row per task.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("__part", F.shiftright("__at", 33)), "mix-sorted")
    placed = placed.withColumn("__one", F.lit(1).cast("long"))
    sums = {"place": "__one", **sums}
    parts = placed.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", *[F.sum(f"__{n}").over(earlier).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return (placed.join(F.broadcast(parts), "__part")
            .withColumns({n: F.coalesce(f"__{n}", zero) + F.coalesce(F.sum(c).over(inside), zero) for n, c in sums.items()})
            .drop("__at", "__part", "__one", *[f"__{n}" for n in sums]))


def source_targets(sized: DataFrame, cycle: tuple[int, ...] = CYCLE, max_copies: float = MAX_COPIES) -> DataFrame:
    """(source, n_docs, source_size, target): shares by weight, capped, the excess reshared by weight.

    ``sized`` has source, size and n (how many rows are alike). Resharing until no
    target is above its cap ends at min(cap, level * weight) for one level, which
    is found by taking the sources in the order in which they reach their cap.
    """
    per = sized.groupBy("source").agg(F.sum("n").alias("n_docs"),
                                      F.sum(F.col("size") * F.col("n")).alias("source_size"))
    per = running_sums(per, [F.asc_nulls_last("source")], {})
    weight = F.get(F.array(*[F.lit(float(w)) for w in cycle]), F.pmod("place", F.lit(len(cycle))))
    per = per.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(max_copies))})
    per = per.drop("place").withColumn("full_at", F.col("cap") / F.col("weight"))
    per = stage(running_sums(per, [F.col("full_at"), F.asc_nulls_last("source")],
                             {"cap_before": "cap", "weight_before": "weight"}), "mix-sources")
    total = per.agg(F.sum("source_size").cast("double")).scalar()
    weights = per.agg(F.sum("weight")).scalar()
    # The level if exactly the sources before this one were at their cap; the first that fits is the one.
    level = (total - F.col("cap_before")) / (weights - F.col("weight_before"))
    fits = per.withColumn("level", level).filter("level <= full_at").agg(F.min(F.struct("place", "level")).alias("first"))
    found = F.coalesce(fits.select("first.level").scalar(), F.lit(float("inf")))
    return per.select("source", "n_docs", "source_size", F.least("cap", found * F.col("weight")).alias("target"))


def _pair(held: Column, x: Column, seed: Column) -> Column:
    """One pivotal step between two undecided documents.

    Returns struct(done: list of decided documents, held: the undecided one or NULL).
    ``held`` gains words with probability lose / (gain + lose); both moves keep
    size * probability summed over the pair.
    """
    room_up_h, room_dn_x = (1 - held.p) * held['size'], x.p * x['size']
    gain = F.least(room_up_h, room_dn_x)                     # words held can gain from x
    lose = F.least(held.p * held['size'], (1 - x.p) * x['size'])   # words held can lose to x
    up = hash_unit(seed, held.id, x.id, held.ord, x.ord) < lose / (gain + lose)
    ph = F.when(up, F.when(room_up_h <= room_dn_x, F.lit(1.0)).otherwise(held.p + gain / held['size'])) \
        .otherwise(F.when(held.p * held['size'] <= (1 - x.p) * x['size'], F.lit(0.0)).otherwise(held.p - lose / held['size']))
    px = F.when(up, F.when(room_dn_x <= room_up_h, F.lit(0.0)).otherwise(x.p - gain / x['size'])) \
        .otherwise(F.when((1 - x.p) * x['size'] <= held.p * held['size'], F.lit(1.0)).otherwise(x.p + lose / x['size']))
    return F.struct(ph.alias("ph"), px.alias("px"))


ITEM = "struct<key:bigint,id:bigint,doc_id:bigint,size:bigint,ord:bigint,base:bigint,p:double>"


def _with_p(item: Column, p: Column) -> Column:
    return F.struct(item.key.alias("key"), item.id.alias("id"), item.doc_id.alias("doc_id"), item["size"].alias("size"),
                    item.ord.alias("ord"), item.base.alias("base"), p.alias("p")).cast(ITEM)


def _fold(items: Column, level: int) -> Column:
    """Pivot a group's documents one after the other, the largest first: struct(done, held).

    A large document is decided by the words of many smaller ones, so what a
    group leaves undecided in the end is one of its smaller documents.
    """
    none = F.lit(None).cast(ITEM)
    start = F.struct(F.array().cast(f"array<{ITEM}>").alias("done"), none.alias("held"))
    open_ = lambda p: (p > 0.0) & (p < 1.0)

    def step(acc: Column, x: Column) -> Column:
        held = acc.held

        def settle(pair: Column) -> Column:
            h, y = _with_p(held, pair.ph), _with_p(x, pair.px)
            done = F.filter(F.array(h, y), lambda i: ~open_(i.p))
            left = F.filter(F.array(h, y), lambda i: open_(i.p))
            return F.struct(F.concat(acc.done, done).alias("done"), F.get(left, F.lit(0)).alias("held"))

        # transform over a one-element array binds the pair once instead of repeating its expression
        moved = F.get(F.transform(F.array(_pair(held, x, F.lit(level))), settle), F.lit(0))
        return F.when(held.isNull(), F.struct(acc.done.alias("done"), x.alias("held"))).otherwise(moved)

    return F.aggregate(items, start, step)


def mix(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, max_copies: float = MAX_COPIES, group: int = GROUP,
        seed: int = 0) -> DataFrame:
    """(doc_id, source, size, ord, source_size, target, copies, taken), one row per row of ``docs``.

    ``ord`` numbers rows that are alike in doc_id, source and size from 1.
    """
    # Equal rows are interchangeable: count them and hand out ordinals, so that the
    # grouping below is by value, stable on recomputation and even for repeated rows.
    sized = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                              n_words(F.col("text")).alias("size"))
                  .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = stage(source_targets(sized, cycle, max_copies), "mix-targets")
    n_sources, most = targets.agg(F.count(F.lit(1)), F.coalesce(F.max("n_docs"), F.lit(0))).first()
    small = F.broadcast(targets) if n_sources <= BROADCAST_SOURCES else targets
    small = small.withColumnRenamed("source", "__source")
    ratio = F.when(F.col("source_size") > 0,
                   F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    n_groups = F.ceil(F.col("n_docs") / F.lit(group)).cast("long")
    rows = (sized.join(small, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("ord", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .withColumn("id", fingerprint(F.col("doc_id"), F.col("source"), F.col("size"), F.col("ord"), seed=seed))
            .withColumns({"base": F.floor(ratio).cast("long"), "p": ratio - F.floor(ratio)})
            .withColumn("grp", F.pmod(F.col("id"), n_groups)))
    item = F.struct((-F.col("size")).alias("key"), "id", "doc_id", "size", "ord", "base", "p").cast(ITEM).alias("item")
    keys = ["source", "source_size", "target"]
    rows = rows.select(*keys, "grp", item)
    at_stake = (F.col("item.p") > 0) & (F.col("item.p") < 1) & (F.col("item.size") > 0)
    parts = [rows.filter(~at_stake).select(*keys, "item")]
    rows, level, groups = rows.filter(at_stake), 0, max(1, math.ceil(most / group))
    while True:
        folded = (rows.groupBy(*keys, "grp")
                  .agg(_fold(F.array_sort(F.collect_list("item")), level).alias("f")))
        folded = stage(folded, f"mix-level{level}")
        parts.append(folded.select(*keys, F.explode("f.done").alias("item")))
        held = folded.filter("f.held IS NOT NULL").select(*keys, "grp", F.col("f.held").alias("item"))
        if groups == 1:
            break
        groups, level = math.ceil(groups / group), level + 1
        rows = held.withColumn("grp", F.floor(F.col("grp") / F.lit(group)).cast("long"))
    last = F.when(hash_unit(F.lit(-1), F.col("item.id")) < F.col("item.p"), 1.0).otherwise(0.0)
    parts.append(held.select(*keys, _with_p(F.col("item"), last).alias("item")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    copies = F.col("item.base") + F.when(F.col("item.p") >= 1.0, 1).otherwise(0)
    return out.select("item.doc_id", "source", "item.size", "item.ord", "source_size", "target",
                      copies.cast("long").alias("copies"),
                      (copies * F.col("item.size")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs`` plus size, source_size, target, copies and taken.

    ``copies`` is how often the mix holds the document, 0 if it does not. Columns of
    these names that are there already are replaced.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    mixed = mix(docs, **options).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                                        F.col("ord").alias("__ord"), *new)
    docs = docs.drop(*new)
    alike = Window.partitionBy(F.col("doc_id").cast("long"), "source", "__size").orderBy("text")
    docs = docs.withColumn("__size", n_words(F.col("text"))).withColumn("__n", F.row_number().over(alike))
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
            & (F.col("__size") == F.col("size")) & (F.col("__n") == F.col("__ord")))
    return docs.join(mixed, same).select(*[c for c in docs.columns if c not in ("__size", "__n")], *new)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")
