"""Takers served one after another: each takes its first targets that no earlier taker has.

Serving is ordered, but its result is also that of targets who ask their earliest taker and move on when they are turned
away (deferred acceptance), which goes in parallel rounds. A rest that is small enough is served in order by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse.session import stage, stage_buckets, unstage

#: Wishes that one task serves in order; more are shared out in rounds until no more are left open.
SERVED_AT_ONCE = 1_000_000
#: Wishes for one target in one piece: a target that very many takers name is split by its measured number.
PIECE = 4096
#: Rounds whose results are kept apart before they are written as one.
APART = 8


def _serve(wishes: DataFrame, budget: int) -> DataFrame:
    """The wishes that are granted, in order; one task, which holds the targets taken."""

    def grant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, own, at, left = set(), set(), None, 0
        for batch in batches:
            out = []
            for taker, target in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if taker != at:
                    taken |= own
                    own, at, left = set(), taker, budget
                granted = left > 0 and target not in taken
                if granted:
                    own.add(target)
                    left -= 1
                out.append(granted)
            yield batch.filter(pa.array(out, pa.bool_()))

    in_order = wishes.select("taker", "pos", "target").coalesce(1).sortWithinPartitions("taker", "pos")
    return in_order.mapInArrow(grant, in_order.schema)


def serve_in_order(wishes: DataFrame, budget: int) -> DataFrame:
    """The granted rows of ``wishes`` (staged: taker, pos, target), staged.

    Takers come in order, each goes through its wishes by ``pos``, skips targets of earlier takers, and stops at
    ``budget`` grants. A target that it names twice is granted twice. ``taker`` may be of any type that orders.
    """
    if wishes.count() <= SERVED_AT_ONCE:
        return stage(_serve(wishes, budget), "granted")
    n = int(wishes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = wishes.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PIECE)
    hot = stage(hot.select("target", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")), "hot-targets")
    sized = wishes.join(hot, "target", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    sized = sized.withColumn("piece", F.pmod(F.xxhash64("taker"), F.col("pieces")).cast("int"))
    # written once by target: each round's few askers meet their wishes in place
    named = stage_buckets(sized.repartition(n, "target", "piece"), "wishes", "target", "piece")

    def earliest(rows: DataFrame) -> DataFrame:
        per_piece = rows.groupBy("target", "piece").agg(F.min("taker").alias("taker"), F.max("pieces").alias("pieces"))
        return per_piece.groupBy("target").agg(F.min("taker").alias("taker"), F.max("pieces").alias("pieces"))

    order = W.partitionBy("taker").orderBy("pos")
    asking, rounds = stage(earliest(named), "asking"), []
    while True:
        # only takers that are asked in this round, and their wishes for those who ask and those they hold
        piece = F.pmod(F.xxhash64("taker"), F.col("pieces")).cast("int").alias("piece")
        asked = asking.select("target", piece, F.col("taker").alias("asked"))
        # equal takers as two bounds, so that the join keys stay those of the buckets
        own = (F.col("taker") <= F.col("asked")) & (F.col("taker") >= F.col("asked"))
        contest = named.join(asked, ["target", "piece"]).where(own).select("taker", "pos", "target", "pieces")
        if rounds:
            held = _held(rows for rows, _ in rounds)
            contest = contest.unionByName(held.join(asking.select("taker").distinct(), "taker", "left_semi").drop("round"))
        contest = stage(contest.withColumn("rank", F.row_number().over(order)).withColumn("round", F.lit(len(rounds))), "contest")
        kept = contest.where(F.col("rank") <= budget).select("taker", "pos", "target", "pieces", "round")
        # a taker without a kept wish still has had its say
        rounds.append((kept, contest))
        turned = contest.groupBy("target", "taker", "pieces").agg(F.min("rank").alias("rank")).where(F.col("rank") > budget)
        turned = stage(turned.drop("rank"), "turned")
        pieces = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
        moved = turned.select("target", F.col("taker").alias("last"), pieces)
        following = stage(earliest(named.join(moved, ["target", "piece"]).where(F.col("taker") > F.col("last"))), "asking")
        unstage(asking, turned)
        asking = following
        if asking.isEmpty():
            break
        if len(rounds) % 4 == 0 and (rest := _open(named, rounds, asking)) is not None:
            done, left = rest
            granted = stage(done.unionByName(_serve(left, budget)), "granted")
            unstage(asking, *(c for _, c in rounds))
            return granted
        if len(rounds) >= APART:
            whole = stage(_held(rows for rows, _ in rounds).withColumn("round", F.lit(0)), "contest")
            unstage(*(c for _, c in rounds))
            rounds = [(whole, whole)]
    granted = stage(_held(rows for rows, _ in rounds).select("taker", "pos", "target"), "granted")
    unstage(asking, *(c for _, c in rounds))
    return granted


def _held(kept) -> DataFrame:
    """What each taker holds: its wishes of the last round in which it was asked."""
    rows = reduce(DataFrame.unionByName, kept)
    last = rows.groupBy("taker").agg(F.max("round").alias("round"))
    return rows.join(last, ["taker", "round"])


def _open(named: DataFrame, rounds: list, asking: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(grants that are final, wishes that are still open), or None if the open ones are too many for one task.

    Nobody asks a taker before the earliest that is asked now, so all takers before it are done.
    """
    first = F.broadcast(asking.agg(F.min("taker").alias("first")))
    held = _held(rows for rows, _ in rounds).select("taker", "pos", "target")
    done = stage(held.join(first, F.col("taker") < F.col("first")).drop("first"), "done")
    left = named.join(first, F.col("taker") >= F.col("first")).select("taker", "pos", "target")
    left = stage(left.join(done.select("target").distinct(), "target", "left_anti"), "open-wishes")
    if left.count() <= SERVED_AT_ONCE:
        return done, left
    unstage(done, left)
    return None
