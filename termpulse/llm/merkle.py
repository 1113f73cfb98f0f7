"""Merkle manifest of a dataset: a tree over the rows of every group, a tree over the groups, and proofs for single rows.

Each group's log is an append log in postorder: a node is written as soon as its last leaf is. The place of a node in it
follows from the sizes of full subtrees alone (``position``), for incomplete last runs as well, so that siblings are
addressed and not searched. Aligned builders make the log: builder b takes the leaves b * 16 ** 3 up to the next
multiple, appends them in order, closes every run of 16 as it fills, and writes its nodes in completion order
as one segment of at most 4369. The roots of the builders are the leaves of the next tier of builders, until a group has
one node; the subroots of all groups are the leaves of a last tree of the same kind.

A leaf's place is found without sorting a group in one task (``placed``), so a group that holds a third of all rows is
spread over as many builders as any other rows. A proof is read from the segments of a leaf's builders, one for each tier.

Null group: a group of its own, before all others. Leaves with equal order keys: by their digests, so that repeated rows
(equal digests) change nothing. A lone leaf is its group's root. Empty table: no rows, no root. Carried columns are held
in the struct ``row``, so their names cannot clash with the operator's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termpulse.llm import common
from termpulse.operators.places import placed

#: Children of a node, and levels that one builder closes.
ARITY, HEIGHT = 16, 3
BLOCK = ARITY**HEIGHT
DIGEST = 32


# ---- closed forms


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def written(x: np.ndarray | int) -> np.ndarray | int:
    """Nodes that are in the log before leaf ``x``: the digits of x times the sizes of full subtrees."""
    total, size = x * 0, 1
    while np.any(x):
        total = total + x % ARITY * size
        x, size = x // ARITY, size * ARITY + 1
    return total


def position(level: int, index: np.ndarray | int, n: int) -> np.ndarray | int:
    """Where the node stands in the log of ``n`` leaves: so many levels behind the last leaf below it."""
    return written(np.minimum((index + 1) * ARITY**level, n) - 1) + level


def steps(place: int, n: int) -> list[tuple[int, int]]:
    """(place in the run, length of the run) of every level from a leaf to the root."""
    out = []
    while n > 1:
        slot = place % ARITY
        out.append((slot, min(ARITY, n - place + slot)))
        place, n = place // ARITY, -(-n // ARITY)
    return out


# ---- builders


def digest_of(run: list[bytes]) -> bytes:
    """A node: the SHA-256 of its children's digests, as hexadecimal text, in a row."""
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


class Builder:
    """Appends leaves and closes runs as they fill; ``log`` has all nodes in completion order."""

    def __init__(self, levels: int):
        self.log: list[bytes] = []
        self.runs: list[list[bytes]] = [[] for _ in range(levels)]

    def append(self, digest: bytes, level: int = 0) -> None:
        self.log.append(digest)
        if level < len(self.runs):
            self.runs[level].append(digest)
            if len(self.runs[level]) == ARITY:
                self.close(level)

    def close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        self.append(digest_of(run), level + 1)

    def finish(self) -> list[bytes]:
        for level, run in enumerate(self.runs):
            if run:
                self.close(level)
        return self.log


def segment(leaves: list[bytes], n: int) -> bytes:
    """The log of one builder's leaves, of ``n`` in its tier."""
    builder = Builder(min(HEIGHT, height(n)))
    for leaf in leaves:
        builder.append(leaf)
    return b"".join(builder.finish())


# ---- leaves


def leaf(columns: list[Column]) -> Column:
    """Digest (binary) of a row: of each value its UTF-8 byte count, a colon and the value, or ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


# ---- forest of one tree for each group


def tiers_of(leaves: DataFrame) -> list[DataFrame]:
    """Staged tiers of builders over ``leaves`` (staged: group_key, n, place, digest, row).

    A tier has a row for each builder: ``group_key, n, block, leaves`` (array of place, digest and, in the first, row) and ``log``.
    """
    tiers: list[DataFrame] = []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        fields = [f for f in leaves.columns if f not in ("group_key", "n")]
        blocks = leaves.groupBy("group_key", "n", F.floor(F.col("place") / BLOCK).cast("long").alias("block"))
        # at most BLOCK leaves
        blocks = blocks.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("leaves"))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = batch.column(3)
                digests = held.flatten().field("digest").to_pylist()
                ends = (held.offsets.to_numpy() - held.offsets[0].as_py()).tolist()
                logs = [segment(digests[a:b], n) for a, b, n in zip(ends, ends[1:], batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.binary())], [*batch.schema.names, "log"])

        schema = T.StructType([*blocks.schema.fields, T.StructField("log", T.BinaryType())])
        tiers.append(common.stage(blocks.mapInArrow(build, schema), "merkle-log"))
        if most <= BLOCK:
            return tiers
        most = -(-most // BLOCK)
        upper = tiers[-1].filter(F.col("n") > BLOCK)
        leaves = upper.select("group_key", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("place"), root_of("log").alias("digest"))


def root_of(log: str) -> Column:
    """The last node of a segment."""
    return F.substring(log, -DIGEST, DIGEST)


def roots_of(tiers: list[DataFrame]) -> DataFrame:
    """``group_key, digest``: the root of each tree."""
    out = None
    for tier in tiers:
        own = tier.filter(F.col("n") <= BLOCK).select("group_key", root_of("log").alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


@dataclass(frozen=True)
class Manifest:
    """Tiers of the groups' trees and of the tree over the groups (there ``row`` holds the group's key)."""

    groups: list[DataFrame]
    top: list[DataFrame]

    @property
    def root(self) -> DataFrame:
        """``root`` (hexadecimal): one row, none for an empty table."""
        return roots_of(self.top).select(F.lower(F.hex("digest")).alias("root"))

    def log(self) -> DataFrame:
        """``group_key, position, level, digest``: all nodes of the groups' trees; by position they are in postorder."""
        sizes, out = self.groups[0].select("group_key", F.col("n").alias("size")).distinct(), None
        for tier, df in enumerate(self.groups):
            segments = df.select("group_key", "n", "block", "log").join(sizes, "group_key")
            own = segments.mapInArrow(_nodes(tier), "group_key string, position long, level int, digest binary")
            out = own if out is None else out.unionByName(own)
        return out


def _nodes(tier: int):
    """Nodes of a tier's segments, by their place in the whole log; a tier's leaves are the roots of the one below."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, n, block, log, size in zip(*(c.to_pylist() for c in batch.columns)):
                for level, at in enumerate(addresses(min(BLOCK, n - block * BLOCK), n)):
                    if tier and not level:
                        continue
                    index = block * ARITY ** (HEIGHT - level) + np.arange(len(at))
                    places, digests = position(tier * HEIGHT + level, index, size), [log[DIGEST * a : DIGEST * (a + 1)] for a in at.tolist()]
                    columns = [pa.array([key] * len(at), pa.string()), pa.array(places), pa.array(np.full(len(at), tier * HEIGHT + level, dtype=np.int32)), pa.array(digests, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["group_key", "position", "level", "digest"])

    return opened


def addresses(own: int, n: int) -> list[np.ndarray]:
    """Of each level of a builder with ``own`` leaves, in a tier of ``n``: where its nodes stand in the segment."""
    return [position(level, np.arange(-(-own // ARITY**level)), own) for level in range(min(HEIGHT, height(n)) + 1)]


def build(rows: DataFrame, by: str | None, digest: str, order: list[str], keep: list[str]) -> Manifest:
    """The manifest of ``rows`` (staged), a tree for each value of ``by``, its leaves ``digest`` by ``order``.

    ``keep`` names columns that proofs carry. Groups are ordered by the UTF-8 bytes of their key, null first.
    """
    # told apart from an empty text, and in front of it
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{by}`").cast("string")), F.lit("")) if by else F.lit("")
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    ranks = [F.col(f"`{c}`").alias(f"by_{k}") for k, c in enumerate(order)]
    leaves = rows.select(key.alias("group_key"), *ranks, F.col(f"`{digest}`").alias("digest"), F.monotonically_increasing_id().alias("number"), row.alias("row"))
    leaves = common.stage(leaves, "leaves")
    found = common.stage(placed(leaves, ["group_key"], [*[f"by_{k}" for k in range(len(order))], "digest", "number"]), "placed-leaves")
    sizes = found.groupBy("group_key").agg(F.count("*").alias("n"))
    groups = tiers_of(common.stage(found.select("group_key", "place", "digest", "row").join(sizes, "group_key"), "sized-leaves"))
    roots = roots_of(groups).withColumnRenamed("group_key", "key")
    roots = common.stage(roots.select(F.lit("").alias("group_key"), "key", "digest", F.struct("key").alias("row")), "subroots")
    n = roots.count()
    subroots = placed(roots, ["group_key"], ["key"]).select("group_key", F.lit(n).cast("long").alias("n"), "place", "digest", "row")
    return Manifest(groups, tiers_of(common.stage(subroots, "placed-subroots")))


# ---- proofs


def _with_siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a tier with ``above`` (siblings of the builder's root) to one row for each of its leaves."""
    for batch in batches:
        held = batch.column(batch.schema.get_field_index("leaves"))
        flat, first = held.flatten(), held.offsets[0].as_py()
        get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
        ends = [x - first for x in held.offsets.to_pylist()]
        for a, b, n, log, above in zip(ends, ends[1:], get("n"), get("log"), get("above")):
            levels = [[log[DIGEST * x : DIGEST * (x + 1)] for x in at.tolist()] for at in addresses(b - a, n)]
            tails = [above or b""]
            for nodes in reversed(levels[:-1]):
                runs = [nodes[k : k + ARITY] for k in range(0, len(nodes), ARITY)]
                tails = [b"".join(run[:slot] + run[slot + 1 :]) + tail for run, tail in zip(runs, tails) for slot in range(len(run))]
            yield pa.RecordBatch.from_arrays([flat.slice(a, b - a), pa.array(tails, pa.binary())], ["leaf", "siblings"])


def _opened(tier: DataFrame, above: DataFrame) -> DataFrame:
    """``leaf`` (struct of place, digest, row and the builder's columns), ``siblings`` of every leaf of a tier."""
    kept = tier.schema["leaves"].dataType.elementType
    rows = tier.join(above, ["group_key", "block"])
    # what is the same for all leaves of a builder stands with each of them
    whole = [F.col("group_key"), F.col("n")] + [F.col(c) for c in above.columns if c not in ("group_key", "block", "above")]
    own = F.transform("leaves", lambda x: F.struct(*[x[f.name].alias(f.name) for f in kept.fields], *whole))
    rows = rows.select("n", "log", "above", own.alias("leaves"))
    leaf_type = rows.schema["leaves"].dataType.elementType
    return rows.mapInArrow(_with_siblings, T.StructType([T.StructField("leaf", leaf_type), T.StructField("siblings", T.BinaryType())]))


def _descend(tiers: list[DataFrame], starts: DataFrame) -> DataFrame:
    """Leaves of the first tier with all their siblings; ``starts`` has ``group_key, above`` and more columns of each tree."""
    more = [c for c in starts.columns if c not in ("group_key", "above")]
    found = None
    for k, tier in reversed(list(enumerate(tiers))):
        begun = tier.filter(F.col("n") <= BLOCK).select("group_key", "block").join(starts, "group_key")
        above = begun.select("group_key", "block", "above", *more)
        if found is not None:
            lower = found.select(F.col("leaf.group_key").alias("group_key"), F.col("leaf.place").alias("block"), F.col("siblings").alias("above"), *[F.col(f"leaf.{c}").alias(c) for c in more])
            above = above.unionByName(lower)
        found = _opened(tier, above)
        if k:
            found = common.stage(found, "upper-proofs")
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """One row for each leaf: ``row`` (carried columns), ``leaf, subroot, root`` (binary), ``siblings`` (their digests in a
    row, level by level from the leaf to the root, left to right), ``place, n`` in the group and ``group_place, n_groups``."""
    root = roots_of(manifest.top).select("group_key", F.lit(b"").alias("above"), F.col("digest").alias("root"))
    top = _descend(manifest.top, root)
    starts = top.select(
        F.col("leaf.row.key").alias("group_key"),
        F.col("siblings").alias("above"),
        F.col("leaf.digest").alias("subroot"),
        F.col("leaf.root").alias("root"),
        F.col("leaf.place").alias("group_place"),
        F.col("leaf.n").alias("n_groups"),
    )
    found = _descend(manifest.groups, common.stage(starts, "group-proofs"))
    names = {"row": "row", "leaf": "digest", "subroot": "subroot", "root": "root", "place": "place", "n": "n", "group_place": "group_place", "n_groups": "n_groups"}
    return found.select(*[F.col(f"leaf.{field}").alias(name) for name, field in names.items()], "siblings")


def fold(digest: bytes, siblings: bytes, places: list[tuple[int, int]]) -> bytes:
    """The root that a leaf and its siblings give."""
    at = 0
    for slot, width in places:
        here, end = at + DIGEST * slot, at + DIGEST * (width - 1)
        digest = digest_of([siblings[at:here], digest, siblings[here:end]])
        at = end
    return digest


def folded(found: DataFrame, claimed: Column) -> DataFrame:
    """``proofs`` with ``folded_root`` (binary): what the digest ``claimed`` and the siblings give."""
    rows = found.withColumn("claimed", claimed)

    def recompute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
            columns = zip(*map(get, ("claimed", "siblings", "place", "n", "group_place", "n_groups")))
            out = [fold(d, s, steps(p, n) + steps(gp, gn)) for d, s, p, n, gp, gn in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "folded_root"])

    return rows.mapInArrow(recompute, T.StructType([*rows.schema.fields, T.StructField("folded_root", T.BinaryType())])).drop("claimed")
