"""Merkle manifest of a dataset: a content-addressed DAG and inclusion proofs.

Every row is a leaf digest. Per group (language) the leaves in order form a
tree of fixed fan-out, and the groups' subroots in order form the tree above
them. The DAG is stored as digest-to-children records, packed into segments:
a segment is addressed by the digest of its top node and holds the records of
the LEVELS levels below it, so it leads to at most fanout ** LEVELS nodes.

Requests descend from the root. A frontier row (a segment's address, the path
above it) meets its segment by digest; inside, the digits of a request's rank
select the child at each level and the unselected children are collected.
The path segments, reversed, are the proof from leaf to root. The rows of a
segment travel as one, so a tree of n leaves takes log(n) / LEVELS joins, and no
path is shuffled per leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promofund.llm.common import ranks, save, scan

FANOUT, LEVELS = 2, 10
RECORDS = "array<struct<digest:string,children:array<string>>>"


def digest(*parts) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def height(n: int, fanout: int) -> int:
    levels = 0
    while n > 1:
        n = -(-n // fanout)
        levels += 1
    return levels


def seal(digests: list[str], levels: int, fanout: int) -> tuple[str, list[dict]]:
    """The top digest over ``digests`` after ``levels`` levels, and the records
    of all nodes above them. A last run may be short, down to one node."""
    from hashlib import sha256

    records = {}
    for _ in range(levels):
        above = []
        for k in range(0, len(digests), fanout):
            children = digests[k : k + fanout]
            top = sha256("".join(children).encode()).hexdigest()
            records[top] = children
            above.append(top)
        digests = above
    assert len(digests) == 1
    return digests[0], [{"digest": d, "children": c} for d, c in records.items()]


def descend(top: str, levels: int, place: int, children: dict[str, list[str]], fanout: int) -> tuple[str, list[str], list[str]]:
    """From ``top`` by the digits of ``place``: the node reached, and per level,
    downwards, the unselected children to the left and to the right, joined."""
    lefts, rights, node = [], [], top
    for level in range(levels - 1, -1, -1):
        digit = place // fanout**level % fanout
        run = children[node]
        lefts.append("".join(run[:digit]))
        rights.append("".join(run[digit + 1 :]))
        node = run[digit]
    return node, lefts, rights


@dataclass
class Tree:
    """The stored DAG of some groups of leaves: ``strides[0]`` holds the lowest
    segments (grp, idx, n, digest, levels, width, records), the last one a
    segment per group, whose digest is the group's (sub)root."""
    strides: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        return self.strides[-1].select("grp", "digest")

    def nodes(self) -> DataFrame:
        """All digest-to-children records, equal nodes once."""
        out = self.strides[0].select(F.inline("records"))
        for stride in self.strides[1:]:
            out = out.unionByName(stride.select(F.inline("records")))
        return out.dropDuplicates(["digest"])


def _segments(blocks: DataFrame, fanout: int) -> DataFrame:
    """blocks: (grp, idx, n, digests), n nodes in the group at this height."""
    def make(batches):
        for b in batches:
            grp, idx, size, nodes = (b.column(c).to_pylist() for c in ("grp", "idx", "n", "digests"))
            levels = [min(LEVELS, height(n, fanout)) for n in size]
            sealed = [seal(d, lv, fanout) for d, lv in zip(nodes, levels, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp, pa.int64()), pa.array(idx, pa.int64()), pa.array([-(-n // fanout**LEVELS) for n in size], pa.int64()),
                 pa.array([top for top, _ in sealed], pa.string()), pa.array(levels, pa.int32()), pa.array([len(d) for d in nodes], pa.int32()),
                 pa.array([r for _, r in sealed], pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))],
                names=["grp", "idx", "n", "digest", "levels", "width", "records"])

    return blocks.mapInArrow(make, f"grp long, idx long, n long, digest string, levels int, width int, records {RECORDS}")


def build(leaves: DataFrame, fanout: int = FANOUT) -> Tree:
    """leaves: (grp, idx, n, digest) - place in its group, leaves of the group."""
    span, strides, nodes = fanout**LEVELS, [], leaves
    while True:
        blocks = (nodes.groupBy("grp", F.floor(F.col("idx") / span).cast("long").alias("block"))
                  .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("digests"))
                  .withColumnRenamed("block", "idx"))
        strides.append(save(_segments(blocks, fanout), "manifest-segments"))
        nodes = strides[-1].select("grp", "idx", "n", "digest")
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return Tree(strides, fanout)


FRONTIER = "grp long, idx long, digest string, path array<struct<left:string,right:string>>, root string, subroot string"


def _paths(lefts: list[list[str]], rights: list[list[str]]) -> pa.ListArray:
    offsets = [0]
    for p in lefts:
        offsets.append(offsets[-1] + len(p))
    both = pa.StructArray.from_arrays([pa.array([x for p in side for x in p], pa.string()) for side in (lefts, rights)], names=["left", "right"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), both)


def _step(frontier: DataFrame, stride: DataFrame, fanout: int, requests: DataFrame | None = None) -> DataFrame:
    """Each frontier row through its segment: a row per node below it, or, at
    the lowest stride, per request, its path reversed."""
    span = fanout**LEVELS
    stored = stride.select("digest", "levels", "width", "records").dropDuplicates(["digest"])
    rows = frontier.join(stored, "digest")
    last = requests is not None
    if last:
        rows = rows.join(requests, ["grp", "idx"])

    def walk(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # a segment holds at most span nodes
                row = batch.slice(k, 1).to_pylist()[0]
                children = {r["digest"]: r["children"] for r in row["records"]}
                above = [p["left"] for p in row["path"]], [p["right"] for p in row["path"]]
                ends, lefts, rights = [], [], []
                for place in range(row["width"]):
                    node, left, right = descend(row["digest"], row["levels"], place, children, fanout)
                    ends.append(node)
                    lefts.append(above[0] + left)
                    rights.append(above[1] + right)
                n = len(ends)
                if not last:
                    first = [pa.array([row["grp"]] * n, pa.int64()), pa.array([row["idx"] * span + p for p in range(n)], pa.int64()),
                             pa.array(ends, pa.string())]
                    names = ["grp", "idx", "digest"]
                else:
                    assert ends == [r["leaf"] for r in row["asked"]]
                    lefts, rights = [p[::-1] for p in lefts], [p[::-1] for p in rights]
                    first = [pa.array([r["key"] for r in row["asked"]], pa.int64()), pa.array(ends, pa.string()),
                             pa.array([r["altered"] for r in row["asked"]], pa.string())]
                    names = ["key", "leaf", "altered"]
                yield pa.RecordBatch.from_arrays(
                    [*first, _paths(lefts, rights), pa.array([row["root"]] * n, pa.string()), pa.array([row["subroot"]] * n, pa.string())],
                    names=[*names, "path", "root", "subroot"])

    lowest = FRONTIER.replace("grp long, idx long, digest string", "key long, leaf string, altered string")
    return rows.mapInArrow(walk, lowest if last else FRONTIER)


def prove(leaves: DataFrame, group: str, fanout: int = FANOUT) -> DataFrame:
    """Inclusion proofs of all rows of ``leaves``: (``group``, key long, leaf,
    altered), a written table.

    Returns key, leaf, altered, subroot, root and path: per level from the leaf
    to the root the siblings on the left and on the right, joined. Leaves of a
    group ascend by key, then by leaf; equal rows are leaves of their own. A
    null group is a group, and null keys come first. A group of one leaf is its
    own subroot, a single subroot the root. No rows give no rows.
    """
    span = fanout**LEVELS
    names = save(leaves.groupBy(group).count(), "manifest-groups")
    names = ranks(names, [], [group], "manifest-names").select(F.col(group).alias("__name"), F.col("rank").alias("grp"), F.col("size").alias("groups"))
    names = save(names, "manifest-group-ranks")
    rows = ranks(leaves, [group], ["key", "leaf"], "manifest-leaves").withColumnsRenamed({"rank": "idx", "size": "n"})
    rows = rows.join(names, F.col(group).eqNullSafe(F.col("__name")))
    asked = (rows.groupBy("grp", F.floor(F.col("idx") / span).cast("long").alias("block"))
             .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.col("idx").alias("at"), "key", "leaf", "altered"))).alias("asked"))
             .withColumnRenamed("block", "idx"))
    asked = save(asked, "manifest-requests")
    low = build(asked.select("grp", "n", F.inline("asked")).select("grp", F.col("at").alias("idx"), "n", F.col("leaf").alias("digest")), fanout)
    high = build(names.drop("__name").join(low.roots(), "grp")
                 .select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("idx"), F.col("groups").alias("n"), "digest"), fanout)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    at = high.roots().select("grp", F.lit(0).cast("long").alias("idx"), "digest", nothing.alias("path"), F.col("digest").alias("root"),
                             F.lit(None).cast("string").alias("subroot"))
    for stride in reversed(high.strides):
        at = _step(at, stride, fanout)
    at = at.select(F.col("idx").alias("grp"), F.lit(0).cast("long").alias("idx"), "digest", "path", "root", F.col("digest").alias("subroot"))
    for stride in reversed(low.strides[1:]):
        at = save(_step(at, stride, fanout), "manifest-frontier")
    return _step(at, low.strides[0], fanout, asked.select("grp", "idx", "asked"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["left"], d, s["right"]))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All documents, fan-out 2, groups by language. Tampering adds one to
    n_chars where 7 divides the checksum of the doc_id; a null doc_id or n_chars
    is never tampered with."""
    docs = scan(spark, sf_dir, "documents")
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    struck = (F.crc32(doc_id.cast("string")) % 7 == 0) & n_chars.isNotNull()
    leaves = docs.select("lang", doc_id.cast("long").alias("key"), leaf_digest(doc_id, source, lang, n_chars, text).alias("leaf"),
                         F.when(struck, leaf_digest(doc_id, source, lang, n_chars.cast("decimal(20,0)") + 1, text)).alias("altered"))
    proofs = prove(save(leaves, "manifest-rows"), "lang")
    folded = proofs.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return folded.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
