"""Merkle manifests of datasets: pointer-jumping proofs.

Every document is a leaf: the digest of its columns, each with its length. Leaves of a
language ascend by doc_id and are hashed in runs of ``FANOUT`` until one node remains;
these subroots, by language, are hashed likewise into the root. All digests are SHA-256;
inputs are joined, digests as lower-case hex.

Ranks within a language come from range partitions, so no language meets in one task. A
level of the tree is one aggregate over the level below, an eighth of its size. Proofs
come from pointer jumping: at first each inner node holds its siblings (those on the left,
those on the right) and points to its parent; each round joins nodes with the nodes that
they point to, which doubles the distance and joins the segments, until all point to the
root: the logarithm of the depth in rounds. Leaves, the largest level, join last: runs of
eight with their parent's whole proof. All is built-in column functions; each level and
round is a written table, so that lost executors cost one step.

Defined cases: null columns are hashed as ``-``, null languages and ids come first; rows
with equal ids ascend by digest, and equal rows, whose proofs may be exchanged, each keep
a leaf; empty texts have length 0; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelog.operators.ranks import running_sums
from parcelog.storage import materialize

FANOUT = 8
#: Columns that a leaf's digest covers, in this order (fixed).
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a document's columns, some of them changed."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return _sha(F.concat(*map(field, COLUMNS)))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and ``other``: the leaf of a document of which every third id's text is lower-cased (A-Z)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c for c in COLUMNS if c != "doc_id"])
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return own.select("doc_id", "lang", leaf_digest().alias("leaf"), leaf_digest(text=lowered).alias("other"))


def _runs(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Runs of nodes (tree, idx, n, digest) with their members by place: tree, idx (of the parent), n, kids."""
    members = F.array_sort(F.collect_list(F.struct("idx", "digest", *carried)))  # FANOUT at most
    return nodes.filter("n > 1").groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("parent"), "n").agg(members.alias("kids"))


def _parents(runs: DataFrame) -> DataFrame:
    """The nodes above runs."""
    joined = F.array_join(F.transform("kids", lambda k: _hex(k["digest"])), "")
    return runs.select("tree", F.col("parent").alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"), _sha(joined).alias("digest"))


def _bytes(kids: Column) -> Column:
    return F.aggregate(kids, F.lit(b""), lambda s, k: F.concat(s, k["digest"]))


def _siblings(runs: DataFrame, carried: list[str]) -> DataFrame:
    """Members of runs with ``segment``: their siblings on both sides."""
    each = runs.select("tree", "parent", "n", "kids", F.posexplode("kids").alias("at", "kid"))
    left, right = F.slice("kids", F.lit(1), F.col("at")), F.slice("kids", F.col("at") + 2, F.lit(FANOUT))
    segment = F.array(F.struct(_bytes(left).alias("left"), _bytes(right).alias("right"))).cast(PROOF)
    return each.select("tree", "parent", "n", "kid.idx", "kid.digest", *[f"kid.{c}" for c in carried], segment.alias("segment"))


def _grow(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame]:
    """Trees over nodes: links (tree, level, idx, to_level, to_idx, segment, top) of all levels from ``level`` on, and
    the tops (tree, level, digest). ``to_level`` is null where a node is its tree's top."""
    links, tops = [], []
    while True:
        own = nodes.filter("n = 1").select("tree", F.lit(level).alias("level"), "digest")
        tops.append(own)
        if nodes.filter("n > 1").isEmpty():
            break
        runs = materialize(_runs(nodes, []), "merkle-runs")
        links.append(_siblings(runs, []).select("tree", F.lit(level).alias("level"), "idx", F.lit(level + 1).alias("to_level"), F.col("parent").alias("to_idx"), "segment"))
        nodes, level = _parents(runs), level + 1
    return links, _union(tops)


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole


def proofs(leaves: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Leaves (doc_id, lang, leaf, carried columns) with ``subroot``, ``root`` and ``proof``, the siblings to the left and
    right of each step from the leaf to the root."""
    named = leaves.select(F.coalesce(F.concat(F.lit("1+"), "lang"), F.lit("1")).alias("tree"), "doc_id", F.col("leaf").alias("digest"), *carried)  # null first, bytewise
    placed = running_sums(named, ["tree"], [F.col("doc_id").asc_nulls_first(), "digest", *carried], {"idx": F.lit(1)})
    placed = materialize(placed.withColumn("idx", F.col("idx") - 1), "merkle-leaves")
    sizes = materialize(placed.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")  # a row for each language
    kept = ["doc_id", *carried]
    sized = placed.join(sizes, "tree")
    runs = materialize(_runs(sized, kept), "merkle-runs")
    links, inner_tops = _grow(_parents(runs), 1)
    lone = sized.filter("n = 1")
    tops = materialize(inner_tops.unionByName(lone.select("tree", F.lit(0).alias("level"), "digest")), "merkle-tops")

    # The subroots are the leaves of one more tree; its top is the root.
    ordered = running_sums(tops, [], ["tree"], {"idx": F.lit(1)})
    above = ordered.select("*", (F.col("idx") - 1).alias("at")).drop("idx").crossJoin(tops.agg(F.count("*").alias("n")))  # one row
    above = materialize(above, "merkle-subroots")
    upper, roots = _grow(above.select(F.lit("2").alias("tree"), F.col("at").alias("idx"), "n", "digest"), 0)
    root = materialize(roots.select(F.col("level").alias("top"), F.col("digest").alias("root")), "merkle-root")  # one row, none without leaves
    known = above.select("tree", "level", F.col("at").alias("idx"), F.col("digest").alias("subroot"))
    nodes = F.lit(None).cast("binary").alias("subroot")
    rows = [t.select("*", nodes) for t in links]
    if upper:  # a subroot's first step is the one within the upper tree
        step = upper[0].select(F.col("idx").alias("idx"), F.lit("2").alias("to_tree"), "to_level", "to_idx", "segment")
        first = known.join(step, "idx").select("tree", "level", F.lit(0).cast("long").alias("idx"), "to_level", "to_idx", "segment", "subroot", "to_tree")
        rows = [t.withColumn("to_tree", F.col("tree")) for t in rows + [t.select("*", nodes) for t in upper[1:]]] + [first]
    else:  # one language: its top is the root
        none = [F.lit(None).cast("int").alias("to_level"), F.lit(None).cast("long").alias("to_idx"), F.array().cast(PROOF).alias("segment")]
        first = known.select("tree", "level", F.lit(0).cast("long").alias("idx"), *none, "subroot", F.lit(None).cast("string").alias("to_tree"))
        rows = [t.withColumn("to_tree", F.col("tree")) for t in rows] + [first]
    paths = _to_root(_union(rows), root)

    shared = ["subroot", "segment"]
    steps = _siblings(runs, kept).withColumnRenamed("segment", "own").drop("idx")
    found = steps.join(paths.filter("level = 1").select("tree", F.col("idx").alias("parent"), *shared), ["tree", "parent"])
    own = [F.col("digest").alias("leaf"), "subroot"]
    found = found.select("doc_id", *carried, *own, F.concat("own", "segment").alias("proof"))
    alone = lone.join(paths.filter("level = 0").select("tree", *shared), "tree").select("doc_id", *carried, *own, F.col("segment").alias("proof"))
    return found.unionByName(alone).crossJoin(F.broadcast(root.select("root")))  # one row


def _to_root(links: DataFrame, root: DataFrame) -> DataFrame:
    """Nodes with the segments of all steps to the root, by pointer jumping: a null pointer has arrived."""
    at_root = (F.col("to_tree") == "2") & (F.col("to_level") == F.col("top"))
    clear = {c: F.when(~F.coalesce(at_root, F.lit(False)), F.col(c)) for c in ("to_level", "to_idx", "to_tree")}
    paths = materialize(links.crossJoin(F.broadcast(root.select("top"))).withColumns(clear).drop("top"), "merkle-paths")
    while not paths.filter("to_tree is not null").isEmpty():
        far = paths.select(
            F.col("tree").alias("to_tree"), F.col("level").alias("to_level"), F.col("idx").alias("to_idx"), F.col("to_tree").alias("next_tree"), F.col("to_level").alias("next_level"),
            F.col("to_idx").alias("next_idx"), F.col("segment").alias("more"), F.col("subroot").alias("its"),
        )
        jumped = paths.filter("to_tree is not null").join(far, ["to_tree", "to_level", "to_idx"])
        moved = jumped.select(
            "tree", "level", "idx", F.col("next_level").alias("to_level"), F.col("next_idx").alias("to_idx"), F.concat("segment", "more").alias("segment"),
            F.coalesce("subroot", "its").alias("subroot"), F.col("next_tree").alias("to_tree"),
        )
        paths = materialize(paths.filter("to_tree is null").unionByName(moved), "merkle-paths")
    return paths


def fold(leaf: Column, proof: Column) -> Column:
    """The root, as hex, that a leaf and the siblings on its way give."""
    return F.aggregate(proof, _hex(leaf), lambda s, p: F.sha2(F.concat(_hex(p["left"]), s, _hex(p["right"])).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the siblings on the way, left to right, step by step."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(_hex(p["left"]), _hex(p["right"]))), "").cast("binary"), 256)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Each document's leaf, subroot, root and proof, and whether its other leaf (see ``leaves``) still folds to the root."""
    found = proofs(leaves(docs), ("other",)).withColumn("folded_root", fold(F.col("other"), F.col("proof")))
    texts = [_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select("doc_id", *texts, proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == _hex(F.col("root"))).alias("verified"))
