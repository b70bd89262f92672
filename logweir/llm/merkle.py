"""Merkle manifest of a dataset: a content-addressed store of digests, and proofs read from it by descent.

Each source has a tree over its rows, and a tree over the sources' roots gives the dataset's root. Every FAN nodes in a
row have one parent. The store holds, under the digest of a node, the digest-to-children records of the DIGITS levels
below it (a *bundle*), so that a request descends DIGITS digits of its rank with one join. Requests whose ranks begin
alike travel as one row until they part: a hop reads each bundle once, however many rows lie below it.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import written
from logweir.operators.ordered import number_rows
from logweir.operators.skew import lookup_join

FAN = 3
#: Levels of a bundle; a bundle spans up to FAN ** DIGITS nodes.
DIGITS = 4
SPAN = FAN**DIGITS
#: Rows of an Arrow batch made into Python values at once.
SLICE = 64

_RECORDS = "array<struct<digest:string,children:array<string>>>"
_PATH = "array<struct<digit:int,others:array<string>>>"
_FRONTIER = f"tree long, at long, digest string, rounds int, path {_PATH}, subroot string, root string"
_BUNDLES = f"tree long, at long, n long, digest string, levels int, records {_RECORDS}"


def joined_digest(digests: list[str]) -> str:
    """sha256 of digests written one after the other as hexadecimal text."""
    return sha256("".join(digests).encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """sha256 over values: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """``root``: (digest), no row for an empty dataset. ``claims``: (tree, at, rows), the rows of each lowest bundle in
    order. ``sources`` and ``leaves``: bundles of the tree over sources and of the trees below it; a request takes
    ``source_rounds`` and up to ``leaf_rounds`` hops through them. ``trees``: (tree, subroot, rounds) of each source."""

    root: DataFrame
    claims: DataFrame
    sources: DataFrame
    leaves: DataFrame
    trees: DataFrame
    source_rounds: int
    leaf_rounds: int

    def records(self) -> DataFrame:
        """(digest, children) of every inner node, each digest once."""
        both = self.sources.select("records").unionByName(self.leaves.select("records"))
        return both.select(F.inline("records")).dropDuplicates(["digest"])


def bundle(nodes: list[str], whole: bool) -> tuple[str, int, list[tuple[str, list[str]]]]:
    """Digest above ``nodes``, the levels built and their records, lowest first.

    A whole tree grows until one node is left, so that a lone node is its own root; a part of one grows DIGITS levels.
    """
    records, levels = [], 0
    while len(nodes) > 1 if whole else levels < DIGITS:
        runs = [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)]
        nodes = [joined_digest(run) for run in runs]
        records += zip(nodes, runs, strict=True)
        levels += 1
    return nodes[0], levels, records


def paths(digest: str, levels: int, records: dict[str, list[str]]) -> Iterator[tuple[list[int], str, list[dict]]]:
    """Digits, digest and path segment of each node ``levels`` below ``digest``, in order.

    A segment has one entry per level, from the top: the digit that chose a child, and the children not chosen.
    """
    if not levels:
        yield [], digest, []
        return
    children = records[digest]
    for digit, child in enumerate(children):
        step = {"digit": digit, "others": children[:digit] + children[digit + 1 :]}
        for digits, node, segment in paths(child, levels - 1, records):
            yield [digit, *digits], node, [step, *segment]


def folded(leaf: str, path: list[dict]) -> str:
    """The root that a leaf and the siblings on its way to the root, lowest first, give."""
    for step in path:
        others, digit = step["others"], step["digit"]
        leaf = joined_digest([*others[:digit], leaf, *others[digit:]])
    return leaf


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE).to_pylist()


def _known(records: list[dict]) -> dict[str, list[str]]:
    return {record["digest"]: record["children"] for record in records}


_ARROW_RECORDS = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
_ARROW_BUNDLES = pa.schema(
    [("tree", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("levels", pa.int32()), ("records", _ARROW_RECORDS)]
)
_ARROW_PATH = pa.list_(pa.struct([("digit", pa.int32()), ("others", pa.list_(pa.string()))]))
_ARROW_FRONTIER = pa.schema(
    [("tree", pa.int64()), ("at", pa.int64()), ("digest", pa.string()), ("rounds", pa.int32()), ("path", _ARROW_PATH), ("subroot", pa.string()), ("root", pa.string())]
)


def _make_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _rows(batches):
        out = []
        for row in rows:
            above = -(-row["n"] // SPAN)
            top, levels, records = bundle(row["nodes"], above == 1)
            made = [{"digest": digest, "children": children} for digest, children in records]
            out.append({"tree": row["tree"], "at": row["at"], "n": above, "digest": top, "levels": levels, "records": made})
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW_BUNDLES)


def _hop_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _rows(batches):
        for row in rows:
            out = []
            found = paths(row["digest"], row["levels"], _known(row["records"]))
            for place, (_, digest, segment) in enumerate(found):
                # Only the last bundle of a level may be short, so places count on from the bundles before.
                at = row["at"] * SPAN + place
                out.append({**row, "at": at, "digest": digest, "rounds": row["rounds"] - 1, "path": row["path"] + segment})
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_FRONTIER)


def _rounds(nodes: DataFrame, most: int, label: str) -> list[DataFrame]:
    """Bundles of each round over (tree, at, n, nodes), where ``most`` is the largest n of a tree."""
    out = []
    while True:
        made = written(nodes.mapInArrow(_make_bundles, _BUNDLES), label)
        out.append(made)
        most = -(-most // SPAN)
        if most <= 1:
            return out
        nodes = _gathered(made.filter("n > 1").select("tree", "at", "n", "digest"))


def _gathered(nodes: DataFrame) -> DataFrame:
    """The nodes (tree, at, n, digest) of each bundle as one list."""
    lists = nodes.groupBy("tree", F.expr(f"at div {SPAN}").alias("at"), "n").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("place"), "digest"))).alias("found")
    )
    return lists.select("tree", "at", "n", F.col("found.digest").alias("nodes"))


def _store(rounds: list[DataFrame]) -> DataFrame:
    """Bundles by digest: equal digests stand for equal bundles, of which one is kept."""
    every = reduce(DataFrame.unionByName, rounds)
    return written(every.select("digest", "levels", "records").dropDuplicates(["digest"]), "merkle-store")


def build_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: Column | None = None,
) -> Manifest:
    """Store of the digests of ``docs``: a leaf is ``leaf_digest`` of ``columns``.

    In a source rows are taken by id, null first, then by leaf, so that repeated rows may stand in any order. Sources,
    null being one, are taken in the order of their UTF-8 bytes, null first. ``claimed`` is the digest that each row
    brings forward when proofs are folded, by default its own leaf. Other columns are ignored.
    """
    leaf = leaf_digest([F.col(c) for c in columns])
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), leaf.alias("leaf"), (leaf if claimed is None else claimed).alias("claimed")
    )
    # Texts are hashed once; only digests are ranked.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = written(rows.withColumn("key", key).drop("source"), "merkle-leaves")
    placed = written(number_rows(rows, ["key", "id", "leaf"], "place"), "merkle-places")
    by_source = placed.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    trees = written(number_rows(by_source, ["key"], "tree").withColumn("tree", F.col("tree") - 1), "merkle-trees")
    n_sources, most = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    ranked = lookup_join(placed, trees, ["key"], "inner", ["place"])
    ranked = ranked.select("tree", "n", (F.col("place") - F.col("first")).alias("rank"), "id", "leaf", "claimed")
    entry = F.struct(F.col("rank"), "id", "leaf", "claimed")
    claims = ranked.groupBy("tree", F.expr(f"rank div {SPAN}").alias("at"), "n").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    claims = written(claims, "merkle-claims")
    low = _rounds(claims.select("tree", "at", "n", F.col("rows.leaf").alias("nodes")), most, "merkle-bundles")
    ends = [made.filter("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(k + 1).alias("rounds")) for k, made in enumerate(low)]
    # A tree of one bundle in some round has ended there; later rounds hold only what is still above one.
    subroots = written(reduce(DataFrame.unionByName, ends), "merkle-subroots")
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(n_sources).cast("long").alias("n"), F.col("subroot").alias("digest"))
    high = _rounds(_gathered(over), n_sources, "merkle-bundles")
    return Manifest(high[-1].select("digest"), claims, _store(high), _store(low), subroots, len(high), len(low))


def _hop(frontier: DataFrame, store: DataFrame) -> DataFrame:
    joined = frontier.join(store, "digest").select(*frontier.columns, "levels", "records")
    return joined.mapInArrow(_hop_batches, _FRONTIER)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field("rows").type.value_type.field("id").type
        schema = pa.schema([("id", kind), *((name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))])
        for k in range(0, batch.num_rows, SLICE):
            out = []
            for row in batch.slice(k, SLICE).to_pylist():
                found = paths(row["digest"], row["levels"], _known(row["records"]))
                for claim, (_, leaf, segment) in zip(row["rows"], found, strict=True):
                    upwards = [*reversed(segment), *reversed(row["path"])]
                    siblings = [digest for step in upwards for digest in step["others"]]
                    out.append(
                        {
                            "id": claim["id"],
                            "leaf": leaf,
                            "subroot": row["subroot"],
                            "root": row["root"],
                            "proof_sha256": joined_digest(siblings),
                            "folded_root": folded(claim["claimed"], upwards),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def prove(manifest: Manifest) -> DataFrame:
    """One row per row of the dataset: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    All requests start at the root and descend by the digits of their ranks, hop by hop; the children not chosen are
    their proof, which is read from the leaf upwards. ``folded_root`` is what the row's claimed leaf gives with them.
    An empty dataset gives no rows.
    """
    nothing = F.array().cast(_PATH)
    frontier = manifest.root.select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(0).cast("long").alias("at"),
        "digest",
        F.lit(manifest.source_rounds).alias("rounds"),
        nothing.alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for _ in range(manifest.source_rounds):
        frontier = _hop(frontier, manifest.sources)
    # Each request is at the root of its source now.
    below = manifest.trees.select(F.col("tree").alias("at"), F.col("rounds").alias("left"))
    frontier = frontier.join(below, "at").select(
        F.col("at").alias("tree"),
        F.lit(0).cast("long").alias("at"),
        "digest",
        F.col("left").alias("rounds"),
        "path",
        F.col("digest").alias("subroot"),
        "root",
    )
    for rounds in range(manifest.leaf_rounds, 1, -1):
        frontier = written(frontier, "merkle-frontier")
        waiting = frontier.filter(F.col("rounds") < rounds)
        frontier = waiting.unionByName(_hop(frontier.filter(F.col("rounds") == rounds), manifest.leaves))
    asked = manifest.claims.select("tree", "at", "rows").join(frontier.drop("rounds"), ["tree", "at"])
    asked = asked.join(manifest.leaves, "digest")
    kind = manifest.claims.schema["rows"].dataType.elementType["id"].dataType
    answers = asked.mapInArrow(
        _answers, f"id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return answers.withColumn("verified", F.col("folded_root") == F.col("root"))
