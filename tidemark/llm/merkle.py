"""A Merkle manifest of a table, with an octopus multiproof for each partition of leaves.

Every row is a leaf: a SHA-256 over its fields. Each group's leaves, in order, are the lowest level of a tree whose nodes
have ``fan`` children; the groups' roots, in order, are the leaves of another such tree, whose root stands for the table.

A partition holds consecutive leaves of one or more groups. It derives every node whose leaves it holds in full. What it
lacks is the octopus: on each level the siblings of its leaves' ancestors that are no ancestors themselves, at most
``fan - 1`` on either side of a group's stretch, whatever the number of leaves. These coordinates are asked for once for each
partition, and with what comes back it derives the interior nodes that its leaves share, up to the group's root, and expands
the proof of each leaf by itself. Nodes that no partition can derive alone (their leaves lie in several) are made level by
level in Spark from those that it can: some 2 * fan for each partition and level, so the tree is built without a second pass
over the leaves, and no task or driver holds a level of it.

Digests are lower-case hexadecimal text wherever they are hashed. A proof is the siblings of the path's nodes, level by level up
to the table's root, from left to right.

Defined cases: a null field counts as ``-``, so null and empty differ; a null group is the first group, a null key the first in
its group; rows with equal group and key come in the order of their digests, so ties are settled and of equal rows
each has its own leaf; a group's only leaf is its root and has no siblings there; an empty table gives an empty one.
Texts of any length are hashed whole by Spark, and never leave their scan; other columns, whatever their names, take no part.
A group with most of the rows is spread over partitions like any other, as they are cut by group and key together.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tasks import in_tasks
from tidemark.workspace import shared_table

FAN = 16
#: Leaves of a partition, about.
LEAVES = 100_000


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each its length in bytes, a colon and its text, or ``-`` if it is null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def level_sizes(leaves: int, fan: int) -> list[int]:
    """Nodes on each level, from the leaves to the one root."""
    sizes = [leaves]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // fan))
    return sizes


def known_ranges(first: int, stop: int, sizes: list[int], fan: int) -> list[tuple[int, int]]:
    """On each level the nodes whose leaves are all among ``first`` to ``stop`` (which is not included)."""
    ranges = [(first, stop)]
    for size in sizes[1:]:
        a, b = ranges[-1]
        below = sizes[len(ranges) - 1]
        low, high = -(-a // fan), size if b == below else b // fan
        ranges.append((low, max(low, high)))
    return ranges


def missing_nodes(first: int, stop: int, sizes: list[int], fan: int) -> list[tuple[int, int]]:
    """The octopus of a stretch of leaves: (level, place) of the siblings of their ancestors that are no ancestors."""
    found, a, b = [], first, stop
    for level, size in enumerate(sizes[:-1]):
        low, high = a // fan * fan, min(-(-b // fan) * fan, size)
        found += [(level, k) for k in (*range(low, a), *range(b, high))]
        a, b = a // fan, -(-b // fan)
    return found


def _derived(leaves: list[str], first: int, sizes: list[int], fan: int) -> list[list[str]]:
    """Digests of the nodes of :func:`known_ranges`."""
    levels = [leaves]
    ranges = known_ranges(first, first + len(leaves), sizes, fan)
    for level, (low, high) in enumerate(ranges[1:], 1):
        below, start = levels[-1], ranges[level - 1][0]
        levels.append([_h("".join(below[k * fan - start : (k + 1) * fan - start])) for k in range(low, high)])
    return levels


def _place_leaves(rows: DataFrame, leaves_per_part: int) -> DataFrame:
    """Leaves with ``part``, their ``place`` in the group from 0 and the group's ``size``.

    ``rows`` has ``grp``, ``ord`` and ``leaf``, and is a table, as it is read twice: the bounds of the partitions are sampled.
    """
    spark = rows.sparkSession
    count = rows.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // leaves_per_part))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("grp", "ord", "leaf", "row")]
    cut = numbered.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # In a sorted partition this number grows by one from row to row.
    cut = cut.drop("row").withColumn("part", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id())
    cut = shared_table(cut, "merkle-leaves")
    stretches = cut.groupBy("part", "grp").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("grp")
    # A row for each partition that a group is in.
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    stretches = shared_table(stretches.select("part", "grp", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size")), "merkle-stretches")
    mine = stretches.withColumnsRenamed({"part": "of_part", "grp": "of_grp"})
    placed = cut.join(mine, (F.col("part") == F.col("of_part")) & F.col("grp").eqNullSafe(F.col("of_grp")))
    placed = placed.select(*[c for c in cut.columns if c != "line"], (F.col("line") + F.col("shift")).alias("place"), "size")
    return shared_table(placed, "merkle-placed")


_NODES = "grp string, level int, place bigint, digest string, width bigint"
_NODES_ARROW = pa.schema([("grp", pa.string()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string()), ("width", pa.int64())])
_WANTED = "part int, grp string, level int, place bigint"
_WANTED_ARROW = pa.schema([("part", pa.int32()), ("grp", pa.string()), ("level", pa.int32()), ("place", pa.int64())])
_PATH = "array<struct<left:string,right:string>>"


def _tree_nodes(placed: DataFrame, fan: int) -> DataFrame:
    """The nodes that a partition can ask another for, and each group's root: ``grp, level, place, digest, width``.

    ``width`` is the number of nodes on the level: the root is where it is 1.
    """

    def arms(table: pa.Table) -> pa.Table:
        """Nodes whose leaves are all here and whose parent's are not."""
        rows = []
        table = table.sort_by([("has", "ascending"), ("grp", "ascending"), ("place", "ascending")])
        groups, places, leaves, sizes_of = (table.column(n).to_pylist() for n in ("grp", "place", "leaf", "size"))
        cuts = [k for k in range(len(groups)) if not k or groups[k] != groups[k - 1]]
        for start, stop in zip(cuts, [*cuts[1:], len(groups)]):
            sizes, first = level_sizes(sizes_of[start], fan), places[start]
            ranges = known_ranges(first, first + stop - start, sizes, fan)
            derived = _derived([d.hex() for d in leaves[start:stop]], first, sizes, fan)
            for level, (low, high) in enumerate(ranges):
                above = ranges[level + 1] if level + 1 < len(sizes) else (0, 0)
                for place in range(low, high):
                    if not above[0] <= place // fan < above[1]:
                        rows.append({"grp": groups[start], "level": level, "place": place, "digest": derived[level][place - low], "width": sizes[level]})
        return pa.Table.from_pylist(rows, _NODES_ARROW)

    in_tasks(placed.sparkSession)
    leaves = placed.select("part", F.col("grp").isNotNull().alias("has"), "grp", "place", "leaf", "size")
    every = shared_table(leaves.groupBy("part").applyInArrow(arms, _NODES), "merkle-arms")
    largest = placed.agg(F.max("size")).first()[0] or 0
    made = None
    for level in range(len(level_sizes(largest, fan)) - 1):
        children = every.where(F.col("level") == level)
        run = F.array_sort(F.collect_list(F.struct("place", "digest")))  # at most `fan` children
        made = (
            children.where("width > 1")
            .groupBy("grp", F.floor(F.col("place") / fan).alias("parent"))
            .agg(F.first("width").alias("below"), run.alias("run"))
            .select(
                "grp",
                F.lit(level + 1).alias("level"),
                F.col("parent").alias("place"),
                F.sha2(F.array_join(F.col("run.digest"), ""), 256).alias("digest"),
                F.ceil(F.col("below") / fan).alias("width"),
            )
        )
        every = every.unionByName(shared_table(made, "merkle-nodes"))
    return every


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that follows from a node and its siblings to the left and right on each level."""
    for left, right in path:
        digest = _h(left + digest + right)
    return digest


class _Stretch:
    """A stretch of a group's leaves with all runs of nodes that its leaves' ancestors are in."""

    def __init__(self, leaves: list[str], first: int, size: int, fan: int, fetched: dict[tuple[int, int], str]):
        self.first, self.fan, self.runs = first, fan, []
        own, a = leaves, first
        for level, width in enumerate(level_sizes(size, fan)[:-1]):
            b = a + len(own)
            low, high = a // fan * fan, min(-(-b // fan) * fan, width)
            row = [fetched[level, k] for k in range(low, a)] + own + [fetched[level, k] for k in range(b, high)]
            joined = ["".join(row[k : k + fan]) for k in range(0, len(row), fan)]
            self.runs.append((low // fan, joined))
            own, a = [_h(x) for x in joined], low // fan
        self.root = own[0]

    def path(self, place: int, level: int = 0) -> list[tuple[str, str]]:
        """Siblings to the left and right of a node on ``level`` and of its ancestors."""
        path = []
        for base, joined in self.runs[level:]:
            run, cut = joined[place // self.fan - base], 64 * (place % self.fan)
            path.append((run[:cut], run[cut + 64 :]))
            place //= self.fan
        return path


def _expanded(placed: DataFrame, nodes: DataFrame, fan: int, above: DataFrame | None = None) -> DataFrame:
    """Each leaf's ``ord``, ``grp``, ``leaf``, ``subroot``, ``folded`` and ``path`` (lower levels first).

    ``above`` has the ``path`` of each group's root in the tree over the groups, and what is folded goes on along it.
    ``folded`` starts from ``changed`` where that is given.
    """

    def octopus(batches):
        for batch in batches:
            rows = []
            for part, group, first, last, size in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [{"part": part, "grp": group, "level": level, "place": place} for level, place in missing_nodes(first, last + 1, level_sizes(size, fan), fan)]
            yield pa.RecordBatch.from_pylist(rows, _WANTED_ARROW)

    def proofs(part: list[tuple], fetched: dict, tops: dict):
        """``part``: (group, place, size, digest, ord, changed), in order."""
        cuts = [k for k in range(len(part)) if not k or part[k][0] != part[k - 1][0]]
        for start, stop in zip(cuts, [*cuts[1:], len(part)]):
            group, first, size = part[start][:3]
            stretch = _Stretch([r[3].hex() for r in part[start:stop]], first, size, fan, fetched.get(group, {}))
            top, run, common = tops.get(group, []), None, None
            whole = fold(stretch.root, top)  # the same for every leaf that is not changed
            for place, (_, _, _, digest, order, changed) in enumerate(part[start:stop], first):
                if run != place // fan:
                    # What follows the lowest level is the same for all leaves of a run.
                    run = place // fan
                    common = [*stretch.path(run, 1), *top]
                if stretch.runs:
                    base, joined = stretch.runs[0]
                    mine, cut = joined[run - base], 64 * (place % fan)
                    path = [(mine[:cut], mine[cut + 64 :]), *common]
                else:
                    path = top
                yield order, group, digest.hex(), stretch.root, whole if changed is None else fold(changed.hex(), path), path

    def expanded(batches):
        now, leaves, fetched, tops, out = None, [], {}, {}, []

        def given(rows):
            columns = list(zip(*rows))
            paths = pa.array([[{"left": x, "right": y} for x, y in p] for p in columns[5]], paths_kind)
            texts = [pa.array(columns[k], pa.string()) for k in (1, 2, 3, 4)]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], order_kind[0]), *texts, paths], ["ord", "grp", "leaf", "subroot", "folded", "path"])

        def closed():
            rows = []
            for row in proofs(leaves, fetched, tops):
                rows.append(row)
                if len(rows) == 512:
                    yield given(rows)
                    rows = []
            if rows:
                yield given(rows)

        for batch in batches:
            order_kind[0] = batch.schema.field("ord").type
            for part, kind, group, place, level, size, digest, order, changed, path in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield from closed()
                    now, leaves, fetched, tops = part, [], {}, {}
                if kind == 2:
                    leaves.append((group, place, size, digest, order, changed))
                elif kind == 1:
                    fetched.setdefault(group, {})[level, place] = digest.hex()
                else:
                    tops[group] = [(p["left"], p["right"]) for p in path]
        yield from closed()

    order_kind: list = [None]
    paths_kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    in_tasks(placed.sparkSession)
    kind = placed.schema["ord"].dataType.simpleString()
    # The ends of a stretch say what it lacks; the leaves themselves are not looked at.
    ends = placed.groupBy("part", "grp").agg(F.min("place").alias("place"), F.max("place").alias("last"), F.first("size").alias("size"))
    wanted = ends.mapInArrow(octopus, _WANTED)
    have = nodes.select(F.col("grp").alias("of"), F.col("level").alias("of_level"), F.col("place").alias("of_place"), "digest")
    same = F.col("grp").eqNullSafe(F.col("of")) & (F.col("level") == F.col("of_level")) & (F.col("place") == F.col("of_place"))

    def record(number: int, **columns) -> list[Column]:
        names = {"part": "int", "kind": "int", "grp": "string", "place": "bigint", "level": "int", "size": "bigint", "digest": "binary", "ord": kind, "changed": "binary", "path": _PATH}
        columns = {"part": F.col("part"), "grp": F.col("grp"), "kind": F.lit(number)} | columns
        return [columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in names.items()]

    c = F.col
    parts = placed.select(*record(2, place=c("place"), size=c("size"), digest=c("leaf"), ord=c("ord"), changed=c("changed")))
    parts = parts.unionByName(wanted.join(have, same).select(*record(1, level=c("level"), place=c("place"), digest=F.unhex("digest"))))
    if above is not None:
        tops = above.select(c("ord").alias("of"), "path")
        parts = parts.unionByName(ends.join(tops, c("grp").eqNullSafe(c("of"))).select(*record(0, path=c("path"))))
    # Each partition's fetched nodes come before its leaves, and these in order.
    together = parts.repartition("part").sortWithinPartitions("part", "kind", "grp", "place")
    return together.mapInArrow(expanded, f"ord {kind}, grp string, leaf string, subroot string, folded string, path {_PATH}")


def merkle_manifest(df: DataFrame, leaf: Column, group: str = "source", key: str = "doc_id", changed: Column | None = None, fan: int = FAN, leaves_per_part: int = LEAVES) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``group``, ``leaf``, ``subroot``, ``root``, ``path`` and ``folded_root``.

    ``path`` has for each level, from the leaf's to the table's root, the siblings to the left and right as one text each.
    ``folded_root`` is the root that the row's partition derives from its leaves, or from the digest ``changed`` in place
    of the row's leaf where that is not null, and the proof: it equals ``root`` unless something was changed.
    """
    nothing = F.lit(None).cast("string")
    digests = df.select(
        F.col(group).cast("string").alias("grp"), F.col(key).alias("ord"), F.unhex(leaf).alias("leaf"), F.unhex(nothing if changed is None else changed).alias("changed")
    )
    placed = _place_leaves(shared_table(digests, "merkle-digests"), leaves_per_part)
    nodes = _tree_nodes(placed, fan)
    # The groups' roots are the leaves of one more tree, in the order of the groups.
    subroots = nodes.where("width = 1").select(nothing.alias("grp"), F.col("grp").alias("ord"), F.unhex("digest").alias("leaf"), F.unhex(nothing).alias("changed"))
    over = _place_leaves(shared_table(subroots, "merkle-subroots"), leaves_per_part)
    upper = _tree_nodes(over, fan)
    above = shared_table(_expanded(over, upper, fan), "merkle-paths")
    root = upper.where("width = 1").select("digest").first()
    proven = _expanded(placed, nodes, fan, above)
    return proven.select(
        F.col("ord").alias(key), F.col("grp").alias(group), "leaf", "subroot", F.lit(root and root[0]).cast("string").alias("root"), "path", F.col("folded").alias("folded_root")
    )


def proof_text(path: str = "path") -> Column:
    """All siblings of a path, level by level, from left to right."""
    return F.array_join(F.transform(F.col(path), lambda run: F.concat(run.left, run.right)), "")
