"""Parent-child rows to full hierarchies by pointer doubling.

Every node that isn't a root starts with a pointer to its parent and distance 1. In a round each pointer is replaced by
the pointer of the node it points to, so the distance covered doubles; a pointer to a node without an entry of its own
is at a root. After ``log2(depth)`` rounds every node of a tree has its root. Depths between two powers of two always
occur on the way to a deeper node, so a round that brings no node to its root leaves only circles and what hangs below
them.

Each round is one shuffle join over what is unresolved, written to the shared folder, and the looked-up side shrinks to
the nodes that the previous round pointed to. A node with a third of all rows below it is a hot key only on the probing
side; ``look_up`` keeps its rows where they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.slang import quoted
from .durable import Scratch
from .redelivery import identifier, keep_first


@dataclass
class Spec:
    """``top``: columns of the root to carry down. ``peak``: columns of which the maximum along the path counts.
    ``keep``: columns of the node itself, so that they needn't be joined again.
    ``path``: collect the ids from the root to the node."""

    top: list[str] = field(default_factory=list)
    peak: list[str] = field(default_factory=list)
    keep: list[str] = field(default_factory=list)
    path: bool = False


def _greatest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)  # ignores NULL


#: A pointer is hot if it has more than one in ``HOT`` of the rows, so there are fewer than ``HOT`` of them. Looked for from
#: ``HOT_FROM`` rows on: below, one task can hold any share of them.
HOT, HOT_FROM = 64, 1_000_000


def look_up(probe: DataFrame, table: DataFrame, key: str, at: str, n: int, how: str) -> DataFrame:
    """``probe`` (about ``n`` rows) with the row of ``table`` whose unique ``at`` equals ``key``.

    Rows of hot keys never meet in one task: the fewer than ``HOT`` rows of ``table`` that they look up are broadcast, the
    rest is a shuffle join."""

    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, key, how) if key == at else left.join(right, left[key] == right[at], how)

    if n < HOT_FROM:
        return join(probe, table)
    hot = [r[0] for r in probe.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > n // HOT).select(key).collect()]
    if not hot:
        return join(probe, table)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return join(probe.where(~is_hot), table).unionByName(join(probe.where(is_hot), F.broadcast(table.where(F.col(at).isin(hot)))))


def _repeats(path: str) -> Column:
    """Whether a path has come round to its first node: it leads into a circle and needn't grow on."""
    return F.array_contains(F.slice(path, F.lit(2), F.greatest(F.size(path) - 1, F.lit(0))), F.element_at(path, 1))


def resolve(nodes: DataFrame, spec: Spec | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``nodes``: unique ``id``, ``parent`` (NULL: none), and the columns named in ``spec``.

    Returns ``id, root, depth`` for every node whose parent is a node too; on or below a circle ``root`` is NULL and
    ``depth`` -1. With ``spec.top``: ``top_<c>`` of the root. With ``spec.peak``: ``peak_<c>``, the maximum from the root
    to the node itself, NULLs ignored (NULL on circles). With ``spec.path``: ``path`` from root to node (NULL on circles).
    A node that is its own parent is a circle. A parent that isn't a node makes its child a root. Empty in, empty out.
    """
    spec = spec or Spec()
    scratch = scratch or Scratch(nodes.sparkSession, "hierarchy")
    tops, peaks = [f"top_{c}" for c in spec.top], [f"peak_{c}" for c in spec.peak]
    carried = ["ptr", "dist", *tops, *peaks, *(["path"] if spec.path else [])]

    child = nodes.where("parent IS NOT NULL").select("id", F.col("parent").alias("ptr"), *[F.col(c).alias(f"own_{c}") for c in spec.peak], *spec.keep)
    above = nodes.select(F.col("id").alias("ptr"), *[F.col(c).alias(f"top_{c}") for c in spec.top], *[F.col(c).alias(f"above_{c}") for c in spec.peak])
    links = look_up(child, above, "ptr", "ptr", nodes.count(), "inner").select(
        "id", "ptr", F.lit(1).alias("dist"), *spec.keep, *tops,
        *[_greatest(F.col(f"own_{c}"), F.col(f"above_{c}")).alias(f"peak_{c}") for c in spec.peak],
        *([F.array("ptr").alias("path")] if spec.path else []),
    )
    open_, open_path = scratch.put(links)
    look, look_path = open_, None
    done: list[DataFrame] = []
    n = open_.count()
    while n:
        known = "at_root" in look.columns
        up = look.select(F.col("id").alias("at"), *[F.col(c).alias(f"up_{c}") for c in carried], *(["at_root"] if "at_root" in look.columns else []))
        j = look_up(open_, up, "ptr", "at", n, "left")
        hit = F.col("at").isNotNull()
        moved = j.select(
            "id",
            F.when(hit, F.col("up_ptr")).otherwise(F.col("ptr")).alias("ptr"),
            (F.col("dist") + F.coalesce(F.col("up_dist"), F.lit(0))).alias("dist"),
            *spec.keep,
            *[F.when(hit, F.col(f"up_{c}")).otherwise(F.col(c)).alias(c) for c in tops],
            *[_greatest(F.col(c), F.col(f"up_{c}")).alias(c) for c in peaks],
            *([F.when(hit & ~_repeats("path"), F.concat("up_path", "path")).otherwise(F.col("path")).alias("path")] if spec.path else []),
            (~hit | F.col("at_root") if known else ~hit).alias("at_root"),
        )
        step, step_path = scratch.put(moved)
        still = step.where("NOT at_root")
        left = still.count()
        done.append(step.where("at_root").drop("at_root"))
        if left == n:  # no node reached its root: circles
            done.append(still.select(
                "id", F.lit(None).cast("string").alias("ptr"), F.lit(-1).alias("dist"), *spec.keep,
                *[F.lit(None).cast(still.schema[c].dataType).alias(c) for c in [*tops, *peaks, *(["path"] if spec.path else [])]],
            ))
            break
        if left:
            # What the next round looks up: nodes that unresolved nodes now point to were, before this round, pointed to
            # by nodes that are unresolved now.
            seen = open_.select(F.col("ptr").alias("id")).distinct()
            now = step.join(seen, "id", "left_semi")
            kept = [look.where("at_root").join(seen, "id", "left_semi")] if known else []
            look2, look2_path = scratch.put(now.unionByName(kept[0]) if kept else now)
            if look_path:
                scratch.drop(look_path)
            look, look_path = look2, look2_path
        if open_path:
            scratch.drop(open_path)
        open_, open_path, n = still.drop("at_root"), None, left
    if look_path:
        scratch.drop(look_path)
    out = done[0] if done else open_.limit(0)
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("id", F.col("ptr").alias("root"), F.col("dist").alias("depth"), *spec.keep, *tops, *peaks, *([F.expr("concat(path, array(id))").alias("path")] if spec.path else []))


def nodes_of(df: DataFrame, key: str, parent: str, time: str, tie: str, columns: list[str] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Kept copies as ``id, parent`` and ``columns``, written once since the hierarchy reads them on both sides of a join."""
    kept = keep_first(df, key, time, tie, [parent, *(columns or [])])
    own = kept.select(F.col(quoted(key)).alias("id"), identifier(quoted(parent)).alias("parent"), *[quoted(c) for c in columns or []])
    return (scratch or Scratch(df.sparkSession, "hierarchy")).put(own)[0]


def hierarchy(nodes: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``id, root, depth, path`` of every node, roots included (depth 0, path of themselves); circles as in ``resolve``."""
    found = resolve(nodes, Spec(path=True), scratch)
    roots = nodes.join(found.select("id"), "id", "left_anti").select("id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.array("id").alias("path"))
    return found.unionByName(roots)


def descendants(nodes: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``id, below, distance``: every node with each node under it. Nodes on or below circles have no rows. The result
    holds one row per node and ancestor, as it must; no group is collected."""
    found = resolve(nodes, Spec(path=True), scratch).where("root IS NOT NULL")
    pairs = found.select(F.col("id").alias("below"), "depth", F.posexplode("path").alias("at", "id")).where("at < depth")
    return pairs.select("id", "below", (F.col("depth") - F.col("at")).alias("distance"))
