"""What depends on what, from the audit log: which tables an input reached, and what a table was made of.

Every run notes what each table it wrote was made of. These notes are edges between (path, version) pairs; files and
streams have no version. Questions about indirect ties are answered by joining edges to what was reached so far, step
by step, until a step reaches nothing new. Each step is one join that only the newest pairs take part in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.runtime import durable


def edges(runs: DataFrame) -> DataFrame:
    """(target, target_version, source, source_version) that the runs of an audit log noted, each once."""
    return runs.select(F.explode("lineage").alias("e")).select("e.*").distinct()


def reached(edges: DataFrame, starts: DataFrame, upstream: bool = False, versions: bool = True) -> DataFrame:
    """(start, start_version, path, version, steps): all that was made of each start, directly or not.

    ``starts`` has a ``path`` and, with ``versions``, a ``version``. ``upstream`` turns the question round: what each
    start was made of. Without ``versions`` a table is one thing whatever its version, and versions are null. ``steps``
    is the least number of writes in between; a start that nothing follows from has no row, cycles end.
    """

    def node(path: str, version: str) -> Column:
        number = F.col(version).cast("long") if versions else F.lit(None).cast("long")
        # a file's missing version must meet itself in a join
        return F.struct(F.col(path).alias("path"), F.coalesce(number, F.lit(-1).cast("long")).alias("version"))

    near, far = ("target", "source") if upstream else ("source", "target")
    step = durable(edges.select(node(near, f"{near}_version").alias("at"), node(far, f"{far}_version").alias("next")).distinct())
    first = starts.select(node("path", "version").alias("start")).distinct()
    frontier = durable(first.select("start", F.col("start").alias("at"), F.lit(0).alias("steps")))
    seen = frontier
    while True:
        ahead = frontier.join(step, "at").select("start", F.col("next").alias("at"), (F.col("steps") + 1).alias("steps")).distinct()
        frontier = durable(ahead.join(seen.select("start", "at"), ["start", "at"], "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)

    def version(c: str) -> Column:
        return F.when(F.col(c)["version"] >= 0, F.col(c)["version"])

    return seen.filter("steps > 0").select(
        F.col("start.path").alias("start"), version("start").alias("start_version"),
        F.col("at.path").alias("path"), version("at").alias("version"), "steps",
    )
