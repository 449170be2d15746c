"""Change propagation: bring a joined fact up to date from what changed.

A fact is declared as a join graph: a root input, whose rows the fact's rows
come from, and lookups hanging on it (and on each other). Given the rows that
changed in *each* input since the fact was built, the keys of the fact rows
they can reach are found by walking the graph from every input to the root:

* ``touched`` maps changed rows of an input, and changed rows of what hangs
  on it, to the columns its parent joins on, in one scan of the input;
* ``affected_keys`` does so for the root: keys of inserted, changed and
  deleted root rows, and of root rows that any changed lookup row reaches;
* ``restrict`` cuts every input to the rows that those keys need, so the
  fact's own plan runs over them alone;
* ``replace_keys`` puts the result in place of the affected keys: a key that
  gives no row any more is thereby deleted.

Changed rows are given as images before and after (``changed_rows`` finds
them where a source has no change feed): a row whose join column moved must
be found under its old and under its new value. Sets of keys are staged, so
the planner knows their size and broadcasts them only while they are small;
the inputs are then scanned (and pruned to the columns needed) but never
shuffled. Beyond that size the semi joins are sort-merge joins, whose hot
partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import stage


@dataclass(frozen=True)
class Link:
    """A lookup: the child input, and pairs (column here, column there)."""

    child: str
    on: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class JoinGraph:
    """The joins of a fact. ``keys`` name root columns and, under the same
    position in ``fact_keys``, the fact's columns that hold them."""

    root: str
    keys: tuple[str, ...]
    fact_keys: tuple[str, ...]
    links: Mapping[str, tuple[Link, ...]] = field(default_factory=dict)

    def children(self, name: str) -> tuple[Link, ...]:
        return tuple(self.links.get(name, ()))


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Both images of the rows that differ, for a source without a change
    feed: rows with another number of copies, by an aggregate over both."""
    columns = after.columns
    both = (before.select(*columns).withColumn("__n", F.lit(-1))
            .unionByName(after.withColumn("__n", F.lit(1))))
    return both.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0").select(*columns)


def _same(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def touched(graph: JoinGraph, tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame],
            name: str, columns: list[str], label: str = "fact") -> DataFrame | None:
    """Distinct ``columns`` of the rows of input ``name`` that changed or that
    join a changed row below; ``None`` if nothing there changed."""
    own = changes.get(name)
    out = own.select(*columns) if own is not None else None
    rows, hits = tables[name], []
    for i, link in enumerate(graph.children(name)):
        below = touched(graph, tables, changes, link.child, [there for _, there in link.on], label)
        if below is None:
            continue
        below = stage(below, f"{label}__touched/{name}-{link.child}")
        named = below.toDF(*[f"__{i}_{there}" for _, there in link.on]).withColumn(f"__hit{i}", F.lit(True))
        # an ordinary equality: a NULL joins nothing, so nothing below reaches it
        cond = F.lit(True)
        for here, there in link.on:
            cond = cond & (rows[here] == named[f"__{i}_{there}"])
        rows = rows.join(named, cond, "left")
        hits.append(F.col(f"__hit{i}"))
    if hits:
        reached = rows.where(F.coalesce(*hits)).select(*columns)
        out = reached if out is None else out.unionByName(reached)
    return None if out is None else out.distinct()


def affected_keys(graph: JoinGraph, tables: Mapping[str, DataFrame],
                  changes: Mapping[str, DataFrame], label: str = "fact") -> DataFrame | None:
    """Keys of the root whose fact rows may differ, staged; ``None`` if no
    input changed. ``tables`` are the inputs as they are now."""
    keys = touched(graph, tables, changes, graph.root, list(graph.keys), label)
    return None if keys is None else stage(keys, f"{label}__affected")


def restrict(graph: JoinGraph, tables: Mapping[str, DataFrame], affected: DataFrame,
             label: str = "fact") -> dict[str, DataFrame]:
    """The inputs cut to the rows that the fact rows of ``affected`` need."""
    out: dict[str, DataFrame] = {}

    def cut(name: str, rows: DataFrame) -> None:
        links = graph.children(name)
        if links:  # read by each lookup below and by the fact
            rows = stage(rows, f"{label}__restricted/{name}")
        out[name] = rows
        for link in links:
            wanted = rows.select(*[F.col(here).alias(f"__{there}") for here, there in link.on]).distinct()
            child = tables[link.child]
            cond = F.lit(True)
            for _, there in link.on:
                cond = cond & (child[there] == wanted[f"__{there}"])
            cut(link.child, child.join(wanted, cond, "left_semi"))

    root, keys = tables[graph.root], affected.toDF(*[f"__{k}" for k in graph.keys])
    cut(graph.root, root.join(keys, _same([root[k] for k in graph.keys],
                                          [keys[f"__{k}"] for k in graph.keys]), "left_semi"))
    return out


def replace_keys(fact: DataFrame, rows: DataFrame, affected: DataFrame, graph: JoinGraph) -> DataFrame:
    """``fact`` with ``rows`` in place of all its rows of the affected keys."""
    keys = affected.toDF(*[f"__{k}" for k in graph.fact_keys])
    kept = fact.join(keys, _same([fact[k] for k in graph.fact_keys],
                                 [keys[f"__{k}"] for k in graph.fact_keys]), "left_anti")
    return kept.unionByName(rows.select(*fact.columns))


@dataclass(frozen=True)
class Propagated:
    """The fact after the changes; the rows that were recomputed and the keys
    they stand for (staged, under the fact's names)."""

    fact: DataFrame
    rows: DataFrame
    keys: DataFrame

    def deletes(self, before: DataFrame) -> bool:
        """Does a key of the fact before have no row any more?"""
        names = self.keys.columns
        gone = self.keys.alias("k").join(
            self.rows.select(*names).distinct().alias("r"),
            _same([F.col(f"k.{n}") for n in names], [F.col(f"r.{n}") for n in names]), "left_anti")
        return not before.select(*names).alias("f").join(
            gone.alias("g"), _same([F.col(f"f.{n}") for n in names], [F.col(f"g.{n}") for n in names]),
            "left_semi").isEmpty()


def propagate(fact: DataFrame, build: Callable[[Mapping[str, DataFrame]], DataFrame], graph: JoinGraph,
              tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame],
              label: str = "fact") -> Propagated | None:
    """Bring ``fact`` up to date; ``None`` if no input changed.

    ``build`` is the fact's own plan over the inputs by name, ``tables`` are
    the inputs as they are now, ``changes`` the changed rows of each (an input
    that did not change is left out). Rows of one key are replaced together,
    so keys may repeat; NULL is a key like any other. ``label`` names the staged
    sets: one per fact, as the next run under it overwrites them."""
    affected = affected_keys(graph, tables, changes, label)
    if affected is None:
        return None
    rows = stage(build(restrict(graph, tables, affected, label)), f"{label}__recomputed")
    return Propagated(replace_keys(fact, rows, affected, graph), rows, affected.toDF(*graph.fact_keys))
