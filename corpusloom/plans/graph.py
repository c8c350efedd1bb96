"""Workflows as declared graphs of nodes and edges, checked before they run and taken up where they stopped.

A node is a function from a state to what it changes of it; a state is a dict of tables
(DataFrames) and small values. An edge leads to one node, or its condition says to which of
those declared. After each node its tables are written below a folder, and then, as one
small file that appears whole, what the state consists of and which node is next: a run that
is started again with the same folder reads the last such file and goes on there. Tables that
a node leaves alone are not written again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.sink import place

State = dict
END = "end"
#: A condition and the nodes it may lead to, by name.
Choice = tuple[Callable[[State], str], tuple[str, ...]]


class GraphError(ValueError):
    """A graph that can't run, with all that is wrong with it."""


@dataclass(frozen=True)
class Graph:
    entry: str
    nodes: dict[str, Callable[[State], State]]
    edges: dict[str, str | Choice]

    def targets(self, node: str) -> tuple[str, ...]:
        edge = self.edges.get(node, ())
        return (edge,) if isinstance(edge, str) else edge[1] if edge else ()

    def problems(self) -> list[str]:
        """What is wrong with the graph: none of it depends on what its nodes do."""
        known, found = {*self.nodes, END}, []
        found += [f"entry {self.entry!r} is no node"] if self.entry not in self.nodes else []
        found += [f"edge from {n!r}, which is no node" for n in self.edges if n not in self.nodes]
        found += [f"{n!r} leads to nothing" for n in self.nodes if not self.targets(n)]
        found += [f"{n!r} leads to {t!r}, which is no node" for n in self.nodes for t in self.targets(n) if t not in known]
        found += [f"a node is called {END!r}"] if END in self.nodes else []

        def reached(start: set[str], step: Callable[[str], set[str]]) -> set[str]:
            todo, seen = list(start), set(start)
            while todo:
                todo += (new := step(todo.pop()) - seen)
                seen |= new
            return seen

        below = reached({self.entry}, lambda n: set(self.targets(n)) if n in self.nodes else set())
        above = reached({END}, lambda t: {n for n in self.nodes if t in self.targets(n)})
        found += [f"{n!r} is never reached" for n in self.nodes if n not in below]
        found += [f"{n!r} never ends" for n in self.nodes if n in below and n not in above]
        return found

    def run(self, spark: SparkSession, state: State, folder: str | None = None, limit: int = 100) -> State:
        """The state at the end. folder: of the files by which a stopped run goes on; limit: of visits to nodes."""
        if found := self.problems():
            raise GraphError("; ".join(found))
        node, visit, places = self.entry, 0, {}
        if folder:
            node, visit, state, places = _taken_up(spark, folder, self, state)
        while node != END:
            if visit >= limit:
                raise GraphError(f"{limit} nodes were visited and {node!r} is next")
            state = state | self.nodes[node](state)
            edge = self.edges[node]
            following = edge if isinstance(edge, str) else edge[0](state)
            if following not in self.targets(node):
                raise GraphError(f"the condition after {node!r} leads to {following!r}, which isn't declared")
            visit += 1
            if folder:
                state, places = _kept(spark, folder, f"{visit:04d}-{node}", state, places, visit, following)
            node = following
        return state

    def mermaid(self) -> str:
        """The graph as Mermaid text."""
        lines = [f"    {n} -->{'' if isinstance(self.edges[n], str) else '|if|'} {t}" for n in self.nodes for t in self.targets(n)]
        return "\n".join(["graph TD", f"    start --> {self.entry}", *lines])


def _kept(spark: SparkSession, folder: str, name: str, state: State, places: dict, visit: int, following: str) -> tuple[State, dict]:
    """Writes the tables that are new, then the state; gives the state with tables as they were written."""
    out, now = dict(state), {}
    for key, x in state.items():
        if isinstance(x, DataFrame):
            if key in places and places[key][2] is x:
                now[key] = places[key]
                continue
            path = f"{folder.rstrip('/')}/{name}/{key}"
            x.write.mode("overwrite").parquet(path)  # what a stopped run left of it goes
            out[key] = spark.read.schema(x.schema).parquet(path)
            now[key] = (path, x.schema.jsonValue(), out[key])
    values = {k: v for k, v in state.items() if not isinstance(v, DataFrame)}
    files, where = place(folder)
    files.create_dir(where)
    with files.open_output_stream(f"{where}/.{name}.json") as f:
        f.write(json.dumps({"visit": visit, "next": following, "values": values, "tables": {k: [p[0], p[1]] for k, p in now.items()}}, ensure_ascii=False).encode())
    files.move(f"{where}/.{name}.json", f"{where}/{name}.json")
    return out, now


def _taken_up(spark: SparkSession, folder: str, graph: Graph, state: State) -> tuple[str, int, State, dict]:
    """Next node, visits, state and written tables of the last node that finished; the beginning if none has."""
    from pyarrow import fs

    files, where = place(folder)
    done = sorted(f.base_name for f in files.get_file_info(fs.FileSelector(where, allow_not_found=True)) if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    if not done:
        return graph.entry, 0, state, {}
    with files.open_input_stream(f"{where}/{done[-1]}") as f:
        said = json.loads(f.read())
    if said["next"] not in {*graph.nodes, END}:
        raise GraphError(f"{folder} goes on with {said['next']!r}, which is no node of this graph")
    tables = {k: (path, schema, spark.read.schema(StructType.fromJson(schema)).parquet(path)) for k, (path, schema) in said["tables"].items()}
    return said["next"], said["visit"], state | said["values"] | {k: t[2] for k, t in tables.items()}, tables
