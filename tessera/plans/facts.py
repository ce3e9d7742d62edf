"""Plan evidence (MUT-9): what the physical plan does, as facts a test can assert.

``plan_facts`` reads the physical plan Spark chose (``EXPLAIN``) without running the query;
``scan_metrics`` runs it and reads what each scan took in.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The text of ``df.explain(mode)`` as a string."""
    qe = df._jdf.queryExecution()
    if mode == "formatted":
        execution = df.sparkSession._jvm.org.apache.spark.sql.execution
        return qe.explainString(getattr(getattr(execution, "FormattedMode$"), "MODULE$"))
    return qe.executedPlan().toString()


@dataclass
class PlanFacts:
    text: str
    exchanges: int = 0
    shuffle_exchanges: int = 0
    broadcast_joins: int = 0
    sort_merge_joins: int = 0
    shuffled_hash_joins: int = 0
    window_group_limits: int = 0
    codegen_stages: int = 0
    python_evals: int = 0
    partition_filters: list[str] = field(default_factory=list)
    pushed_filters: list[str] = field(default_factory=list)
    read_schemas: list[str] = field(default_factory=list)

    @property
    def no_shuffle(self) -> bool:
        return self.shuffle_exchanges == 0


def plan_facts(df: DataFrame) -> PlanFacts:
    text = physical_plan(df, "simple")
    f = PlanFacts(text=text)
    f.exchanges = len(re.findall(r"\bExchange\b", text))
    f.shuffle_exchanges = len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition|roundrobin)", text))
    f.broadcast_joins = len(re.findall(r"BroadcastHashJoin|BroadcastNestedLoopJoin", text))
    f.sort_merge_joins = text.count("SortMergeJoin")
    f.shuffled_hash_joins = text.count("ShuffledHashJoin")
    f.window_group_limits = text.count("WindowGroupLimit")
    f.codegen_stages = len(re.findall(r"\*\(\d+\)", text))
    f.python_evals = len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", text))
    f.partition_filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    f.pushed_filters = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    f.read_schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    return f


def join_order(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given column names by how early the optimized plan joins the relation that has them:
    those under most joins first, then as the plan lists them."""
    found, todo = [], [(df._jdf.queryExecution().optimizedPlan(), 0)]
    while todo:
        node, joins = todo.pop()
        children = node.children()
        joins += children.size() > 1
        todo.extend((children.apply(i), joins) for i in reversed(range(children.size())))
        if children.isEmpty():
            columns = set(re.findall(r"(\w+)#", node.output().mkString(" ")))
            found += [(-joins, n) for n in names if n in columns]
    return [n for _, n in sorted(found, key=lambda f: f[0])]


def scan_metrics(df: DataFrame) -> list[dict]:
    """Runs the plan once; for every scan of files its relation, files, partitions and rows."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    found, todo = [], [qe.executedPlan()]
    while todo:
        node = todo.pop(0)
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
        if name.startswith("Scan "):
            metrics = node.metrics()
            found.append({"scan": name.split()[-1]} | {
                k: metrics.get(k).get().value() for k in ("numFiles", "numPartitions", "numOutputRows")
                if metrics.contains(k)})
    return found
