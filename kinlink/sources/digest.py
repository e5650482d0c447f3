"""Keys that tell the inputs of a stage apart: what a table's rows depend on, and the values of settings.

A table is known by its plan and its files. The plan is walked node by node and expression by expression, whole, whatever
its width; numbers that Spark gives to columns as they come are replaced by their order of appearance, so the same
selection has the same digest in every application. Functions in Python count with their code. What no plan shows, rows
given by hand, JDBC tables, functions of the JVM and variables that were broadcast to a function, needs a ``version``.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Callable, Iterator

from py4j.java_gateway import is_instance_of
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PYTHON = ("PythonUDF", "PythonUDAF", "PythonUDTF")
#: Parts of class names whose function cannot be read from a plan.
_OPAQUE = ("ScalaUDF", "ScalaUDAF", "ScalaAggregator", "HiveSimpleUDF", "HiveGenericUDF", "HiveUDAF", "ApplyFunctionExpression")
_SUBQUERIES = ("ListQuery", "ScalarSubquery", "Exists", "LateralSubquery", "FunctionTableSubqueryArgumentExpression")
#: What differs between applications, and names that only served to find columns.
_VARYING = ("jvmId", "__dataset_id", "__col_position", "qualifier")
_FRESH_NAMES = {"NamedLambdaVariable": "name", "SubqueryAlias": "identifier", "View": "desc"}


def _sha(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def _renumbered(tree, numbers: dict[int, int]):
    """A plan's JSON with column numbers by first appearance and without names that are made up for each run."""
    if isinstance(tree, list):
        return [_renumbered(x, numbers) for x in tree]
    if not isinstance(tree, dict):
        return tree
    if tree.get("product-class", "").endswith(".ExprId"):
        return numbers.setdefault(tree["id"], len(numbers))
    dropped = (*_VARYING, _FRESH_NAMES.get(tree.get("class", "").rpartition(".")[2]))
    return {k: _renumbered(v, numbers) for k, v in tree.items() if k not in dropped}


def _classes(tree) -> Iterator[str]:
    if isinstance(tree, list):
        for x in tree:
            yield from _classes(x)
    elif isinstance(tree, dict):
        yield from (tree[k].rpartition(".")[2] for k in ("class",) if k in tree)
        for x in tree.values():
            yield from _classes(x)


def _sequence(scala) -> list:
    return [scala.apply(i) for i in range(scala.size())]


def _inside(spark: SparkSession, plan) -> Iterator[tuple[str, object]]:
    """Every node and expression with the name of its class, those of subqueries among them, in order."""
    expression = "org.apache.spark.sql.catalyst.expressions.Expression"
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        yield name, node
        waiting += _sequence(node.children())[::-1]
        if name in _SUBQUERIES:
            waiting.append(node.plan())
        if not is_instance_of(spark.sparkContext._gateway, node, expression):
            waiting += _sequence(node.expressions())[::-1]


def _code(spark: SparkSession, function, version: str | None) -> str:
    """Digest of a Python function of a plan."""
    if function.broadcastVars().size() and version is None:
        raise ValueError("a function that reads broadcast variables needs a version")
    tag = getattr(spark._jvm.scala.reflect, "ClassTag$").__getattr__("MODULE$").Byte()
    return hashlib.sha256(bytes(function.command().toArray(tag))).hexdigest()


def _files(spark: SparkSession, roots: list[str]) -> list:
    """Number and digest of the files below ``roots``, their names, sizes and times. Listed and folded by Spark, so that no
    file's entry comes to the driver's Python."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    named = ("path", "length", "modificationTime")
    folds = [F.bit_xor(F.xxhash64(*names)) for names in (named, named[::-1])]
    return [*listed.select(*named).agg(F.count("*"), *folds).first()]


def _leaf_state(spark: SparkSession, leaf, version: str | None) -> list:
    relation = leaf.relation() if leaf.nodeName().startswith("LogicalRelation") else None
    if relation is None or "HadoopFsRelation" not in relation.getClass().getName():
        if version is None:
            raise ValueError("a table that does not come from files needs a version")
        return []
    roots = sorted(r.toString() for r in _sequence(relation.location().rootPaths()))
    options = relation.options()
    names = sorted(_sequence(options.keys().toSeq()))
    read_as = [relation.fileFormat().getClass().getName(), relation.dataSchema().json(), [[n, options.apply(n)] for n in names]]
    return [roots, read_as, _files(spark, roots)]


def table_state(df: DataFrame, version: str | None = None) -> list:
    """What a table's rows depend on: its plan, the code of its functions and its files."""
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    tree = json.loads(plan.toJSON())
    kinds = set(_classes(tree))
    if version is None and any(part in kind for kind in kinds for part in _OPAQUE):
        raise ValueError("a function of the JVM cannot be told from another one of its name: the table needs a version")
    functions, leaves = [], _sequence(plan.collectLeaves())
    if kinds & {*_PYTHON, *_SUBQUERIES}:
        for name, node in _inside(spark, plan):
            if name in _PYTHON:
                functions.append(_code(spark, node.func(), version))
            if name in _SUBQUERIES:
                leaves += _sequence(node.plan().collectLeaves())
    return [_renumbered(tree, {}), df.schema.json(), functions, [_leaf_state(spark, leaf, version) for leaf in leaves]]


def value_state(value):
    """Settings as JSON: data classes and collections part by part, functions by their code, anything else by ``repr``."""
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return [type(value).__name__, {f.name: value_state(getattr(value, f.name)) for f in dataclasses.fields(value)}]
    if isinstance(value, dict):
        return [[value_state(k), value_state(v)] for k, v in value.items()]
    if isinstance(value, (list, tuple)):
        return [value_state(x) for x in value]
    if isinstance(value, Callable) and not isinstance(value, type):
        return hashlib.sha256(cloudpickle.dumps(value)).hexdigest()
    return value if isinstance(value, (str, int, float, bool, type(None))) else repr(value)


def fingerprint(*inputs, version: str | None = None) -> str:
    """Key of a stage: its input tables as ``table_state`` has them, and the values of its settings.

    Two selections from one table differ, however wide, and so does a file that was rewritten under its name. Tables that do
    not come from files cannot be seen to change; ``version`` must then name their state.
    """
    parts = [table_state(x, version) if isinstance(x, DataFrame) else value_state(x) for x in inputs]
    return _sha([version, parts])[:32]
