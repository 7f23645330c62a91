"""What a script refers to, from the plan that Spark's parser makes of it before anything is resolved."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

from stagemart.errors import DependencyCycle


def _elements(seq: JavaObject) -> Iterator[JavaObject]:
    indexed = seq.toIndexedSeq()
    return (indexed.apply(number) for number in range(indexed.size()))


def _kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


@dataclass(frozen=True)
class Call:
    """A function call: where it starts and ends in the script, and its arguments as they are written, by place and by name."""

    start: int
    end: int
    arguments: tuple[str, ...]
    named: Mapping[str, str]


class ParsedScript:
    """A script as parsed; common table expressions hide relations of their name from where they are defined on."""

    def __init__(self, spark: SparkSession, text: str):
        self.text = text
        self._plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        self._with_plan = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression")

    def relations(self) -> set[str]:
        """Names of the relations that the script reads, in lower case."""
        return set(self._relations(self._plan, frozenset()))

    def _relations(self, plan: JavaObject, hidden: frozenset[str]) -> Iterator[str]:
        kind = _kind(plan)
        if kind == "UnresolvedRelation":
            name = plan.multipartIdentifier().mkString(".").lower()
            if name not in hidden:
                yield name
        if kind == "UnresolvedWith":
            for defined in _elements(plan.cteRelations()):
                own = frozenset([defined._1().lower()])
                yield from self._relations(defined._2(), hidden | own if plan.allowRecursion() else hidden)
                hidden |= own
        for expression in _elements(plan.expressions()):
            for inner in self._plans_in(expression):
                yield from self._relations(inner, hidden)
        for child in _elements(plan.children()):
            yield from self._relations(child, hidden)

    def _plans_in(self, expression: JavaObject) -> Iterator[JavaObject]:
        if self._with_plan.isInstance(expression):
            yield expression.plan()
        for child in _elements(expression.children()):
            yield from self._plans_in(child)

    def calls(self, function: str) -> list[Call]:
        """The calls of a function, in the order of the script; a call among the arguments of another follows it."""
        found = {(call.start, -call.end): call for call in self._calls_in_plan(self._plan, function)}
        return [found[place] for place in sorted(found)]

    def _calls_in_plan(self, plan: JavaObject, function: str) -> Iterator[Call]:
        if _kind(plan) == "UnresolvedWith":
            for defined in _elements(plan.cteRelations()):
                yield from self._calls_in_plan(defined._2(), function)
        for expression in _elements(plan.expressions()):
            yield from self._calls_in(expression, function)
        for child in _elements(plan.children()):
            yield from self._calls_in_plan(child, function)

    def _calls_in(self, expression: JavaObject, function: str) -> Iterator[Call]:
        if _kind(expression) == "UnresolvedFunction" and expression.nameParts().mkString(".").lower() == function:
            arguments, named = [], {}
            for argument in _elements(expression.arguments()):
                if _kind(argument) == "NamedArgumentExpression":
                    named[argument.key().lower()] = self._written(argument.value())
                else:
                    arguments.append(self._written(argument))
            yield Call(*self._span(expression), tuple(arguments), named)
        if self._with_plan.isInstance(expression):
            yield from self._calls_in_plan(expression.plan(), function)
        for child in _elements(expression.children()):
            yield from self._calls_in(child, function)

    @staticmethod
    def _span(expression: JavaObject) -> tuple[int, int]:
        origin = expression.origin()
        return origin.startIndex().get(), origin.stopIndex().get() + 1

    def _written(self, expression: JavaObject) -> str:
        start, end = self._span(expression)
        return self.text[start:end]


def dependency_levels(reads: Mapping[str, set[str]]) -> list[list[str]]:
    """The names in levels, each reading only names of earlier ones; in a level, in the order given. Raises ``DependencyCycle``."""
    known = {name.lower(): name for name in reads}
    waiting = {name: {known[read] for read in found if read in known} for name, found in reads.items()}
    levels: list[list[str]] = []
    while waiting:
        ready = [name for name, found in waiting.items() if not found]
        if not ready:
            raise DependencyCycle(f"scripts read each other: {', '.join(sorted(waiting))}")
        levels.append(ready)
        waiting = {name: found - set(ready) for name, found in waiting.items() if name not in ready}
    return levels
