"""Lists of a group's distinct values in a SQL statement, without a set of a whole group.

``array_join(array_sort(collect_set(x)), sep)`` holds a group's values as objects on the heap of one task, and
beside several ``count(DISTINCT ...)`` Spark copies that set many times. ``spread_set_lists`` takes the plan that
Spark analyzed for a statement and computes those lists, from the statement's own relations, groups and
expressions, as ``sorted_distinct_chunks``. All else in it (its other aggregates, what it does with
the lists, its ORDER BY) is Spark's as the statement has it. No job runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import _to_seq

from ..functions.agg import joined_chunks, sorted_distinct_chunks

#: What may stand above the aggregate.
_ABOVE = ("SubqueryAlias", "View", "Project", "Sort")
#: What may give other rows of its input each time it is read, as the counts and the lists do apart.
_CHOICES = ("GlobalLimit", "LocalLimit", "Offset", "Tail", "Sample", "Window")


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


class _Lists:
    """The lists of an aggregate: their values and the separator they share."""

    def __init__(self, spark):
        self.values: list = []
        self.separators: set[str] = set()
        plain = spark.range(1).select(F.array_sort(F.array(F.lit(""))).alias("a"))._jdf.queryExecution().analyzed()
        self._ascending = self._text(plain.projectList().apply(0).child().function())

    @staticmethod
    def _text(function) -> str:
        return re.sub(r"#\d+", "#", function.toString())  # variables by name, not by number

    def number(self, e) -> int | None:
        """The list's number, if the expression is one of plain text (no collation), in ascending order."""
        if not (_kind(e) == "ArrayJoin" and e.nullReplacement().isEmpty() and _kind(e.delimiter()) == "Literal"
                and e.delimiter().value() is not None and _kind(e.array()) == "ArraySort"):
            return None
        made = e.array().argument()
        if self._text(e.array().function()) != self._ascending or _kind(made) != "AggregateExpression":
            return None
        x = made.aggregateFunction()
        if _kind(x) != "CollectSet" or made.isDistinct() or made.filter().isDefined():
            return None
        if x.child().dataType().catalogString() != "string":
            return None
        self.separators.add(e.delimiter().value().toString())
        return _place(self.values, x.child())


def _place(found: list, e) -> int:
    """The number of the expression among those found; a new one is added."""
    for i, x in enumerate(found):
        if x.semanticEquals(e):
            return i
    found.append(e)
    return len(found) - 1


def _rebuilt(sc, e, swap: Callable):
    """The expression with what ``swap`` gives in place of the outermost parts that it gives anything for."""
    new = swap(e)
    if new is not None:
        return new
    old = _items(e.children())
    kids = [_rebuilt(sc, k, swap) for k in old]
    return e if all(a is b for a, b in zip(kids, old, strict=True)) else e.withNewChildren(_to_seq(sc, kids))


def _settled(plan) -> bool:
    """Whether every reading of the relation gives the same rows."""
    return plan.deterministic() and _kind(plan) not in _CHOICES and all(map(_settled, _items(plan.children())))


def spread_set_lists(df: DataFrame) -> DataFrame | None:
    """``df`` with its lists of distinct values put together from chunks; None where it has none of this form.

    The form: an aggregate with lists as above, of strings and with one separator, below projections and at
    most an order. The same rows for any input: a group without a value has the empty text, as from ``array_join``.
    """
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    sql = spark._jvm.org.apache.spark.sql
    plan = sql.catalyst.optimizer.InlineCTE(True, False).apply(df._jdf.queryExecution().analyzed())
    above = []
    while _kind(plan) in _ABOVE:
        above.append(plan)
        plan = plan.child()
    if _kind(plan) != "Aggregate" or not _settled(plan.child()):
        return None
    if any(_kind(n) == "Sort" and not getattr(n, "global")() for n in above):
        return None
    groups, outputs = _items(plan.groupingExpressions()), _items(plan.aggregateExpressions())
    lists, others = _Lists(spark), []

    def find(e):
        """Every list and every other aggregate is numbered; none is looked into."""
        if lists.number(e) is not None:
            return e
        if _kind(e) == "AggregateExpression":
            _place(others, e)
            return e
        return None

    for e in outputs:
        _rebuilt(sc, e, find)
    if not groups or not lists.values or len(lists.separators) != 1:
        return None

    def col(e) -> Column:
        return Column(sql.classic.ExpressionUtils.column(e))

    def frame(logical) -> DataFrame:
        return DataFrame(sql.classic.Dataset.ofRows(spark._jsparkSession, logical), spark)

    def attributes(of: DataFrame) -> list:
        return _items(of._jdf.queryExecution().analyzed().output())

    # The other aggregates as they are, with a row for every group; the lists' chunks; a group's row from both.
    (sep,), keys = lists.separators, [f"g{i}" for i in range(len(groups))]
    values, rows = [f"a{i}" for i in range(len(others))], frame(plan.child())
    one = rows.groupBy(*map(col, groups)).agg(F.lit(None).cast("int").alias("kind"), *(col(e).alias(n) for e, n in zip(others, values, strict=True)))
    one = one.toDF(*keys, "kind", *values)
    pairs = rows.select(*(col(g).alias(k) for g, k in zip(groups, keys, strict=True)), F.inline(F.array(*(
        F.struct(F.lit(i).alias("kind"), col(x).alias("value")) for i, x in enumerate(lists.values)))))
    chunks = sorted_distinct_chunks(pairs, [*keys, "kind"], "value", sep).select(*keys, "kind", "chunk", "text")
    both = one.unionByName(chunks, allowMissingColumns=True).groupBy(*keys).agg(
        *(F.first(n, ignorenulls=True).alias(n) for n in values),
        *(joined_chunks(F.col("kind") == i, sep, empty=False).alias(f"l{i}") for i in range(len(lists.values))))

    at = dict(zip(both.columns, attributes(both), strict=True))
    empty = sql.catalyst.expressions.Literal.create("", sql.types.DataTypes.StringType)

    def put(e):
        """The expression's value in ``both``."""
        if _kind(e) == "NullIf" and e.right().semanticEquals(empty) and (i := lists.number(e.left())) is not None:
            return at[f"l{i}"]
        if (i := lists.number(e)) is not None:
            return sql.catalyst.expressions.Coalesce(_to_seq(sc, [at[f"l{i}"], empty]))
        if _kind(e) == "AggregateExpression":
            return at[f"a{_place(others, e)}"]
        return next((at[k] for g, k in zip(groups, keys, strict=True) if g.semanticEquals(e)), None)

    out = both.select(*(col(_rebuilt(sc, e, put)).alias(e.name()) for e in outputs))
    now = {e.exprId().toString(): a for e, a in zip(outputs, attributes(out), strict=True)}

    def renewed(e) -> Column:
        return col(_rebuilt(sc, e, lambda x: now.get(x.exprId().toString()) if _kind(x) == "AttributeReference" else None))

    for node in reversed(above):
        if _kind(node) == "Project":
            out = out.select(*(renewed(e).alias(e.name()) for e in _items(node.projectList())))
            now |= {e.exprId().toString(): a for e, a in zip(_items(node.projectList()), attributes(out), strict=True)}
        elif _kind(node) == "Sort":
            order = [renewed(e) for e in _items(node.order())]
            out = out.repartitionByRange(_sort_partitions(spark), *order).sort(*order)
    return out


def _sort_partitions(spark) -> int:
    """As the session has them, and so few that Spark writes a row to its partition's file without a copy of it on the heap."""
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), most))
