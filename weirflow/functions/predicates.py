"""Boolean combinators and chained comparisons as column expressions, so that filters reach the scan."""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F


def _some(args: tuple) -> tuple:
    if not args:
        raise ValueError("at least one argument is needed")
    return args


def and_(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, _some(predicates))


def or_(*predicates: Column) -> Column:
    return reduce(lambda a, b: a | b, _some(predicates))


def not_(predicate: Column) -> Column:
    return ~predicate


def xor_(*predicates: Column) -> Column:
    """Exactly one of the predicates holds."""
    return reduce(lambda a, b: a + b, [p.cast("int") for p in _some(predicates)]) == 1


def _operand(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _chain(args: tuple, compare) -> Column:
    """Compare each operand with the next. Operands are columns or literals."""
    if len(args) < 2:
        raise ValueError("at least two operands are needed")
    return and_(*[compare(_operand(a), _operand(b)) for a, b in pairwise(args)])


def all_equal(*operands) -> Column:
    return _chain(operands, lambda a, b: a == b)


def increasing(*operands) -> Column:
    return _chain(operands, lambda a, b: a < b)


def decreasing(*operands) -> Column:
    return _chain(operands, lambda a, b: a > b)
