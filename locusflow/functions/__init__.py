"""Column functions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_query_suffix(c: Column | str) -> Column:
    """``x___12`` becomes ``x``; other endings stay."""
    return F.regexp_replace(_col(c), r"___[0-9]+$", "")


def strip_genome_prefix(c: Column | str) -> Column:
    """``genome___protein`` becomes ``protein``."""
    return F.regexp_replace(_col(c), r"^.*?___", "")


def strip_group_prefix(c: Column | str) -> Column:
    """``grp0_X`` becomes ``X``; only the prefixes grp0_ to grp3_ go."""
    return F.regexp_replace(_col(c), r"^grp[0-3]_", "")


def intervals_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Closed intervals overlap; touching counts."""
    return (s1 <= e2) & (s2 <= e1)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two arrays as sets; two empty sets have 0."""
    a, b = _col(a), _col(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def canonical(pattern: Column | str) -> Column:
    """The smaller of a list and its reverse."""
    pattern = _col(pattern)
    return F.least(pattern, F.reverse(pattern))


def comment_set(c: Column | str) -> Column:
    """Tokens of a comma-separated text, trimmed, each once, sorted, joined by commas."""
    tokens = F.filter(F.transform(F.split(_col(c), ","), lambda t: F.trim(t)), lambda t: t != "")
    return F.array_join(F.array_sort(F.array_distinct(tokens)), ",")


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation coefficient, 0 where a margin is empty."""
    tp, fp, fn, tn = (x.cast("double") for x in (tp, fp, fn, tn))
    root = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return F.when(root == 0, F.lit(0.0)).otherwise((tp * tn - fp * fn) / F.when(root == 0, F.lit(1.0)).otherwise(root))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """2 tp / (2 tp + fp + fn), 0 without any."""
    return F.coalesce(F.try_divide((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")), F.lit(0.0))


def balanced_accuracy(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Mean of the true positive and the true negative rate; an undefined rate counts 0."""
    rate = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), (a + b).cast("double")), F.lit(0.0))
    return (rate(tp, fn) + rate(tn, fp)) / 2
