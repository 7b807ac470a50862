"""Related documents next to, or inside, the document they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def related_rows(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str,
    keep_childless: bool = True,
) -> DataFrame:
    """Parent columns with one related document per row in the struct ``name``.

    The matches come from an inner join, in which adaptive execution may split
    a hot key on either side; a left join could not split the child side. The
    parents without children are added from an anti join against the distinct
    keys.

    Both joins hash what there is once per parent, the parents and the keys, and
    let the rest pass. No task sorts the children, so that what it holds grows
    with the parents dealt to it and not with the children.
    """
    inlined = children.select(F.col(child_key).alias("__key"), F.struct("*").alias(name))
    matched = parents.hint("shuffle_hash").join(inlined, parents[parent_key] == F.col("__key")).drop("__key")
    if not keep_childless:
        return matched
    keys = children.select(F.col(child_key).alias("__key")).distinct()
    childless = parents.join(keys.hint("shuffle_hash"), parents[parent_key] == F.col("__key"), "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def inline_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str,
) -> DataFrame:
    """Each parent, in one row, with its related documents in the sorted list ``name``.

    Every child is in the list, equal ones too; copies of landed documents are
    for ``one_per_id`` to remove. A list is built in one task: this form is for
    children whose number per parent has a bound, such as the lines of an
    order. Where it has none use ``related_rows``, one row per child.
    """
    columns = [F.col(f"`{c}`") for c in children.columns]
    item = F.struct(*columns)
    lists = children.groupBy(F.col(child_key).alias("__parent")).agg(F.sort_array(F.collect_list(item)).alias("__items"))
    empty = F.array().cast(lists.schema["__items"].dataType)
    joined = parents.join(lists, parents[parent_key] == F.col("__parent"), "left").drop("__parent")
    return joined.withColumn(name, F.coalesce("__items", empty)).drop("__items")
