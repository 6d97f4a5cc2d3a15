"""Detection and numbering of categorical slots of a vector or a list of columns.

A slot with at most ``max_categories`` distinct values is categorical.  Slots with far
more are cut early by an approximate distinct count (one aggregate of bounded state);
only values of the remaining slots are then counted exactly, so at most about
``CUT`` times ``max_categories`` values of a slot are ever gathered.  Categories are
numbered in ascending order, but 0 is always number 0, so that sparse slots stay
sparse.  Other slots pass as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpipe.sources.invalid import check_policy, failing

#: Slots whose approximate count exceeds this many times the bound can't be categorical
#: (the estimate's relative error is 5 %).
CUT = 2


@dataclass
class SlotCategories:
    """The categories of each categorical slot: slot number -> values in index order."""

    values: dict[int, list[float]]
    width: int

    def index(self, slot: int, value: Column) -> Column:
        """The category number of a value; null for unseen ones.  Other slots' own value."""
        if slot not in self.values:
            return value
        # Zero and minus zero are one category.
        table = F.create_map(*[F.lit(x) for i, v in enumerate(self.values[slot]) for x in (float(v), float(i))])
        return F.try_element_at(table, value + F.lit(0.0))

    def transform(self, df: DataFrame, vector: str, output: str, invalid: str = "error") -> DataFrame:
        """``output``: the vector with categories numbered.  Unseen values fail under
        ``error``, drop the row under ``skip``, and get the first unused number under ``keep``."""
        check_policy(invalid)
        x = vector_to_array(vector)
        slots = [self.index(i, x[i]) for i in range(self.width)]
        if invalid == "keep":
            slots = [F.coalesce(s, F.lit(float(len(self.values.get(i, ()))))) if i in self.values else s for i, s in enumerate(slots)]
        out = df.withColumn("_slots", F.array(*slots))
        bad = {f"{vector}[{i}]": F.col("_slots")[i].isNull() for i in self.values}
        if invalid == "error":
            out = failing(out, bad)
        elif invalid == "skip":
            for wrong in bad.values():
                out = out.filter(~wrong)
        return out.withColumn(output, array_to_vector("_slots")).drop("_slots")


def find_categories(df: DataFrame, vector: str, width: int, max_categories: int = 20) -> SlotCategories:
    """The categorical slots of a vector column and their values."""
    if max_categories < 2:
        raise ValueError("max_categories must be at least 2")
    x = df.select(vector_to_array(vector).alias("x"))
    slot = lambda i: F.col("x")[i] + F.lit(0.0)
    rough = x.agg(*[F.approx_count_distinct(slot(i), 0.05).alias(f"c{i}") for i in range(width)]).first()
    few = [i for i in range(width) if rough[f"c{i}"] <= CUT * max_categories]
    if not few:
        return SlotCategories({}, width)
    pairs = x.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), slot(i).alias("v")) for i in few])).alias("p"))
    exact = pairs.select("p.i", "p.v").filter("v IS NOT NULL").distinct()
    found: dict[int, list[float]] = {i: [] for i in few}
    for r in exact.collect():  # at most about CUT * max_categories values a slot
        found[r["i"]].append(r["v"])
    return SlotCategories({i: sorted(v, key=lambda a: (a != 0, a)) for i, v in found.items() if len(v) <= max_categories}, width)
