"""The mixture against its target weights, over many thousand slots."""

import math
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from curastra.llm import mixing


def worst(turns, weights, blocks):
    """The largest distance of a source from its target, in blocks, over all slots until it has run out."""
    total, most = sum(weights.values()), 0
    slots = defaultdict(list)
    for k, i, slot in turns:
        assert i == len(slots[k])
        slots[k].append(slot)
    for k, places in slots.items():
        assert len(places) == blocks[k] and places == sorted(set(places))
        share = Fraction(weights[k]) / total
        for i, t in enumerate(places):  # just before and just after each of its blocks
            most = max(most, share * t - i, i + 1 - share * (t + 1))
    assert len({t for p in slots.values() for t in p}) == sum(blocks.values())
    return most


def test_every_source_stays_within_one_block_of_its_target():
    blocks = {"hot": 60_000, **{f"s{i:02}": 6_300 for i in range(19)}}
    weights = mixing.exact(mixing.tempered(blocks))
    assert worst(mixing.turns(weights, blocks), weights, blocks) < 1


def test_odd_weights_stay_within_one_block_of_their_target():
    blocks = {"a": 900, "b": 5_000, "c": 3, "d": 0, "e": 700}
    weights = mixing.exact({"a": 0.1, "b": 1 / 3, "c": 1e-3, "d": 0.2, "e": math.pi})
    assert worst(mixing.turns(weights, blocks), weights, blocks) < 1
    assert [x[2] for x in mixing.turns({"a": 1}, {"a": 2, "z": 2, "y": 1})] == [0, 1, 2, 3, 4]


def test_placed_rows_stay_within_one_block_of_the_default_weights(spark):
    sizes = {"hot": 20_000, **{f"s{i:02}": 2_100 for i in range(19)}}
    ids = spark.range(sum(sizes.values())).withColumnRenamed("id", "doc_id")
    df = ids.withColumn("source", F.when(F.col("doc_id") < 20_000, "hot").otherwise(F.format_string("s%02d", F.floor((F.col("doc_id") - 20_000) / 2_100))))
    rows = mixing.place(df, block=1).select("row.source", "block", "slot").orderBy("slot").collect()
    assert len(rows) == sum(sizes.values())
    assert worst([tuple(r) for r in rows], mixing.exact(mixing.tempered(sizes)), sizes) < 1
