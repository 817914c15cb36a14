"""What operators leave on disk: copies that the result reads, and no shuffle files of what is copied."""

from __future__ import annotations

import glob
import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from isohour.llm import passages, setsketch
from isohour.llm.common import SHUFFLES_GO, fixed, passing
from isohour.session import shared_folder


def copies(spark):
    return set(glob.glob(f"{re.sub('^file:', '', shared_folder(spark))}/isohour/*"))


def near_copies(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(120)) for _ in range(20)]
    texts += [t + " end" for t in texts[:8]] + [texts[9] + " " + texts[10]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize(
    "operator, left",
    [(passages.deduplicate, {"spans"}), (passages.without_repeats, {"spans"}), (setsketch.near_duplicates, {"sketches", "set-classes", "links"})],
)
def test_only_what_the_result_reads_stays(spark, operator, left):
    docs, before = near_copies(spark), copies(spark)
    result = operator(docs)
    assert {os.path.basename(c).rsplit("-", 1)[0] for c in copies(spark) - before} <= left
    assert result.count() == 29
    assert sorted(map(repr, result.collect())) == sorted(map(repr, result.collect()))


def test_passing_copies_go_when_a_step_fails(spark):
    before = copies(spark)
    with pytest.raises(ZeroDivisionError), passing(spark) as held:
        assert held(spark.range(3), "step").count() == 3
        raise ZeroDivisionError
    assert copies(spark) == before


def test_copies_leave_no_shuffle_files(spark):
    folder = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
    shuffles = lambda: set(glob.glob(f"{folder}/blockmgr-*/*/shuffle_*"))
    conf, before = spark.conf.get(SHUFFLES_GO), shuffles()
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    copy = fixed(counted, "counted")
    assert not shuffles() - before and spark.conf.get(SHUFFLES_GO) == conf
    assert sum(r["count"] for r in copy.collect()) == sum(r["count"] for r in counted.collect()) == 1000
