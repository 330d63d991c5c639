"""Results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracles import digest


@pytest.mark.parametrize("name", ["grouping_parse", "metadata_upsert", "locate_fuzzy", "selection_result"])
def test_partition_count_independent(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    hashes = []
    try:
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = E.queries()[name](spark, SF_SMALL)
            hashes.append(digest(df.columns, [tuple(r) for r in df.collect()])[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert hashes[0] == hashes[1]
