"""Links of op8 between fingerprints whose highest bits differ."""
from pyspark.sql import functions as F

from ledgerflow.llm.simhash import _signed, components, links


def test_links_across_the_highest_bit(spark):
    low = 0x0123456789ABCDEF
    high, two, far = low | 1 << 63, low | 1 << 63 | 1 << 62, low ^ 0b111 << 20
    rows = spark.createDataFrame([(_signed(x),) for x in (low, high, two, far)], "fp long")
    assert {(r.a, r.b) for r in links(rows).where("a <= b").collect()} == set()
    got = {r.a: r.b for r in components(links(rows)).collect()}
    least = min(map(_signed, (low, high, two)))
    assert got == {_signed(x): least for x in (low, high, two) if _signed(x) != least}


def test_components_take_links_in_either_direction(spark):
    edges = spark.createDataFrame([(1, 5), (5, 3), (-7, 3)], "a long, b long")
    assert {r.a: r.b for r in components(edges).collect()} == {1: -7, 3: -7, 5: -7}
    assert components(edges.where(F.lit(False))).count() == 0
