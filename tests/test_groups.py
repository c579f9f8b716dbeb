"""One match for all groups of a line, shared pages of a rendered layout."""
import re

from pyspark.sql import functions as F

from ledgerflow.functions.text import WHITE_SPACE, groups, strip_ws
from ledgerflow.operators.statements import CK_LINE_RE


def test_groups_keep_a_description_that_holds_the_mark(spark):
    lines = ["Jan02 a\x01b\x01c 1,000.00 2.00", "Jan02 \x01\x01\x01\x01", "nothing", None, "Feb03 x -1.00 2.00"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, s string")
    got = {r.k: r.g for r in df.select("k", groups(F.col("s"), CK_LINE_RE, (1, 2, 4, 5), 3).alias("g")).collect()}
    assert got == {0: ["Jan", "02", "1,000.00", "2.00", "a\x01b\x01c"], 1: None, 2: None, 3: None, 4: ["Feb", "03", "-1.00", "2.00", "x"]}


def test_lines_of_a_page_are_matched_once(spark):
    from ledgerflow.operators.statements import extract_td, parse_loc_mc
    lines = spark.createDataFrame([("f", "MC", 0, 1, "x")], "file string, bank string, page int, line_no int, line string")
    for df, pattern in ((parse_loc_mc(lines), "(Jan"), (extract_td(lines), r"(\d{1,3}(?:\s\d{3})*,")):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert len(re.findall(r"regexp_extract", plan)) <= 2 and pattern in plan


def test_strip_ws_knows_every_white_space(spark):
    texts = [WHITE_SPACE + "a" + WHITE_SPACE + "b" + WHITE_SPACE, WHITE_SPACE, "", "a\u200b", "\x1ca\u180e"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, s string")
    old = F.regexp_replace("s", r"(?U)^\s+|\s+$", "")
    assert all(r.a == r.b for r in df.select(strip_ws("s").alias("a"), old.alias("b")).collect())
