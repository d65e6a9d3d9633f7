"""Bad lines are reported with file, line and reason; good ones come through as before."""

import os

import pytest

from tradewind.sources import flatfile

GOOD = "1|Ann|road 1|3|13-1|5.25|BUILDING|none|"
BAD = {"1|Ann|road 1|3": "4 fields instead of 8", "x|Ann|road 1|3|13-1|5.25|BUILDING|none|": "c_custkey: no bigint", "": "1 fields instead of 8",
       "|Ann|road 1|3|13-1|5.25|BUILDING|none|": "c_custkey: missing", "1|Ann|road 1|3|13-1|lots|BUILDING|none|": "c_acctbal: no double",
       f"1|{'n' * 26}|road 1|3|13-1|5.25|BUILDING|none|": "c_name: too long", "1|Ann|road 1|3|13-1|5.25|BUILDING|none|more|": "10 fields instead of 8"}


@pytest.mark.parametrize("piece", ["1m", "300"])
def test_planted_bad_lines(spark, tmp_path, piece):
    """Whole files, and files that many tasks read piece by piece."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if piece == "300" else "4m")
    try:
        want = []
        for number in range(3):
            lines = [GOOD] * (20 + 5 * number)
            for at, (line, reason) in enumerate(BAD.items()):
                place = 3 + 2 * at + number
                lines[place] = line
                want.append((f"f{number}.tbl", place + 1, reason, line))
            (tmp_path / f"f{number}.tbl").write_text("\n".join(lines) + "\n")
        good, rejects = flatfile.read_pipe_checked(spark, str(tmp_path), "customer")
        assert sorted((os.path.basename(r.file), r.line, r.reason, r.text) for r in rejects.collect()) == sorted(want)
        assert good.count() == 20 + 25 + 30 - 3 * len(BAD)
        assert good.distinct().collect()[0].asDict() == {
            "c_custkey": 1, "c_name": "Ann", "c_address": "road 1", "c_nationkey": 3, "c_phone": "13-1", "c_acctbal": 5.25,
            "c_mktsegment": "BUILDING", "c_comment": "none"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_good_files_equal_the_plain_reader(spark, small, tmp_path):
    from tradewind.sources.filled import filled_catalog
    path = flatfile.write_pipe(filled_catalog(spark, small).customer, str(tmp_path), "customer")
    good, rejects = flatfile.read_pipe_checked(spark, path, "customer")
    plain = flatfile.read_pipe(spark, path, "customer")
    assert rejects.count() == 0 and good.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, good.collect())) == sorted(map(str, plain.collect()))
