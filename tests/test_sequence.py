import random

import pytest

from helpers import plan_of
from vaultwatch.operators import sequence


def rows_of(spark, seqs):
    rng = random.Random(5)
    rows = [(s, rng.randint(0, 10**9)) for s in seqs]
    df = spark.createDataFrame(rows, "seq long, us long").selectExpr("seq", "timestamp_micros(us) as ts")
    return rows, df.repartition(5)


@pytest.mark.parametrize("ranges", [1, 7, 60])
@pytest.mark.parametrize("seqs", [range(500), [i * i * 10**12 for i in range(500)], [*range(300), *[10**17 + i for i in range(200)]]])
def test_gaps_equal_a_loop_over_the_file(spark, seqs, ranges):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", ranges)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    rows, df = rows_of(session, seqs)
    got = {r.seq: r.gap_seconds for r in sequence.event_gaps(df).collect()}
    ordered = sorted(rows)
    want = {s: None if i == 0 else (us - ordered[i - 1][1]) / 1e6 for i, (s, us) in enumerate(ordered)}
    assert got == want


def test_the_file_is_read_and_dealt_once(spark):
    _, df = rows_of(spark, range(1000))
    plan = plan_of(sequence.event_gaps(df))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "LocalTableScan" not in plan


def test_gaps_in_the_order_of_places(spark):
    df = spark.range(300).selectExpr("struct(string(id % 3) as file, 0L as block, id as row) as seq", "timestamp_seconds(id * id) as ts").repartition(4)
    got = sorted(sequence.event_gaps(df).collect())
    order = sorted(range(300), key=lambda i: (i % 3, i))
    want = [None, *((b * b - a * a) / 1.0 for a, b in zip(order, order[1:]))]
    assert [r.gap_seconds for r in got] == want


def test_closing_row(spark):
    df = spark.sql("select 1 as seq, timestamp'2023-04-01' as ts, 5 as v union all select 2, timestamp'2023-03-01', 6")
    row = sequence.closing_row(df).first()
    assert (row.seq, str(row.ts), row.v) == (2, "2023-03-08 00:00:00", 6)
    assert "TakeOrderedAndProject" in plan_of(sequence.closing_row(df))
