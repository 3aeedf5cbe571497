"""Alignment by position, and neighbours across range parts."""

import pytest
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.operators import align, prefix, ranking


def written(df, path, parts, order):
    df.repartitionByRange(parts, order).sortWithinPartitions(order).write.parquet(path)
    return path


def test_tables_written_in_other_parts_meet_row_by_row(spark, tmp_path, monkeypatch):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("x"))
    left = written(rows, str(tmp_path / "left"), 5, "id")
    scores = rows.select((F.col("id") * 3).alias("score"), F.col("id").alias("k"))
    right = written(scores, str(tmp_path / "right"), 3, "k")
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = align.align(spark, left, right)
            assert found.columns == ["id", "x", "score", "k"]
            assert found.where("id <> k OR score <> 3 * id").count() == 0 and found.count() == 5000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    index, total = align.row_positions(spark, left)
    assert total == 5000 and index.where("id <> __index").count() == 0


def test_lengths_and_names_that_do_not_fit_are_refused(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "a")
    paths = [written(df, str(tmp_path / name), 2, F.col("a")) for name, df in (("ten", rows), ("nine", rows.where("a < 9")), ("same", rows))]
    with pytest.raises(ContractError, match="10 and 9 rows"):
        align.align(spark, paths[0], paths[1])
    with pytest.raises(ContractError, match="both tables have a"):
        align.align(spark, paths[0], paths[2])
    rows.where("false").withColumnRenamed("a", "b").write.parquet(str(tmp_path / "none"))
    rows.where("false").write.parquet(str(tmp_path / "nothing"))
    assert align.align(spark, str(tmp_path / "none"), str(tmp_path / "nothing")).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_next_row_across_parts(spark, parts):
    rows = spark.range(60).select((F.col("id") * 5 % 61).alias("v"), (F.col("id") % 3).alias("g"))
    found = prefix.with_next(rows, [F.col("v").desc()], {"next": "v"}, parts=parts).orderBy("v").collect()
    values = [r.v for r in found]
    assert values == sorted(values) and [r["next"] for r in found] == [None, *values[:-1]]


@pytest.mark.parametrize("parts", [1, 6])
def test_curve_without_points_on_a_line(spark, parts, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_PART", 1000 if parts == 1 else 5)
    data = [(int(i % 4 in (0, 1) and i > 6), float(i // 2)) for i in range(40)]
    df = spark.createDataFrame(data, "y int, p double")
    steps = sorted({p for _, p in data}, reverse=True)
    fps = [sum(1 - y for y, q in data if q >= p) for p in steps]
    tps = [sum(y for y, q in data if q >= p) for p in steps]
    last = len(steps) - 1
    kept = [
        i for i in range(len(steps))
        if i in (0, last) or fps[i + 1] - 2 * fps[i] + fps[i - 1] or tps[i + 1] - 2 * tps[i] + tps[i - 1]
    ]
    assert 2 < len(kept) < len(steps)
    curve = ranking.score_curve(df, "y", "p")
    found = ranking.roc_points(curve).where("threshold < 1000").orderBy(F.desc("threshold")).collect()
    assert [r.threshold for r in found] == [steps[i] for i in kept]
    assert [round(r.fpr * fps[-1]) for r in found] == [fps[i] for i in kept]
    assert ranking.roc_points(curve, every=True).count() == len(steps) + 1
